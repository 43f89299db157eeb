"""Cases that the operators once left out."""

import random

import duckdb
import pytest
from test_documents import SCHEMA, WORD, words

from roadglass.llm import html_text, quality, secrets


def similar(x, y, size):
    a, b = ({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} for w in (WORD.findall(x.lower()), WORD.findall(y.lower())))
    return len(a & b) / len(a | b)


def near_copies(rng):
    """Pairs of texts around a five-word similarity of 0.8, by changes at random places."""
    rows = []
    for i in range(60):
        parts = words(rng, 100, 5000).split()
        other = list(parts)
        for k in rng.sample(range(100), rng.choice((1, 2, 2, 3, 3, 4))):
            other[k] = f"new{k}"
        rows += [(2 * i, " ".join(parts), "en", "s", 0), (2 * i + 1, " ".join(other), "en", "s", 0)]
    return rows


def test_pipeline_links_from_five_words_and_080(spark):
    import corpus_pipeline

    rows = near_copies(random.Random(21)) + [(900, "four words and no", "en", "s", 0), (901, "four words and No", "en", "s", 0), (902, None, None, None, None)]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()}
    looser = 0
    for i in range(60):
        a, b = rows[2 * i][1], rows[2 * i + 1][1]
        assert 2 * i in kept and (2 * i + 1 in kept) == (similar(a, b, 5) < 0.8)
        looser += similar(a, b, 5) >= 0.8 and similar(a, b, 4) < 0.85
    assert looser >= 3 and 900 in kept and 901 not in kept and 902 in kept


def test_common_lines_leave_the_text(spark):
    rng = random.Random(5)
    own = [[words(rng, 25, 5000), words(rng, 10, 5000), ""] for _ in range(40)]
    texts = ["\n".join([o[0], "All rights reserved 2024", o[1], "  all RIGHTS reserved 7", o[2]]) for o in own]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(100, texts[0], "en", "other", 5), (101, texts[0], "en", None, None), (0, texts[0], "en", "s", len(texts[0]))]
    got = quality.filter_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == 43
    for r in got:
        if r["source"] == "s":
            want = "\n".join(own[r["doc_id"]])
            assert r["text"] == want and r["n_chars"] == len(want)
        else:
            assert r["text"] == texts[0] and r["n_chars"] == (5 if r["source"] else None)


def test_lines_of_small_hosts(spark):
    rng = random.Random(6)
    line = "Licensed under some terms 4.0"
    rows = [(i, f"{words(rng, 30, 5000)}\n{line}", "en", "small", 0) for i in range(6)]
    rows += [(100 + i, f"{words(rng, 30, 5000)}\n{line}", "en", "five", 0) for i in range(5)]
    rows += [(200 + i, words(rng, 30, 5000) + (f"\n{line}" if i < 9 else ""), "en", "large", 0) for i in range(180)]
    rows += [(400 + i, words(rng, 30, 5000) + (f"\n{line}" if i < 10 else ""), "en", None, 0) for i in range(180)]
    rows += [(600 + i, words(rng, 30, 5000) + (f"\n{line}" if i < 31 else ""), "en", "largest", 0) for i in range(700)]
    got = {r["doc_id"]: r["text"] for r in quality.filter_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows)
    gone = {i for i, t, *_ in rows if got[i] != t}
    assert gone == {*range(6), *range(400, 410), *range(600, 631)} and all(line not in got[i] for i in gone)


@pytest.mark.parametrize("limit", [1, 3, 30])
def test_any_limit_against_sql(spark, limit):
    rng = random.Random(7)
    lines = [words(rng, 6, 50) for _ in range(30)]
    rows = [(i, "\n".join([words(rng, 22, 5000)] + rng.choices(lines, range(1, 31), k=3)), "en", rng.choice(["a", "b", None]), 0) for i in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = quality.verdicts(frame, limit).toPandas().sort_values("doc_id").reset_index(drop=True)
    c = duckdb.connect()
    c.register("documents", frame.toPandas())
    want = c.sql(quality.ORACLE.replace("least(30, greatest(5, count(DISTINCT text) // 20))", str(limit))).df().sort_values("doc_id").reset_index(drop=True)[list(got.columns)]
    assert (got == want).all().all() and (limit > 3 or got.n_removed.max() > 0)


def test_secrets_glued_to_names_and_in_paths(spark):
    rng = random.Random(9)
    rows, keys = [], []
    for i in range(40):
        kind = "base64url" if i % 4 == 3 else "base64" if i % 4 == 2 else "base62"
        key = "".join(rng.choice(secrets.ENCODINGS[kind]) for _ in range(48))
        key = {"base64url": "x-Y", "base64": "x+Y"}.get(kind, "") + key
        rows.append((i, [f"AWS_KEY={key} end", f"see /a-b/{key} here", f"at x-y_z/{key}== here", f"GET /some_page/{key}?a=b"][i % 4]))
        keys.append(key)
    rows += [(100 + i, f"https_//some-long_host/path/of-the/{w}?q=plain+words/and-more_words=internationalisationsmeasurement") for i, w in enumerate(["documentation-overview", "installation_guide"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    red = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert sum(keys[i] not in red[i] and "[random]" in red[i] for i in range(40)) >= 36
    assert all(red[i] == t for i, t in rows[40:])
    everything = secrets.Limits((0,) * 26, {(e, k): (secrets.RANDOM_BINS, 0) for e in secrets.ENCODINGS for k in range(5)})
    spans = secrets.scan(df, everything).collect()
    assert all(r["n_random"] == len({x for x in r["spans"].split(",") if x}) for r in spans)
    for i, (_, text) in enumerate(rows[:40]):
        assert all(0 <= a < b <= len(text) for a, b, *_ in secrets.candidates(text))


def test_padding_and_decimals_are_no_part_of_a_run():
    key = "Zk3vQ9xLr7TbN2mWc8YhJ5pD"
    assert [x[:2] for x in secrets.candidates(f"sig={key}== x")] == [(4, 28)]
    assert secrets.candidates("n=123456789012345678901234567890") == []


def test_a_marked_teaser_does_not_hide_the_body():
    body = " ".join(f"<div>Sentence {i} of the body has a few words.</div>" for i in range(20))
    page = f"<body><div>{body}</div><article class=card><h3>More</h3><p>A teaser of another text.</p></article></body>"
    for weights in (({}, {}), ({"p": 3.0, "h3": 3.0}, {"p": -0.05, "div": -0.59, "article": -0.05})):
        text = html_text.main_text(page, *weights)
        assert all(f"Sentence {i} of the body has a few words." in text for i in range(20))
    assert not html_text.count_places(page)


def test_learned_weights_can_outweigh_the_mark():
    lead = "<p>" + "The lead stands before the marked part. " * 3 + "</p>"
    page = f"<body>{lead}<main>{'<p>Words of the marked part are here.</p>' * 6}</main></body>"
    assert html_text.main_text(page, {"p": 3.0}, {}).startswith("The lead")
    assert html_text.main_text(page, {"p": 0.5}, {}).startswith("Words of")


def test_names_made_from_headings_leave_nothing_out():
    body = (
        '<h2 id="related-work">Related work of others</h2><p>They did this before us.</p>'
        '<p class="share-price">The share price rose again.</p><section id="discussion"><h2 class="search-title">Discussion</h2><p>We talk about results here.</p></section>'
        '<div class="alert alert-note">Mind this detail of it.</div><div class="notice">And that one as well.</div><div id="search">Search trees are fast enough.</div>'
        '<div class="menu-engineering"><p>Menus of restaurants are designed.</p></div><p>The last words stand here, and they go on as long as the paragraphs of a text do that has a good end.</p>'
    )
    want = "Related work of others They did this before us. The share price rose again. Discussion We talk about results here. Mind this detail of it. And that one as well. Search trees are fast enough. Menus of restaurants are designed. The last words stand here, and they go on as long as the paragraphs of a text do that has a good end."
    boxes = "<div class='social-share'>Share it with all</div><div class='related-posts'>Read more of it</div><div class=comments>I like it</div><div id='cookie-banner'>We use cookies</div>"
    for page in (f"<article>{body}{boxes}</article>", f"<body>{body}{boxes}</body>", f"<main><div>{boxes}{body}</div></main>"):
        assert html_text.main_text(page, {}, {}) == want


def test_doubtful_classes_are_trimmed_at_the_ends():
    page = "<body><div class='post-widget-strip'>A strip of some other words</div><p>The text has its words here.</p><p>It ends here.</p><div class='search-hints'>Try other words too</div></body>"
    assert html_text.main_text(page, {}, {}) == "The text has its words here. It ends here."
