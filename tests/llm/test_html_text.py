"""What the scan reaches by its weights alone, against a plain maximum over all regions."""

import html
import os
import random
import re
import time

import duckdb
import pytest

from roadglass.llm import html_text

SF = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string"


def article_of(page):
    """The words of the article of a given page, by patterns that fit these pages."""
    inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)
    spaced = re.sub(r"</?(p|h1|br)[^>]*>", " ", inner[1]) if inner else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", spaced)).split())


def renamed(page):
    return re.sub(r"(</?)article>", r"\1div>", page)


@pytest.fixture(scope="module")
def pages():
    return duckdb.sql(f"select page_id, url, html from '{SF}/pages.parquet' order by page_id").fetchall()


@pytest.fixture(scope="module")
def learned(spark, pages):
    return html_text.fit_weights(spark.createDataFrame([p for p in pages if p[0] % 2 == 0], PAGE).repartition(3))


def exact(pages, weights, change):
    tested = [h for i, _, h in pages if i % 2]
    return sum(html_text.main_text(change(h), *weights) == article_of(h) for h in tested) / len(tested)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_held_out_pages_without_a_main_tag(pages, learned):
    assert exact(pages, learned, renamed) >= 0.95 and exact(pages, learned, lambda h: h) >= 0.95


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_learned_names_need_no_list(spark, pages, monkeypatch):
    for name in ("SKIPPED_PARTS", "SKIPPED_IDS", "SKIPPED_CLASSES", "SKIPPED_ARTICLES"):
        monkeypatch.setattr(html_text, name, frozenset())
    weights = html_text.fit_weights(spark.createDataFrame([p for p in pages if p[0] % 2 == 0], PAGE))
    assert weights[0]["class=ad"] <= html_text.DROPPED and exact(pages, weights, renamed) >= 0.95
    assert exact(pages, ({}, {}), renamed) < 0.2


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_random_weights_break_it(pages, learned, monkeypatch):
    monkeypatch.setattr(html_text, "SKIPPED_PARTS", frozenset())
    rng = random.Random(3)
    reached = []
    for _ in range(12):
        weights = {k: rng.uniform(-3, 3) for k in learned[0]}, {k: rng.uniform(-0.6, -0.05) for k in learned[1]}
        reached.append(exact(pages, weights, renamed))
    assert sum(reached) / 12 < 0.6 and min(reached) < 0.05


def plain_text(page, words, tags):
    """The region with the highest sum of all regions; the one that ends first, and of these the longest, of equals."""
    found = html_text.units(page, words)
    mark = html_text.MARKED * max(0.0, 2 * html_text.marked_share(found) - 1)
    score = [(words.get(w, html_text.default_word(w)) + n + (mark if m else -mark)) * len(t.split()) if k == "w" else tags.get(t, html_text.DEFAULT_TAG) for k, t, w, n, m in found]
    best, span = 1e-9, (0, 0)
    for end in range(1, len(score) + 1):
        for start in range(end):
            if (total := sum(score[start:end])) > best + 1e-9:
                best, span = total, (start, end)
    pieces = [html.unescape(t) if k == "w" else "" if t in html_text.INLINE else " " for k, t, *_ in found[slice(*span)]]
    return " ".join("".join(pieces).split())


def test_against_all_regions():
    rng = random.Random(4)
    for _ in range(150):
        page = "<body>"
        for _ in range(rng.randint(1, 14)):
            tag = rng.choice(["p", "div", "h1", "ul", "article", "section", "td"])
            words = " ".join("w" * rng.randint(1, 4) + str(rng.randrange(99)) for _ in range(rng.randint(0, 9)))
            page += rng.choice([f"<{tag}>{words}</{tag}>", f"<{tag} class=x{rng.randrange(4)}>{words}", f"<a href=/>{words}</a>", words, f"<li><b>{words}</b>"])
        weights = {k: rng.uniform(-3, 3) for k in ("p", "div", "h1", "li", "body", "article", "body:a", "class=x1", "class=x2")}, {k: rng.uniform(-0.6, -0.05) for k in ("p", "div", "ul")}
        assert html_text.main_text(page, *weights) == plain_text(page, *weights), page


def test_a_name_of_any_length_is_learned(spark):
    tag, name = "x-element-with-a-name-of-thirty-letters-and-more", "c" * 300
    page = f"<body><div class={name}>words outside of it</div><{tag}>{'inside words of it ' * 9}</{tag}></body>"
    labelled = page.replace(f"<{tag}>", f"<article><{tag}>").replace(f"</{tag}>", f"</{tag}></article>")
    df = spark.createDataFrame([(i, "u", labelled) for i in range(300)], PAGE)
    words, tags = html_text.fit_weights(df)
    assert words[tag] > 2.9 and words[f"class={name}"] <= html_text.DROPPED and tag in tags
    assert html_text.main_text(page, words, tags) == ("inside words of it " * 9).strip()


def test_more_kinds_of_elements_than_two_thousand(spark):
    tags = "".join(f"<k{i}>in it</k{i}>" for i in range(2500))
    df = spark.createDataFrame([(i, "u", f"<body><article>{tags}</article></body>") for i in range(5)], PAGE)
    assert sum(k.startswith("k") for k in html_text.fit_weights(df)[1]) == 2500


def test_deep_nesting_in_linear_time():
    began = time.time()
    for open_ in ("<i>", "<div>", "<i class='a b'>", "<li>x"):
        page = open_ * 20_000 + "x" + "<p>a" * 20_000 + "</u>" * 20_000
        assert html_text.main_text(page, {}, {}).count("a") == 20_000
    assert time.time() - began < 10


def test_repeated_rows_clashing_names_and_cases(spark):
    page = "<body><article><p>Some words of a text.</p></article></body>"
    rows = [(1, "u", page, 5, "x")] * 3 + [(2, None, None, 5, "x"), (None, "v", "", 5, None), (3, "w", "<div>" + "word " * 300_000, 5, "x")]
    df = spark.createDataFrame(rows, PAGE + ", n_chars int, text string").repartition(2)
    got = sorted((r["page_id"] or 0, r["url"] or "", len(r["text"]), r["n_chars"]) for r in html_text.extract(df).collect())
    assert got == [(0, "v", 0, 0)] + [(1, "u", 21, 21)] * 3 + [(2, "", 0, 0), (3, "w", 1_499_999, 1_499_999)]
    assert html_text.extract(df.where("false")).count() == 0


def test_left_out_parts_in_the_middle_of_a_text():
    text = "<p>" + "words of the text " * 10 + "</p>"
    for part in ("<div class=ad>Buy now</div>", "<aside><p>Read also</p></aside>", "<div role=navigation>Here there</div>", "<div id=comments-list><p>" + "I like it " * 200 + "</p></div>", "<p hidden>Not seen</p>", "<form><p>Your name</p></form>"):
        assert html_text.main_text(f"<div>{text}{part}{text}</div>", {}, {}) == " ".join(("words of the text " * 20).split())
