"""Cases of rows that every operator must define: clashing names, very long texts, the queue in line."""

import random

import pytest
import public_tokenizers
import tiktoken
from test_documents import SCHEMA, docs, documents, words  # noqa: F401  fixtures

from roadglass.llm import bpe, jaccard_join, quality

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def test_quality_of_a_very_long_text_and_clashing_names(spark):
    rng = random.Random(71)
    long = "\n".join(words(rng, 20, 10**6) for _ in range(20_000)) + "\n" + words(rng, 300, 3)
    rows = [(1, long, "en", "s", 5), (2, words(rng, 30), "en", "s", 6)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'i' AS id", "1.5 AS row", "'l' AS line", "7 AS _words", "8 AS `a b`", "9 AS _row")
    got = quality.verdicts(df, extra=["id", "row", "line", "_words", "a b", "_row", "text"]).toPandas().sort_values("doc_id")
    assert got["id"].tolist() == ["i"] * 2 and got["_words"].tolist() == [7] * 2 and got["a b"].tolist() == [8] * 2 and got.text.tolist() == [r[1] for r in rows]
    for text, (_, row) in zip((r[1] for r in rows), got.iterrows()):
        w = text.split()
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i : i + 8]), []).append(i)
        repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
        lines = [x for x in text.split("\n") if x.strip()]
        want = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))
        assert tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == want
        assert row.kept == (100 * len(repeated) <= 30 * len(w)) and row.n_removed == 0
    for clash in ("n_words", "kept", "doc_id"):
        with pytest.raises(ValueError):
            quality.verdicts(df, extra=[clash])


@pytest.fixture(scope="module")
def codec():
    return bpe.loaded(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@pytest.mark.parametrize("piece", ["a" * 1_000_000, "abcd" * 50_000, "é" * 100_000, "=" * 300_000, "".join(random.Random(72).choice("abcdefgh") for _ in range(300_000))])
def test_very_long_pre_tokens(codec, piece):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    ids = codec.encode(piece)
    assert codec.decode(ids) == piece.encode()
    short = piece[:400]
    assert codec.encode(short) == library.encode_ordinary(short)
    if len(set(piece)) > 4:
        assert ids == library.encode_ordinary(piece)


def queued(codec, piece):
    """Ids of one pre-token by the queue's own push and pop."""
    if piece in codec.ranks:
        return [codec.ranks[piece]]
    queue, symbols = bpe.RankQueue(len(codec.vocabulary)), {i: piece[i : i + 1] for i in range(len(piece))}
    after, before = {i: i + 1 for i in range(len(piece))}, {i: i - 1 for i in range(len(piece))}

    def rank(i):
        return codec.ranks.get(symbols[i] + symbols[after[i]]) if after[i] < len(piece) else None

    for i in range(len(piece) - 1):
        if rank(i) is not None:
            queue.push(rank(i), i)
    while (top := queue.pop()) is not None:
        found, i = top
        if i not in symbols or rank(i) != found:
            continue
        j = after[i]
        symbols[i] += symbols.pop(j)
        after[i] = after[j]
        if after[i] < len(piece):
            before[after[i]] = i
            if rank(i) is not None:
                queue.push(rank(i), i)
        if i and rank(before[i]) is not None:
            queue.push(rank(before[i]), before[i])
    return [codec.ranks[symbols[i]] for i in sorted(symbols)]


def test_the_queue_in_line_is_the_queue(codec):
    rng = random.Random(73)
    for _ in range(300):
        piece = "".join(rng.choice("abcdehinorst éß") for _ in range(rng.randint(1, 60))).encode()
        assert codec.merge(piece) == queued(codec, piece)


def test_names_of_results_are_refused(spark):
    df = spark.createDataFrame([(1, "x")], "ids long, text string")
    with pytest.raises(ValueError):
        bpe.encode(df, VOCABULARY, id_col="ids")
    with pytest.raises(ValueError):
        bpe.decode(df, VOCABULARY, id_col="text", ids_col="ids")
    with pytest.raises(ValueError):
        bpe.digests(df, VOCABULARY, extra=["n_tokens"])


def test_joins_of_very_long_texts(spark):
    rng = random.Random(74)
    base = words(rng, 150_000, 10**6)
    parts = base.split()
    near, far = list(parts), list(parts)
    for k in rng.sample(range(len(parts)), 1000):
        near[k] = "changed"
    for k in rng.sample(range(len(parts)), 30_000):
        far[k] = "changed"
    rows = [(1, base, "x"), (2, " ".join(near), "x"), (3, " ".join(far), "x"), (4, base, "x")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_components(spark.createDataFrame(rows, "doc_id long, text string, node string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_nodes_of_very_many_pairs(spark, documents, docs, monkeypatch):
    from test_documents import brute_components

    once = jaccard_join.Degrees.__init__
    monkeypatch.setattr(jaccard_join.Degrees, "__init__", lambda self, pairs, often=4096: once(self, pairs, 3))
    got = jaccard_join.join_components(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_components(documents)))
    pairs = spark.createDataFrame([(1, i) for i in range(2, 40)], "a long, b long")
    degrees = jaccard_join.Degrees(pairs)
    assert degrees.rows == [(1, 13)]


def test_scratch_deletes_what_operators_keep(spark):
    from roadglass.llm import common

    df = spark.createDataFrame([(i, f"text {i} of some") for i in range(20)], "doc_id long, text string")
    out = common.Workspace(spark)
    with common.scratch():
        kept = out.keep(jaccard_join.join_components(df), "out")
        made = list(common._open[-1])
    assert kept.count() == 20 and made and all(not w.paths for w in made) and not common._open
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(made[0].top)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
