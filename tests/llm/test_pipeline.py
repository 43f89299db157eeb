"""The pipeline against a brute-force version on the smallest tables."""

import hashlib
import os
import random
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from test_documents import words

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_pipeline(spark):
    import public_tokenizers
    import tiktoken
    from test_documents import brute_components

    import corpus_pipeline
    from roadglass.llm import bpe, decontaminate, quality, secrets

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    kept = {r[0] for r in c.sql(f"select doc_id from ({quality.ORACLE}) where kept").fetchall()}
    rows = [r for r in c.sql("select doc_id, text, lang, source, n_chars from documents order by doc_id").fetchall() if r[0] in kept]
    rows = [r for r, (d, _, least) in zip(rows, brute_components(rows)) if d == least]
    items = c.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()
    tokens = lambda t: decontaminate._NOISE.sub(" ", t.lower()).split()
    grams = {tuple(w[i : i + 10]) for (t,) in items for w in [tokens(t)] for i in range(len(w) - 9)}
    rows = [r for r in rows if not any(tuple(w[i : i + 10]) in grams for w in [tokens(r[1])] for i in range(len(w) - 9))]
    assert sorted(got) == [r[0] for r in rows]
    codec = bpe.loaded(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for r in rows:
        text = secrets.masked(r[1], secrets.base_spans(r[1]))
        assert got[r[0]]["text"] == text and got[r[0]]["source"] == r[3] and got[r[0]]["n_chars"] == len(text)
        ids = library.encode_ordinary(text)
        assert got[r[0]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def run_on(spark, folder, rows, items):
    """run() on tables with columns of clashing names."""
    import corpus_pipeline

    docs = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, _gone long, removed long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_pipeline_of_odd_rows(spark, tmp_path):
    rng = random.Random(31)
    first, other, guarded, item = (words(rng, 60, 5000) for _ in range(4))
    long = words(rng, 150_000, 50_000)
    secret = guarded + " password=hunter2hunter2 " + words(rng, 20, 5000)
    rows = [(1, first), (1, first), (2, first), (3, None), (4, ""), (5, " \n\t "), (None, first), (None, other), (7, words(rng, 30, 5000) + " " + item), (8, secret), (9, long)]
    rows = [(i, t, "en", None if i == 8 else "s", None if t is None else len(t)) for i, t in rows]
    got = run_on(spark, tmp_path, rows, [(1, item), (1, item), (2, None), (None, first), (3, "")]).collect()
    want = {first: 3, other: 1, secret.replace("password=hunter2hunter2", "[assign]"): 1, long: 1}
    assert Counter(r["text"] for r in got) == want
    assert Counter(r["doc_id"] for r in got) == {1: 2, None: 2, 8: 1, 9: 1}
    assert all(r["n_chars"] == len(r["text"]) and r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in got)


def test_pipeline_of_empty_tables(spark, tmp_path):
    got = run_on(spark, tmp_path, [], [])
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"] and not got.count()


def test_entry_names():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
