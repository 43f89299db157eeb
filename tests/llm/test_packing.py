"""Sharding against a plain greedy packer, and the balance it reaches."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_documents import words

from roadglass.llm import packing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, shards, large, part_rows):
    """Shard of each distinct text, by lists alone; ``rows``: (text, hash, part by number of parts). No group is divided here."""
    count = Counter(t for t, _, _ in rows)
    size = {t: [(len((t or "").encode()) + 1) * n, len(WORDS.findall(t or "")) * n, n] for t, n in count.items()}
    total = [max(1, sum(s[d] for s in size.values())) for d in range(3)]
    share = {t: [s[d] / total[d] for d in range(3)] for t, s in size.items()}
    number = {t: h for t, h, _ in rows}
    parts = max(1, min(packing.PARTS, len(rows) // part_rows))
    part = {t: p[parts] for t, _, p in rows}
    out, left = {}, [[1 / shards] * 3 for _ in range(shards)]
    weight = [4, 1, 1]

    def put(t, room, capacity, first):
        best = None
        for k in range(shards):
            s = (first + k) % shards
            dot = sum(w * room[s][d] / capacity[s][d] * share[t][d] for d, w in enumerate(weight))
            if best is None or dot > best[0] + 1e-12:
                best = (dot, s)
        out[t] = best[1]
        for d in range(3):
            room[best[1]][d] -= share[t][d]

    big = [t for t in sorted(share, key=lambda t: (-sum(x * x for x in share[t]), number[t])) if max(share[t]) > 1 / large]
    for t in big:
        put(t, left, [[1 / shards] * 3] * shards, 0)
    for p in range(parts):
        mine = sorted((t for t in share if t not in out and part[t] == p), key=number.__getitem__)
        room = [[sum(share[t][d] for t in mine) * left[s][d] / sum(x[d] for x in left) for d in range(3)] for s in range(shards)]
        capacity = [[max(room[s][d], sum(x[d] for x in room) / shards / 1000) for d in range(3)] for s in range(shards)]
        for t in mine:
            put(t, room, capacity, p % shards)
    return out


@pytest.mark.parametrize("large, part_rows", [(4096, 8192), (60, 100), (1, 50)])
def test_against_a_plain_packer(spark, monkeypatch, large, part_rows):
    monkeypatch.setattr(packing, "LARGE", large)
    monkeypatch.setattr(packing, "ROWS", part_rows)
    rng = random.Random(12)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(400)]
    texts += rng.choices(texts, k=60) + [None, None, "", "é" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    h = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.xxhash64("text"))
    keyed = df.select("text", h.alias("h"), *[F.pmod(F.xxhash64(h), F.lit(p)).alias(f"p{p}") for p in range(1, 12)]).collect()
    want = plain([(r["text"], r["h"], {p: r[f"p{p}"] for p in range(1, 12)}) for r in keyed], 8, large, part_rows)
    got = {r["doc_id"]: r["shard"] for r in packing.assign(df).collect()}
    assert [got[i] for i in range(len(texts))] == [want[t] for t in texts]


@pytest.mark.parametrize("share", [0.05, 0.2, 0.34])
def test_balance_with_a_hot_text(spark, share):
    """Bytes, rows and tokens within one per cent of even, whether the hot text fits a shard or not."""
    rng = random.Random(13)
    n = 24_000
    hot = "a short text of very many copies"
    texts = [hot] * int(n * share) + [words(rng, int(rng.lognormvariate(3, 0.7)) + 1) for _ in range(n - int(n * share))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = packing.assign(df).toPandas().set_index("doc_id").sort_index()
    got["tokens"] = [len(texts[i].split()) for i in got.index]
    by = got.groupby("shard").agg(size=("size", "sum"), tokens=("tokens", "sum"), rows=("slot", "count"), last=("slot", "max"))
    assert len(by) == 8 and (by["last"] == by["rows"] - 1).all()
    for c in ("size", "tokens", "rows"):
        assert by[c].max() <= 1.01 * by[c].mean() and by[c].min() >= 0.99 * by[c].mean(), c
    if share < 1 / 8:
        assert got.loc[: int(n * share) - 1, "shard"].nunique() == 1


def test_only_groups_that_fit_no_shard_are_divided(spark):
    """Once every third row is spread, no shard has room for every ninth; one row in twenty fits, and stays whole."""
    rng = random.Random(14)
    texts = ["every third row " * 2] * 300 + ["every ninth row " * 2] * 99 + ["one row in twenty " * 3] * 45 + [words(rng, 12) for _ in range(455)] + [None]
    got = {r["doc_id"]: r for r in packing.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    of = defaultdict(set)
    for i, t in enumerate(texts):
        of[t].add(got[i]["shard"])
    assert len(of[texts[0]]) == len(of[texts[300]]) == 8 and all(len(s) == 1 for t, s in of.items() if t not in (texts[0], texts[300]))


@pytest.mark.parametrize("hot", ["a short text of very many copies", "a text of the usual length that very many rows repeat as it is, with some thirty words in it, so that it weighs about as much as others do and " * 1])
@pytest.mark.parametrize("share", [0.05, 0.08, 0.1, 0.12, 0.13])
def test_bytes_stay_even_whatever_the_share_of_a_hot_text(spark, share, hot):
    rng = random.Random(16)
    n = 16_000
    texts = [hot] * int(n * share) + [words(rng, int(rng.lognormvariate(3, 0.7)) + 1) for _ in range(n - int(n * share))]
    got = packing.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).toPandas()
    by = got.groupby("shard").agg(size=("size", "sum"), rows=("slot", "count"), last=("slot", "max"))
    assert len(by) == 8 and (by["last"] == by["rows"] - 1).all()
    assert by["size"].max() <= 1.01 * by["size"].min() and by["rows"].max() <= 1.03 * by["rows"].min()
    if share == 0.05:
        assert got[got["doc_id"] < int(n * share)]["shard"].nunique() == 1


def test_rows_of_placed_groups_are_dealt_over_all_parts(spark, monkeypatch):
    """Each part is a task of its own, and the copies of a hot text are spread over them."""
    monkeypatch.setattr(packing, "ROWS", 500)
    texts = ["hot text"] * 2000 + [f"text {i}" for i in range(2000)]
    kept = {}
    keep = packing.common.Workspace.keep
    monkeypatch.setattr(packing.common.Workspace, "keep", lambda self, df, name: kept.setdefault(name, keep(self, df, name)))
    packing.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).count()
    parts = [r["count"] for r in kept["placed"].groupBy("part").count().collect()]
    assert len(parts) == 8 and max(parts) < 700 and min(parts) > 350
    files = {}
    for r in kept["placed"].select("part", F.input_file_name().alias("f")).distinct().collect():
        files.setdefault(r["f"], []).append(r["part"])
    assert all(len(p) == 1 for p in files.values())


def test_shards_are_written_and_ids_that_repeat_are_kept(spark, tmp_path):
    rng = random.Random(17)
    rows = [(i, words(rng, 8)) for i in range(100)] + [(5, "again"), (5, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places = packing.write_shards(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in back.collect()) == sorted((-1 if i is None else i, t) for i, t in rows)
    assert places.count() == len(rows) and {r["shard"] for r in back.select("shard").distinct().collect()} == set(range(8))
    assert sorted((r["shard"], r["slot"]) for r in back.collect()) == sorted((r["shard"], r["slot"]) for r in places.collect())


def test_a_very_long_text_repeated_rows_and_clashing_names(spark):
    rng = random.Random(15)
    long = "x" * 2_000_000
    rows = [(0, long, 1, 2, "p")] + [(1, "same row", 1, 2, "p")] * 5 + [(None, "no id", 1, 2, "p")] * 2 + [(i, words(rng, 9), 1, 2, "p") for i in range(2, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grp int, slot int, part string")
    got = packing.assign(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert [r["size"] for r in got if r["doc_id"] == 0] == [2_000_001]


def test_rows_of_one_id_and_text_that_fill_the_table(spark):
    got = packing.assign(spark.createDataFrame([(7, "one")] * 50, "doc_id long, text string")).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == 50 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_no_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from roadglass.llm import common

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(RuntimeError):
        common.shared_dir(fake)
