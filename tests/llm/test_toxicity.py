"""Features, training and scores against plain versions; cases of rows."""

import math
import random
import zlib

import pytest

from roadglass.llm import toxicity
from test_documents import words

MASK = (1 << 64) - 1
DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def plain_features(text):
    """Numbers of the distinct words, pairs and pairs around one word."""
    h = [zlib.crc32(w.encode()) + 1 for w in toxicity.TOKEN(text.lower())]
    a, b, c = toxicity.MIX
    found = {x * a & MASK for x in h}
    found |= {((x * a ^ y * b) & MASK) * b & MASK for x, y in zip(h, h[1:])}
    found |= {((x * a ^ y * c) & MASK) * c & MASK for x, y in zip(h, h[2:])}
    return {x >> 64 - toxicity.BITS for x in found}


def plain_ftrl(rows, epochs=4, alpha=1.0, beta=1.0, l1=12.0, weight=4.0):
    """Weights after FTRL-proximal steps over (features, label) in order."""
    z, n = {}, {}

    def w(i):
        return 0.0 if abs(z.get(i, 0.0)) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha)

    for _ in range(epochs):
        for features, y in rows:
            own = {i: w(i) for i in features}
            g = (1 / (1 + math.exp(-max(-35.0, min(35.0, sum(own.values()))))) - y) * (weight if y else 1.0)
            for i in features:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * own[i]
                n[i] = old + g * g
    return {i: w(i) for i in z if w(i)}


@pytest.fixture(scope="module")
def table():
    rng = random.Random(61)
    rows = []
    for i in range(260):
        w = words(rng, rng.randint(1, 25)).split()
        bad = rng.random() < 0.35
        if bad:
            w += rng.choices(("idiot", "moron", "Scum!"), k=3)
        rows.append((i, " ".join(w), int(bad)))
    return rows


def hash_order(spark, ids):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i,) for i in ids], "id long").select("id", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("rank"))
    return [r["id"] for r in df.orderBy("rank").collect()]


def test_features_against_a_plain_version(table):
    texts = [t for _, t, _ in table] + ["", "one", "ÉTÉ ß été", "a b a b a"]
    doc, found = toxicity.feature_rows(texts)
    for i, t in enumerate(texts):
        assert set(found[doc == i].tolist()) == plain_features(t)


def test_weights_and_scores_against_plain_versions(spark, table):
    docs, labels = spark.createDataFrame([r[:2] for r in table], DOCS).repartition(5), spark.createDataFrame([(i, y) for i, _, y in table], LABELS)
    got = toxicity.fit(docs, labels)
    by = {i: (plain_features(t) | {1 << toxicity.BITS}, y) for i, t, y in table}
    order = [i for i in hash_order(spark, by) if zlib.crc32(str(i).encode()) % 3 != 1]
    want = plain_ftrl([by[i] for i in order])
    assert set(got) - {1 << toxicity.BITS} == set(want) - {1 << toxicity.BITS} and len(want) > 5
    assert all(math.isclose(got[i], want.get(i, 0.0), rel_tol=1e-9, abs_tol=1e-9) for i in got)
    for r in toxicity.score(docs, got).collect():
        p = 1 / (1 + math.exp(-sum(want.get(i, 0.0) for i in by[r["doc_id"]][0])))
        assert math.isclose(r["score"], p, rel_tol=1e-9) and r["predicted"] == (p >= 0.7)


def test_repeated_rows_teach_once(spark, table):
    docs, labels = spark.createDataFrame([r[:2] for r in table], DOCS), spark.createDataFrame([(i, y) for i, _, y in table], LABELS)
    once = toxicity.fit(docs, labels)
    again = docs.union(docs).union(docs.where("doc_id < 20")).repartition(7)
    assert toxicity.fit(again, labels.union(labels.where("toxic = 0"))) == once
    assert toxicity.score(again, once).count() == 2 * len(table) + 20


def test_the_sample_is_bounded_in_bytes(spark):
    rows = [(i, f"word{i % 7} " * 200 + ("idiot" if i % 2 else "")) for i in range(300)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2) for i in range(300)], LABELS)
    assert toxicity.fit(docs, labels, sample_bytes=1) == {}
    assert toxicity.fit(docs, labels, sample_bytes=120_000) != toxicity.fit(docs, labels)


def test_very_long_texts_clashing_names_and_empty_tables(spark):
    rows = [(1, "idiot " * 200_000, "x", 5), (2, "fine " * 200_000, "x", 5), (2, "fine", "x", 5), (None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS + ", score string, y int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], LABELS)
    got = toxicity.score(df, toxicity.fit(df, labels)).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(df.where("false"), {}).count() == 0
    assert toxicity.fit(df.where("false"), labels) == {}
