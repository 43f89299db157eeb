"""Periodic runs against all periods tried one by one."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadglass.llm import runs


def every_period(w):
    """(start, length, period) of all runs, by trying each period."""
    found = {}
    for p in range(1, len(w) // 3 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def pieced(rng):
    """Words made of repeated stretches, copies of what is there, and slips."""
    n, letters, w = rng.randint(0, 130), rng.randint(1, 4), []
    while len(w) < n:
        w += [rng.randrange(letters) for _ in range(rng.randint(1, 12))] * rng.randint(1, 14)
        if rng.random() < 0.3:
            at = rng.randrange(len(w))
            w += w[at : at + rng.randint(1, 80)]
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.randrange(letters)
    return w


@pytest.mark.parametrize("seed", range(8))
def test_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(250):
        w = pieced(rng)
        want = every_period(w)
        assert sorted(runs.kolpakov_kucherov(w)) == want, w
        assert sorted(runs.find_runs([str(x) for x in w])) == want, w


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90))
def test_any_words_of_two_kinds(w):
    assert sorted(runs.kolpakov_kucherov(w)) == every_period(w)


def test_factors_are_the_longest_that_occurred():
    rng = random.Random(9)
    for _ in range(200):
        w = pieced(rng)[:70]
        b = 0
        for start, end, seen in runs.factors(w):
            assert start == b
            assert (seen < 0 and end == b + 1 and w[b] not in w[:b]) or (0 <= seen < b and w[seen : seen + end - b] == w[b:end])
            assert end == len(w) or not any(w[s : s + end + 1 - b] == w[b : end + 1] for s in range(b))
            b = end
        assert b == len(w)


def plain(doc_id, text, fold=True):
    words = runs.common.WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if fold and doc_id is not None and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]
    found = every_period(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{p}\n" for s, n, p in sorted(found, key=lambda r: (r[0], r[2])))), sha(" ".join(x for i, x in enumerate(words) if i not in dropped)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_every_case_of_the_query(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{x}" for x in pieced(rng)) for _ in range(60)] + [None, "", " \n\t ", "one", "a " * 24, "a " * 23, "é x " * 30, "a b\x0bc " * 40]
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(texts)] + [(3, texts[3], 1, "x", 2)] * 2 + [(None, "r s " * 30, 1, "x", 2), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, runs string, n_runs int").repartition(3)  # clashing names
    got = runs.run_digests(df, fold=True).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got), key=str) == sorted(((i, *plain(i, t)) for i, t, *_ in rows), key=str)
    assert runs.run_digests(df.where("false"), fold=True).count() == 0
    for r in runs.runs(df.where("doc_id < 60")).collect():
        words = texts[r["doc_id"]].split()
        assert sorted(map(tuple, r["runs"])) == every_period(words)
        assert hashlib.sha256(r["text"].encode()).hexdigest() == plain(r["doc_id"], texts[r["doc_id"]], False)[-1]


def test_the_whole_table(spark):
    from roadglass.llm.queries import op12_periodic_runs

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs) and any(r["n_runs"] for r in got.values())
    for r in docs:
        assert tuple(got[r["doc_id"]][c] for c in COLUMNS) == plain(r["doc_id"], r["text"])


@pytest.mark.parametrize("w", [[7] * 60_000, [i % 5 for i in range(60_000)], list(range(2_000)) * 30])
def test_long_texts(w):
    assert runs.find_runs(list(map(str, w))) == [(0, len(w), len(set(w)))]
