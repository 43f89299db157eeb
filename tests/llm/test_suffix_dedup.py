"""Repeated strings against a count of every string."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadglass.llm import suffix_dedup


def every_string(texts, length):
    """For each text which starts are repeated."""
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [[count[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


def spans(flags, length):
    out = []
    for i in (i for i, f in enumerate(flags) if f):
        if out and i <= out[-1][1]:
            out[-1][1] = i + length
        else:
            out.append([i, i + length])
    return [tuple(x) for x in out]


def near_copies(rng, n, bases=4, longest=1200):
    base = ["".join(rng.choices("abcdefgh é", k=rng.randint(0, longest))) for _ in range(bases)]
    out = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if t:
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 3)] = rng.choice(["", "x", "yz"])
        out.append("".join(t) + (rng.choice(base)[:300] if rng.random() < 0.3 else ""))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"\0", b"abab" * 4]), min_size=1, max_size=40).map(b"".join))
def test_suffix_array_and_common_prefixes(raw):
    at = np.frombuffer(raw, np.uint8)
    sa, rank = suffix_dedup.suffix_array(at)
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    before = np.where(rank > 0, sa[np.maximum(rank - 1, 0)], -1)
    got = suffix_dedup.common_prefixes(suffix_dedup._words(np.append(at, np.zeros(0, np.uint8))), before, np.array([0]), np.array([len(raw)]), 16)
    for i, j in enumerate(before.tolist()):
        n = 0
        while j >= 0 and max(i, j) + n < len(raw) and raw[i + n] == raw[j + n]:
            n += 1
        # zero bytes may seem to go on beyond the end, where no start is
        assert got[i] == min(n, 16) or (got[i] > n and max(i, j) + n == len(raw))


@pytest.mark.parametrize("shard, stretch", [(500_000, 4_000_000), (2_000, 3_000)])
def test_pieces_and_shards(monkeypatch, shard, stretch):
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rng, length = random.Random(1), 130
    for _ in range(8):
        texts = [t.encode() for t in near_copies(rng, rng.randint(1, 40))]
        got = [np.zeros(max(0, len(t) - length + 1), bool) for t in texts]
        seen = [x.copy() for x in got]
        by = defaultdict(lambda: defaultdict(list))
        for lot in suffix_dedup.pieces_of(texts, length):
            for of, h, f1, f2, a, b, o in zip(*(x.tolist() for x in lot)):
                assert not seen[of][a : b + 1].any()
                seen[of][a : b + 1] = True
                by[h][f1, f2].append((of, a, b))
        assert all(x.all() for x in seen)
        groups = []
        for kinds in by.values():
            for places in kinds.values():
                for of, a, b in places if len(places) > 1 else ():
                    got[of][a : b + 1] = True
            groups.append([(of, a, texts[of][a : b + length]) for (of, a, b), *_ in kinds.values()])
        for (of, a), found in suffix_dedup.repeated_starts(iter(groups), length):
            for x, y in found:
                got[of][a + x : a + y + 1] = True
        assert [x.tolist() for x in got] == every_string(texts, length)


@pytest.mark.parametrize("width", [16, 1])
def test_blocks_hold_each_start_once_and_share_their_bytes(width):
    rng, length = random.Random(2), 150
    for _ in range(100):
        c = rng.randint(1, 80)
        data, o = bytes(rng.choices(b"abc", k=c + length - 1)), rng.randint(c - 1, 87)
        blocks = suffix_dedup.blocks_of(data, 5, o, width, length)
        assert sorted(i for *_, a, b, _ in blocks for i in range(a, b + 1)) == list(range(c))
        assert all(at == o - a for *_, a, b, at in blocks)
        # from another piece, the same strings meet under the same hash
        cut = rng.randint(0, c - 1)
        inner = suffix_dedup.blocks_of(data[cut:], 5, o - cut, width, length)
        key = {i: k for k, *_, a, b, _ in blocks for i in range(a, b + 1)}
        assert all(key[i + cut] == k for k, *_, a, b, _ in inner for i in range(a, b + 1))


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    for t, flags in zip(raw, every_string(raw, length)):
        cut = spans(flags, length)
        gone = {i for x, y in cut for i in range(x, y)}
        kept = bytes(c for i, c in enumerate(t) if i not in gone)
        yield len(t), len(gone), len(cut), hashlib.sha256(kept).hexdigest(), cut, kept


@pytest.mark.parametrize("hot", [2048, 3])
def test_every_case(spark, monkeypatch, hot):
    """With few pieces allowed, anchors are divided twice, down to single starts."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(3)
    texts = near_copies(rng, 60, longest=900) + [None, "", "short", "ab" * 600, "c" * 1000]
    texts += ["".join(rng.choices("abc", k=rng.randint(100, 300))) + "a passage that stands in very many of these texts " * 3 + "".join(rng.choices("abc", k=300)) for _ in range(20)]
    rows = [(i, t, 1, "x", 2) for i, t in enumerate(texts)] + [(5, texts[5], 1, "x", 2)] * 3 + [(None, texts[6], 1, "x", 2), (None, texts[0] + "d", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, owner int, h string, a int").repartition(4)  # clashing names
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows], 150))]
    got = suffix_dedup.digests(df, length=150).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == sorted((w[:5] for w in want), key=str)
    assert any(w[2] for w in want) and suffix_dedup.digests(df.where("false"), length=150).count() == 0
    if hot > 3:
        got = suffix_dedup.remove(df, length=150).collect()
        assert sorted(((r["doc_id"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in got), key=str) == sorted(((w[0], *w[5:]) for w in want), key=str)


def test_the_whole_table(spark):
    from roadglass.llm.queries import op13_suffix_dedup

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op13_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: p[:4] for r, p in zip(docs, plain([r["text"] for r in docs], 400))}


def test_a_length_below_two_anchors_is_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove(spark.createDataFrame([(1, "x")], "doc_id long, text string"), length=100)
