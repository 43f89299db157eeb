"""Removal of strings of 400 bytes that start more than once in the corpus, by suffix arrays.

Every string of 400 bytes (``length``) has an anchor: of its 64-byte strings the
one with the smallest hash, the leftmost of equals. Equal strings have equal
anchors at equal places, so texts are cut into pieces: the longest stretches of
starts with one anchor, and the bytes that these starts' strings cover. Pieces
meet by the hash of their anchor, and what has no partner there has none at all.
Of equal pieces (by a 128-bit hash) one is read: all their starts are repeated.

Pieces that share an anchor and differ are compared in shards of about half a
megabyte, and one task never holds more than a few of them. A shard gets its suffix
array by the refinement of Larsson and Sadakane, in numpy: ranks by eight bytes,
then by twice as many in each round, only for suffixes that are not alone yet.
Kasai's method finds the common prefixes with the suffix before, for all pieces of
a shard in step. Starts with 400 common bytes are repeated. Where the pieces of an
anchor fill several shards, these are merged: the starts of one are looked up among
those of the other by binary search in its suffix array.

An anchor with more than HOT different pieces (a short passage that very many
texts share, or edits near it in very many near copies) is divided instead, and
needs no task of its own: its pieces are cut by the starts' distance from the
anchor, first into blocks of BLOCKS[0] starts, and meet by all the bytes that a
block's strings share; where even these are many, start by start, which is the
string itself and leaves nothing to compare.

Work and shuffles follow the input: some 170 starts share an anchor, and only
pieces with a partner are read again. Texts travel once, if they have such a piece.

Results by case: a null text has no bytes; a text shorter than ``length`` loses
none; repeated rows and equal texts lose all bytes from ``length`` on; an empty
table gives none; texts of any length are cut whole; other columns, whatever their
names, are not read. Kept bytes can end inside a character, so they are binary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH = 400
#: Bytes of an anchor; a power of two.
ANCHOR = 64
#: Bytes that are searched for anchors at a time; below 2 ** PLACE_BITS.
STRETCH, PLACE_BITS = 4_000_000, 24
#: Bytes of a shard of pieces, and most pieces of an anchor that meet as a whole.
SHARD, HOT = 500_000, 2048
#: Starts of a block of a hot anchor, level by level; the last must be 1.
BLOCKS = (16, 1)
PIECE = "h long, f1 long, f2 long, a int, b int, o int"


# ---- anchors -------------------------------------------------------------------------


def _hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from each place on."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step = 1
    while step < ANCHOR:
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93 + 2 * step) + h[step:]
        h ^= h >> np.uint64(32)
        step *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, first start, last start, place of the anchor) of each piece; ``starts``: stretches (from, to) of starts."""
    h = _hashes(raw)
    least = (h & ~np.uint64((1 << PLACE_BITS) - 1)) | np.arange(len(h), dtype=np.uint64)
    window, span = length - ANCHOR + 1, 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if window > span:
        least = np.minimum(least[: span - window], least[window - span :])
    opens = np.zeros(len(least) + 1, dtype=bool)
    opens[1:-1] = least[1:] != least[:-1]
    opens[starts[:, 0]] = True
    inside = np.zeros(len(least) + 1, dtype=np.int8)
    inside[starts[:, 0]] += 1
    inside[starts[:, 1]] -= 1
    valid = np.cumsum(inside)[:-1] > 0
    a = np.flatnonzero(opens[:-1] & valid)
    opens[starts[:, 1]] = True
    ends = np.flatnonzero(opens | (np.arange(len(opens)) == len(least)))
    b = ends[np.searchsorted(ends, a, "right")] - 1
    place = (least[a] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    return h[place].view(np.int64), a, b, place


def _fingerprint(data) -> tuple[int, int]:
    import xxhash

    d = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)
    return int(d[0]), int(d[1])


def _fingerprints(view: memoryview, a: list[int], b: list[int], length: int) -> np.ndarray:
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join([xxh3_128_digest(view[x : y + length]) for x, y in zip(a, b)]), np.int64).reshape(-1, 2)


def _stretches(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in lots of about STRETCH bytes: (text, its first start, bytes); longer ones overlap from lot to lot."""
    lot, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, STRETCH):
            part = text[at : at + STRETCH + length - 1]
            if lot and size + len(part) > STRETCH:
                yield lot
                lot, size = [], 0
            lot.append((i, at, part))
            size += len(part)
    if lot:
        yield lot


def pieces_of(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Lots of (text, hash, fingerprint in two, first start, last start, anchor's distance from the first start)."""
    for lot in _stretches(texts, length):
        raw = b"".join(part for _, _, part in lot)
        size = np.array([len(part) for _, _, part in lot])
        first = np.cumsum(size) - size
        h, a, b, place = anchors(np.frombuffer(raw, np.uint8), np.stack([first, first + size - length + 1], axis=1), length)
        f = _fingerprints(memoryview(raw), a.tolist(), b.tolist(), length)
        of = np.searchsorted(first, a, "right") - 1
        shift = np.array([at for _, at, _ in lot])[of] - first[of]
        yield np.array([i for i, _, _ in lot])[of], h, f[:, 0], f[:, 1], a + shift, b + shift, place - a


def blocks_of(data: bytes, h: int, o: int, width: int, length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """(hash, fingerprint in two, first start, last start, anchor's distance) of the blocks of a piece.

    A block has the starts whose distance from the anchor, divided by ``width``, is the same; its hash is that of the bytes they share.
    """
    import xxhash

    out, last = [], len(data) - length
    for j in range(max(0, o - last) // width, o // width + 1):
        a, b = max(0, o - (j + 1) * width + 1), min(last, o - j * width)
        if a <= b:
            core = data[max(0, o - j * width) : o - (j + 1) * width + 1 + length]
            key = xxhash.xxh3_64_intdigest(core + b"%d %d" % (h, j))
            out.append((key - (1 << 63), *_fingerprint(data[a : b + length]), a, b, o - a))
    return out


# ---- suffix arrays -------------------------------------------------------------------


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    w = raw.astype(np.uint64)
    for step in (1, 2, 4):
        w <<= np.uint64(8 * step)
        w[:-step] |= w[step:] >> np.uint64(8 * step)
    return w


def suffix_array(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, place of each suffix) by Larsson-Sadakane refinement."""
    n = len(raw)
    key = _words(raw)
    sa = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    active, key, h = np.arange(n), key[sa], 8
    while True:
        new = np.ones(len(active), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(new)
        rank[sa[active]] = np.repeat(active[heads], np.diff(heads, append=len(active)))
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        if not len(active):
            return sa, rank
        i = sa[active]
        # beyond the end the shorter suffix comes first
        beyond = i + h >= n
        second = np.where(beyond, n - i, rank[np.minimum(i + h, n - 1)] + n + 1)
        key = rank[i] * (2 * n + 2) + second
        order = np.argsort(key)
        sa[active], key = i[order], key[order]
        h *= 2


def _leading(x: np.ndarray) -> np.ndarray:
    """How many bytes are zero before the first other one."""
    n = np.zeros(len(x), dtype=np.int64)
    for bits in range(8, 64, 8):
        n += x < np.uint64(1 << bits)
    return n


def common_prefixes(words: np.ndarray, before: np.ndarray, first: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Common bytes of each start with the suffix before it in the order, ``most`` at most: Kasai's method, all pieces in step.

    ``first``, ``starts``: where each piece begins and how many starts it has. One byte less is common from one start to the next.
    """
    out = np.zeros(len(words), dtype=np.int64)
    order = np.argsort(-starts, kind="stable")
    first, starts = first[order], starts[order]
    n, reach = np.zeros(len(first), dtype=np.int64), len(words)
    for step in range(int(starts[0]) if len(starts) else 0):
        live = int(np.searchsorted(-starts, -step, "left"))  # pieces with more starts than that
        i = first[:live] + step
        j = before[i]
        n = np.where(j >= 0, np.maximum(n[:live] - 1, 0), 0)
        open_ = np.flatnonzero(j >= 0)
        while len(open_):
            x, y = i[open_] + n[open_], j[open_] + n[open_]
            inside = (x < reach) & (y < reach)
            open_, x, y = open_[inside], x[inside], y[inside]
            differ = words[x] ^ words[y]
            same = _leading(differ) + (differ == 0)
            n[open_] += same
            open_ = open_[(same == 8) & (n[open_] < most)]
        out[i] = n
    return np.minimum(out, most)


class Shard:
    """Pieces one after the other, their suffix array, and which starts are repeated."""

    def __init__(self, pieces: list[bytes], length: int):
        self.length = length
        size = np.array([len(p) for p in pieces])
        # after each piece its number, between bytes that no text holds
        raw = np.frombuffer(b"".join(p + b"\xff" + i.to_bytes(4, "big") + b"\xff" for i, p in enumerate(pieces)), np.uint8)
        self.first = np.cumsum(size + 6) - size - 6
        self.starts = size - length + 1
        self.words = _words(raw)
        sa, rank = suffix_array(raw)
        before = np.where(rank > 0, sa[np.maximum(rank - 1, 0)], -1)
        shared = common_prefixes(self.words, before, self.first, self.starts, length) >= length
        self.repeated = shared.copy()
        self.repeated[before[shared]] = True
        is_start = np.zeros(len(raw), dtype=bool)
        is_start[np.repeat(self.first - np.cumsum(self.starts) + self.starts, self.starts) + np.arange(int(self.starts.sum()))] = True
        self.order, self.shared, self.is_start = sa, shared, is_start

    def _kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """All starts in order, and which of them is the first of its kind: the others have the common bytes with the one before."""
        at = self.order[self.is_start[self.order]]
        head = ~self.shared[at]
        head[:1] = True
        return at, head

    def different(self) -> np.ndarray:
        """Starts of the pieces, one of each kind, in order."""
        at, head = self._kinds()
        return at[head]

    def spread(self) -> None:
        """If one of a kind is repeated, all are."""
        at, head = self._kinds()
        kind = np.cumsum(head) - 1
        known = np.zeros(int(head.sum()), dtype=bool)
        known[kind[self.repeated[at]]] = True
        self.repeated[at] = known[kind]

    def repeated_stretches(self, piece: int) -> list[tuple[int, int]]:
        """(first, last) start of each stretch of repeated starts of a piece."""
        a = self.first[piece]
        flag = np.concatenate([[False], self.repeated[a : a + self.starts[piece]], [False]])
        turns = np.flatnonzero(flag[1:] != flag[:-1]).reshape(-1, 2)
        return [(int(x), int(y) - 1) for x, y in turns]


def _compare(w: np.ndarray, x: np.ndarray, v: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1: the ``length`` bytes of w from x on against those of v from y on."""
    out, open_ = np.zeros(len(x), dtype=np.int8), np.arange(len(x))
    for at in range(0, length, 8):
        p, q = w[x[open_] + at], v[y[open_] + at]
        if length - at < 8:
            cut = np.uint64(8 * (8 - length + at))
            p, q = p >> cut, q >> cut
        out[open_] = np.where(p < q, -1, np.where(p > q, 1, 0))
        open_ = open_[p == q]
        if not len(open_):
            break
    return out


def merge(one: Shard, mine: np.ndarray, other: Shard, theirs: np.ndarray) -> None:
    """Mark the starts that two shards share: each of ``mine`` is looked up among ``theirs``, which are in order, by binary search."""
    if not len(mine) or not len(theirs):
        return
    low, high = np.zeros(len(mine), dtype=np.int64), np.full(len(mine), len(theirs))
    while (low < high).any():
        mid = np.minimum((low + high) // 2, len(theirs) - 1)
        below = (_compare(other.words, theirs[mid], one.words, mine, one.length) < 0) & (low < high)
        high = np.where(below | (low >= high), high, mid)
        low = np.where(below, mid + 1, low)
    at = np.minimum(low, len(theirs) - 1)
    hit = _compare(one.words, mine, other.words, theirs[at], one.length) == 0
    one.repeated[mine[hit]] = True
    other.repeated[theirs[at[hit]]] = True


def repeated_starts(groups: Iterator[list[tuple]], length: int = LENGTH) -> Iterator[tuple[tuple, list[tuple[int, int]]]]:
    """(piece, its stretches of repeated starts), piece by piece; ``groups``: the pieces of an anchor, each with its bytes last.

    Small groups share a shard; a larger one fills several, which are merged two by two (a group has a bounded number of pieces).
    """

    def told(pieces: list[tuple], shard: Shard):
        for k, piece in enumerate(pieces):
            yield piece[:-1], shard.repeated_stretches(k)

    lot, size = [], 0
    for group in groups:
        total = sum(len(p[-1]) for p in group)
        if total <= SHARD:
            if lot and size + total > SHARD:
                yield from told(lot, Shard([p[-1] for p in lot], length))
                lot, size = [], 0
            lot += group
            size += total
            continue
        parts, at = [[]], 0
        for p in group:
            if parts[-1] and at + len(p[-1]) > SHARD:
                parts.append([])
                at = 0
            parts[-1].append(p)
            at += len(p[-1])
        shards = [Shard([p[-1] for p in part], length) for part in parts]
        kinds = [s.different() for s in shards]
        for i, one in enumerate(shards):
            for j in range(i):
                merge(one, kinds[i], shards[j], kinds[j])
        for part, shard in zip(parts, shards):
            shard.spread()
            yield from told(part, shard)
    if lot:
        yield from told(lot, Shard([p[-1] for p in lot], length))


# ---- tables --------------------------------------------------------------------------


def _resolve(work: common.Workspace, occ: DataFrame, texts: Callable[[DataFrame], DataFrame], length: int, level: int) -> DataFrame:
    """(owner, a, b): stretches of repeated starts.

    ``occ``: (doc_id, owner, weight, h, f1, f2, a, b, o), a kept table; ``texts`` gives (owner, data) for the part of it that has partners.
    """
    # sums are written before they are joined: a join that shuffles both sides can split what belongs to a hot key
    keys = occ.groupBy("h").agg(F.sum("weight").alias("n"), F.min("f1").alias("low"), F.max("f1").alias("high")).where("n > 1")
    keys = work.keep(keys.select("h", (F.col("low") == F.col("high")).alias("alike")), f"keys-{level}")
    found = work.keep(occ.join(keys, "h"), f"met-{level}")
    piece = ["h", "f1", "f2"]
    kinds = work.keep(found.where("not alike").groupBy(*piece).agg(F.sum("weight").alias("n"), F.min(F.struct("owner", "a", "b", "o")).alias("rep")), f"kinds-{level}")
    # all starts of equal pieces are repeated
    whole = found.where("alike").select("owner", "a", "b").unionByName(found.where("not alike").join(kinds.where("n > 1").select(*piece), piece, "left_semi").select("owner", "a", "b"))
    open_ = kinds.groupBy("h").agg(F.min("n").alias("least"), F.count("*").alias("kinds")).where("least = 1").select("h", "kinds")
    needed = work.keep(kinds.join(work.keep(open_, f"compared-{level}"), "h").select(*piece, "n", "kinds", "rep.*"), f"open-{level}")

    of_owner = needed.groupBy("owner").agg(F.collect_list(F.struct(*piece, "n", "kinds", "a", "b", "o")).alias("pieces"))
    here = texts(found).join(of_owner, "owner")

    def cut(batches):
        done = set()
        for part in common.slices(batches, 16):
            rows = []
            for owner, data, pieces in zip(*(part.column(c).to_pylist() for c in ("owner", "data", "pieces"))):
                if owner not in done:  # rows that repeat id and text
                    done.add(owner)
                    rows += [p | {"owner": owner, "data": data[p["a"] : p["b"] + length]} for p in pieces]
            yield pa.RecordBatch.from_pylist(rows, schema=cut_schema)

    cut_schema = pa.schema([("h", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("n", pa.int64()), ("kinds", pa.int64()), ("owner", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("o", pa.int32()), ("data", pa.binary())])
    cuts = work.keep(here.mapInArrow(cut, "h long, f1 long, f2 long, n long, kinds long, owner binary, a int, b int, o int, data binary"), f"pieces-{level}")

    def compare(batches):
        def groups():
            group, last, seen = [], None, set()
            for part in common.slices(batches, 512):
                for row in zip(*(part.column(c).to_pylist() for c in ("h", "f1", "f2", "n", "owner", "a", "data"))):
                    if row[0] != last:
                        if group:
                            yield group
                        group, last, seen = [], row[0], set()
                    if row[1:3] not in seen:
                        seen.add(row[1:3])
                        group.append(row)
            if group:
                yield group

        rows = []
        for (_, _, _, n, owner, a), stretches in repeated_starts(groups(), length):
            if n == 1:  # the others are repeated as a whole
                rows += [{"owner": owner, "a": a + x, "b": a + y} for x, y in stretches]
            if len(rows) > 5000:
                yield pa.RecordBatch.from_pylist(rows, schema=range_schema)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=range_schema)

    range_schema = pa.schema([("owner", pa.binary()), ("a", pa.int32()), ("b", pa.int32())])
    compared = cuts.where(F.col("kinds") <= HOT).repartition("h").sortWithinPartitions("h").mapInArrow(compare, "owner binary, a int, b int")
    out = whole.unionByName(compared)

    hot = cuts.where(F.col("kinds") > HOT)
    if level < len(BLOCKS) and hot.limit(1).count():
        width, owned = BLOCKS[level], F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in piece])
        hot = work.keep(hot.withColumn("piece", owned), f"hot-{level}")

        def divide(batches):
            for part in common.slices(batches, 64):
                rows = []
                for owner, n, h, o, data in zip(*(part.column(c).to_pylist() for c in ("piece", "n", "h", "o", "data"))):
                    rows += [dict(zip(("owner", "weight", "h", "f1", "f2", "a", "b", "o"), (owner, n, *x))) for x in blocks_of(data, h, o, width, length)]
                yield pa.RecordBatch.from_pylist(rows, schema=occ_schema)

        occ_schema = pa.schema([("owner", pa.binary()), ("weight", pa.int64()), ("h", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("o", pa.int32())])
        inner = hot.select("piece", "n", "h", "o", "data").mapInArrow(divide, f"owner binary, weight long, {PIECE}")
        inner = work.keep(inner.withColumn("doc_id", F.lit(None).cast("long")), f"blocks-{level}")
        data = hot.select(F.col("piece").alias("owner"), "data")
        ranges = _resolve(work, inner, lambda found: data, length, level + 1)
        single = hot.where("n = 1").select(F.col("piece"), F.col("owner").alias("of"), F.col("a").alias("shift"))
        out = out.unionByName(ranges.withColumnRenamed("owner", "piece").join(single, "piece").select(F.col("of").alias("owner"), (F.col("a") + F.col("shift")).alias("a"), (F.col("b") + F.col("shift")).alias("b")))
    return out


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("owner"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))


def cut_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(owner, spans, kept): for each text that loses bytes, named by its MD5, the removed runs (start, end) and the bytes that stay; rows that repeat an id and its text repeat it."""
    if length < 2 * ANCHOR:
        raise ValueError(f"length has to be {2 * ANCHOR} or more")
    work = common.Workspace(df.sparkSession)
    rows = _rows(df, id_col, text_col).where(F.col("n_bytes") >= length)

    def find(batches):
        for part in common.slices(batches):
            texts = [t.encode() for t in part.column(2).to_pylist()]
            for of, h, f1, f2, a, b, o in pieces_of(texts, length):
                whose = pa.array(of)
                ints = [pa.array(x.astype(np.int32)) for x in (a, b, o)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(whose), part.column(1).take(whose), pa.array(np.ones(len(h), dtype=np.int64)), pa.array(h), pa.array(f1), pa.array(f2), *ints], names=["doc_id", "owner", "weight", "h", "f1", "f2", "a", "b", "o"])

    occ = work.keep(rows.select("doc_id", "owner", "text").mapInArrow(find, f"doc_id long, owner binary, weight long, {PIECE}"), "pieces")

    def texts(found: DataFrame) -> DataFrame:
        """One row of each text that has a partner."""
        chosen = work.keep(found.groupBy("owner").agg(F.min("doc_id").alias("doc_id")), "chosen").alias("c")
        same = F.col("r.owner").eqNullSafe(F.col("c.owner")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id"))
        kept.append(work.keep(rows.alias("r").join(chosen, same, "left_semi").select("owner", F.col("text").cast("binary").alias("data")), "texts"))
        return kept[0]

    kept: list[DataFrame] = []
    starts = _resolve(work, occ, texts, length, 0)
    ranges = starts.groupBy("owner").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))

    def cut(batches):
        for part in common.slices(batches, 64):
            spans, stay = [], []
            for data, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                own, end = [], -1
                for r in sorted((r["a"], r["b"] + length) for r in found):
                    if r[0] > end:
                        own.append([*r])
                    else:
                        own[-1][1] = max(end, r[1])
                    end = own[-1][1]
                spans.append([{"start": x, "end": y} for x, y in own])
                stay.append(b"".join(data[x:y] for x, y in zip([0, *(y for _, y in own)], [*(x for x, _ in own), len(data)])))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(stay, pa.binary())], names=["owner", "spans", "kept"])

    return work.keep(kept[0].join(ranges, "owner").select("owner", "data", "ranges").mapInArrow(cut, "owner binary, spans array<struct<start:long,end:long>>, kept binary"), "cut")


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, spans, kept) of every row: removed runs of bytes (start, end), and the bytes that stay."""
    cut = cut_texts(df, id_col, text_col, length).dropDuplicates(["owner"])
    return _rows(df, id_col, text_col).join(cut, "owner", "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"), F.coalesce("kept", F.col("text").cast("binary")).alias("kept"))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    cut = cut_texts(df, id_col, text_col, length).select("owner", removed.alias("removed"), F.size("spans").cast("long").alias("spans"), F.sha2("kept", 256).alias("sha")).dropDuplicates(["owner"])
    cut = common.Workspace(df.sparkSession).keep(cut, "digests")
    rows = _rows(df, id_col, text_col).select("doc_id", "owner", "n_bytes", F.sha2("text", 256).alias("own"))
    none = F.lit(0).cast("long")
    return rows.join(cut, "owner", "left").select("doc_id", "n_bytes", F.coalesce("removed", none).alias("n_removed"), F.coalesce("spans", none).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))
