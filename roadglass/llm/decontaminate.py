"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over ten consecutive tokens: the masked positions are
hashed, the others ignored, so that a replaced word spoils only the seeds that
look at it. Every position of every document is hashed under each mask and
joined with the hashes of the benchmark; a hit aligns a document with an item,
and the whole alignment is verified: its best stretch, a match counting one and
a replaced token minus three, must have ``least`` matching tokens, or all of a
shorter item, with four in five of its tokens equal.

Tokens are lower-cased words without their punctuation. Items of eight or nine
tokens are looked up by all their tokens; shorter ones are too short to tell
and never match. Items with the same tokens count as their smallest item_id.

The benchmark is tokenised once, into a table, and goes to the executors in
blocks of at most ``block_tokens`` tokens, each with a pass over the documents,
so that no broadcast grows with it; a worker builds a block's index once. A
phrase that many items share gives as many alignments wherever it occurs: these
are expanded and verified HITS at a time, whatever text or seed they belong to,
and results leave text by text, so memory is bounded by the pieces, one text and
one block.

Results by case: null and empty texts match nothing, on either side; repeated
rows give repeated results; empty tables give none; of several alignments of a
text with an item the one with most matching tokens counts, of equals the one
with more tokens, then the last; of equal stretches of an alignment the one that
ends first, and of these the shortest; texts of any length are searched whole;
other columns, whatever their names, are not read (``clean`` carries them along).
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common

#: Fixed masks, weight seven, first and last position in use; the last one lets every fifth token be replaced.
MASKS = ("1101101101", "1110010111", "1011101011", "1111001101", "1101111011")
SPAN = 10
SHORTEST = 8
#: Tokens whose hash a worker remembers.
REMEMBERED = 200_000
FILTER_BITS = 22
#: Alignments that are expanded at a time, and tokens compared at a time.
HITS, COMPARED = 200_000, 2_000_000
_NOISE = re.compile(r"[\W_]+")


class _Hashes(dict):
    """64-bit hash of a token as written; 0 where nothing is left of it."""

    def __missing__(self, raw: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        word = _NOISE.sub("", raw.lower()).encode("utf-8", "replace")
        self[raw] = value = (zlib.crc32(word) << 32 | zlib.crc32(b"\1" + word)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF if word else 0
        return value


_hashes = _Hashes()


def tokens(text: str) -> np.ndarray:
    words = text.split()
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    return h[h != 0]


def _shapes() -> list[np.ndarray]:
    return [np.flatnonzero([c == "1" for c in m]) for m in MASKS] + [np.arange(n) for n in range(SHORTEST, SPAN)]


def seeds(h: np.ndarray, shape: np.ndarray, number: int) -> np.ndarray:
    """Hash of each position under a shape."""
    n = len(h) - int(shape[-1])
    out = np.full(max(0, n), number + 1, dtype=np.uint64)
    for offset in shape if n > 0 else ():
        out *= np.uint64(0x100000001B3)
        out ^= h[offset : offset + n]
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
    return out


class Index:
    """Seeds of a block of items, with a bitmap in front."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, flat: np.ndarray, least: int):
        """``flat``: tokens of all items, one after the other, up to ``ends``."""
        self.ids, self.flat, self.least = ids, flat, least
        self.sizes = np.diff(ends, prepend=0)
        self.starts = ends - self.sizes
        self.shapes = _shapes()
        item_of = np.repeat(np.arange(len(ids)), self.sizes)
        parts = []
        for number, shape in enumerate(self.shapes):
            at = np.arange(max(0, len(flat) - int(shape[-1])))
            fits = (item_of[at] == item_of[at + int(shape[-1])]) & (self.sizes[item_of[at]] >= SPAN if number < len(MASKS) else self.sizes[item_of[at]] == len(shape))
            at = at[fits]
            parts.append((seeds(flat, shape, number)[fits], item_of[at], at - self.starts[item_of[at]]))
        seed, item, spot = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.spot = seed[order], item[order].astype(np.int32), spot[order].astype(np.int32)
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self.seed >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of ``h`` with a seed of the benchmark, and where its places are in the index: position, from, how many."""
        found = []
        for number, shape in enumerate(self.shapes):
            s = seeds(h, shape, number)
            at = np.flatnonzero(self.filter[s >> np.uint64(64 - FILTER_BITS)])
            # a seed lies in one text
            at = at[np.searchsorted(ends, at, "right") == np.searchsorted(ends, at + int(shape[-1]), "right")] if len(at) else at
            low, high = np.searchsorted(self.seed, s[at], "left"), np.searchsorted(self.seed, s[at], "right")
            found.append(np.stack([at, low, high - low])[:, high > low])
        found = np.concatenate(found, axis=1)
        return tuple(found[:, np.argsort(found[0], kind="stable")])

    def verify(self, h: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
        """(counts, matching tokens, tokens, first token) of the best stretch of each alignment; the text is h[low:high]."""
        a, b = np.maximum(low, start), np.minimum(high, start + self.sizes[item])
        n = b - a
        ends = np.cumsum(n)
        first = ends - n
        each = np.repeat(np.arange(len(n)), n)
        step = np.arange(ends[-1]) - first[each]
        same = h[a[each] + step] == self.flat[(self.starts[item] + a - start)[each] + step]
        score = np.where(same, 1, -3)
        after = np.cumsum(score)
        after -= (after[first] - score[first])[each]
        before = after - score
        # the smallest sum so far; an offset that falls from one alignment to the next keeps them apart
        apart = each * (8 * int(n.max()) + 8)
        least = np.minimum.accumulate(before - apart) + apart
        gain = after - least
        best = np.maximum.reduceat(gain, first)
        place = np.arange(len(gain))
        end = np.minimum.reduceat(np.where(gain == best[each], place, len(gain)), first)
        begin = np.maximum.accumulate(np.where(before == least, place, 0))[end]
        matches = np.cumsum(same)
        matching, size = matches[end] - matches[begin] + same[begin], end - begin + 1
        good = (best > 0) & (matching >= np.minimum(self.least, self.sizes[item])) & (5 * matching >= 4 * size)
        return good, matching, size, a + begin - first - low

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, dict[int, tuple[int, int, int]]]]:
        """(number of the text, {item number: its best stretch}) of each text with any, in order."""
        each = [tokens(t or "") for t in texts]
        ends = np.cumsum([len(h) for h in each])
        h = np.concatenate(each) if each else np.empty(0, np.uint64)
        position, low, count = self.hits(h, ends)
        doc = np.searchsorted(ends, position, "right")
        total = np.cumsum(count)
        at, docs, out = 0, len(texts), {}
        current = -1
        while at < (int(total[-1]) if len(total) else 0):
            upto = min(at + HITS, int(total[-1]))
            place = np.arange(at, upto)
            row = np.searchsorted(total, place, "right")
            entry = low[row] + place - (total[row] - count[row])
            found = np.unique(np.stack([doc[row], self.item[entry].astype(np.int64), position[row] - self.spot[entry]]), axis=1)
            sizes = np.cumsum(self.sizes[found[1]])
            cut = 0
            while cut < found.shape[1]:
                to = max(cut + 1, int(np.searchsorted(sizes, (sizes[cut - 1] if cut else 0) + COMPARED, "right")))
                d, item, start = found[:, cut:to]
                good, *result = self.verify(h, ends[d] - np.array([len(each[k]) for k in d]), ends[d], item, start)
                for k, i, r in zip(d[good].tolist(), item[good].tolist(), zip(*(x[good].tolist() for x in result))):
                    if k != current:
                        if out:
                            yield current, out
                        current, out = k, {}
                    if r > out.get(i, (0, 0, 0)):
                        out[i] = r
                cut = to
            at = upto
        if out:
            yield current, out


_indexes: dict[str, Index] = {}


def _index(name: str, sent, least: int) -> Index:
    """The index of a broadcast block, built once for each worker; one at a time."""
    if name not in _indexes:
        _indexes.clear()
        _indexes[name] = Index(*sent.value, least)
    return _indexes[name]


def item_blocks(bench: DataFrame, block_tokens: int = 2_000_000, id_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, ends, tokens) of the distinct items by their tokens, in blocks of about ``block_tokens``; the driver holds one block at a time."""

    def make():
        return lambda rows: {"id": rows[id_col], "h": [tokens(t).astype(np.int64).tolist() for t in rows[text_col]]}

    work = common.Workspace(bench.sparkSession)
    rows = bench.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    items = common.map_texts(rows, [id_col, text_col], "id long, h array<long>", make).where(F.size("h") >= SHORTEST).groupBy("h").agg(F.min("id").alias("id"))
    items = work.keep(items, "items")
    total = items.agg(F.sum(F.size("h"))).first()[0] or 0
    blocks = -(-total // block_tokens)
    for k in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == k)
        found = sorted(block.collect(), key=lambda r: r["id"])
        if found:
            yield np.array([r["id"] for r in found]), np.cumsum([len(r["h"]) for r in found]), np.concatenate([np.array(r["h"], dtype=np.int64) for r in found]).astype(np.uint64)
    work.drop(items)


FOUND = ("doc_id", "item_id", "n_matching", "n_tokens", "first_token")


def contaminated(docs: DataFrame, bench: DataFrame, least: int = 10, block_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_matching, n_tokens, first_token) of every document and item that overlap."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_matching int, n_tokens int, first_token int"
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    out = spark.createDataFrame(pa.table([pa.array([], k) for k in kinds], names=FOUND)).to(StructType.fromDDL(schema))
    for block in item_blocks(bench, block_tokens):
        sent, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, sent=sent, name=name):
            index = _index(name, sent, least)
            for part in common.slices(batches):
                ids = part[id_col].to_pylist()
                for k, hits in index.search(part[text_col].to_pylist()):
                    items = sorted(hits)
                    rows = [[ids[k]] * len(items), index.ids[items].tolist(), *zip(*(hits[i] for i in items))]
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(rows, kinds)], names=FOUND)

        out = out.unionAll(docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, bench: DataFrame, least: int = 10, block_tokens: int = 2_000_000, text_col: str = "text") -> DataFrame:
    """The rows whose text overlaps no item, with all columns."""
    schema = docs.schema
    for block in item_blocks(bench, block_tokens):
        sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, sent=sent, name=name):
            index = _index(name, sent, least)
            for part in common.slices(batches):
                found = {k for k, _ in index.search(part[text_col].to_pylist())}
                yield part.filter(pa.array([k not in found for k in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
