"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its components.

A document is the set of its distinct shingles of ``words`` words, four unless
told otherwise. Documents with equal sets
are one class, known by a 64-bit hash of the set; all else works on classes.

Prefixes. Shingles are put in one order for all: those that an estimate over a
sixth of the documents finds common come last, the commonest at the very
end. Of a set of n shingles, of which a partner must share at least
t = ceil(percent n / 100), the first n - t + l are its l-prefix, and two sets that link
share at least l shingles of their l-prefixes. Each class chooses l by the
estimated cost of its prefix, the number of candidates that its common shingles
would bring; a pair needs as many shared prefix shingles as the smaller l of the
two before it is verified.

Large groups. A node with very many pairs has them dealt to several tasks, by
the other node, wherever sets or bits are joined to them. First every class is compared with one centre: of the centres of
its buckets (classes that share a prefix shingle) the one met in most, where the
centre of a bucket is its class with the commonest shingles. What links is
merged. Only then pairs are formed, and only of classes in different components,
so that a group of near copies is never expanded. A bucket deals such pairs out
in blocks of classes, and tests them by length and by a lower bound of the
symmetric difference (parity bits of the shingle hashes, first 1024 of them, then as many
as shingles) before it is verified. Neither step drops a pair that links; each pair left is verified on
the sets themselves.

Hash collisions aside (64 bits: among 10^9 different sets one in about 40 such
corpora has any), results are exact.

Results by case: texts without words have an empty set, link with nothing and
are components of their own; a row without an id belongs to the class of its
text; with fewer words than a shingle has the whole sequence is the one shingle; repeated
rows are one class; an empty table gives none; texts of any length are read
whole; of equal centres and equal shingles the order of hashes decides; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: Words of a shingle.
WORDS = 4
BITS = 1024
#: Words whose hash a worker remembers.
REMEMBERED = 200_000
#: Bits of the filter that picks the texts to verify: 1 MB whatever the input.
PICK_BITS = 23
#: Classes in a block of a bucket.
BLOCK = 512
#: Set bits of each byte.
ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone, and the white space of the contract
    h = np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(size, len(h))
    if not size:
        return h
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + n]) * _MULTIPLY
        out ^= out >> np.uint64(29)
    return np.unique(out)


def needed(n: int, percent: int) -> int:
    """Fewest shingles that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


class Order:
    """The order of shingles, and what it makes of a set."""

    def __init__(self, common_shingles: np.ndarray, counts: np.ndarray, percent: int, most: int):
        at = np.argsort(common_shingles)
        self.common, self.counts = common_shingles[at], counts[at]
        self.percent, self.most = percent, most
        self.front = np.zeros(1 << 20, dtype=bool)
        self.front[self.common >> np.uint64(44)] = True

    def estimates(self, h: np.ndarray) -> np.ndarray:
        """Documents of the corpus that have each shingle; 0 where the sample doesn't find it common."""
        out = np.zeros(len(h), dtype=np.int64)
        maybe = np.flatnonzero(self.front[h >> np.uint64(44)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.common, h[maybe]), len(self.common) - 1)
            out[maybe] = np.where(self.common[at] == h[maybe], self.counts[at], 0)
        return out

    def describe(self, h: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(l, weight as a centre, prefix, its estimates) of a set."""
        estimate = self.estimates(h)
        order = np.argsort(estimate, kind="stable")  # h is sorted: equal estimates go by hash
        base = len(h) - needed(len(h), self.percent) + 1
        cost = int(estimate[order[:base]].sum())
        matches = 1 + min(self.most - 1, cost.bit_length() // 2)
        matches = min(matches, len(h) - base + 1)
        first = order[: base + matches - 1]
        return matches, int(estimate.sum() * 1000 // max(1, len(h))), h[first], estimate[first]


def parity(h: np.ndarray, width: int = BITS) -> bytes:
    """Bits that count the shingles of each residue modulo 2; two sets differ in as many bits at most as in shingles."""
    bits = np.bincount((h & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def fine_parity(h: np.ndarray) -> bytes:
    """Parity bits as many as shingles, or up to twice that."""
    return parity(h, max(BITS, 1 << (len(h) - 1).bit_length())) if len(h) else b""


def fine_distance(x: bytes, y: bytes) -> int:
    """Differing bits of two fine parities; the wider is folded until both are equally wide, which keeps parity."""
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(p) != len(q):
        if len(p) < len(q):
            p, q = q, p
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    return int(ONES[p ^ q].sum(dtype=np.int64))


def class_of(h: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "big", signed=True)


def common_shingles(docs: DataFrame, work: common.Workspace, words: int = WORDS, share: float = 1 / 6, seen: int = 3, most: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, estimated number of documents) of at most ``most`` of the commonest shingles of a ``share`` of the documents.

    It only orders shingles, so the sample changes what a join costs and never
    what it finds. A share, since what a number of documents shows as common
    grows rarer as the corpus grows. A histogram of counts tells which count is
    the least of which no more than ``most`` shingles reach the driver.
    """
    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30) < share)

    def make():
        def work(rows):
            values, counts = np.unique(np.concatenate([shingles(t, words) for t in rows["text"]] or [np.empty(0, np.uint64)]), return_counts=True)
            return {"h": values.astype(np.int64).tolist(), "n": counts.tolist()}

        return work

    found = common.map_texts(chosen, ["text"], "h long, n long", make).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)
    found = work.keep(found, "common")
    # exact counts up to 1000, then a hundred bins an e-fold: a few thousand rows
    level = F.when(F.col("n") <= 1000, F.col("n")).otherwise(1000 + F.floor(100 * F.log(F.col("n") / 1000))).cast("long")
    least, total = None, 0
    for row in sorted(found.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    rows = found.where(level >= least if least is not None else F.lit(False)).toPandas()
    return rows["h"].to_numpy(np.int64).astype(np.uint64), np.ceil(rows["n"].to_numpy(np.float64) / share).astype(np.int64)


def describe(docs: DataFrame, percent: int, most_matches: int, work: common.Workspace, words: int = WORDS) -> DataFrame:
    """(doc_id, n, node, weight, l, prefix, salts, bits, fine) of every row."""
    order = Order(*common_shingles(docs, work, words), percent, most_matches)

    def make():
        def work(rows):
            out = {c: [] for c in ("n", "node", "weight", "l", "prefix", "salts", "bits", "fine")}
            for text in rows["text"]:
                h = shingles(text, words)
                matches, weight, prefix, estimates = order.describe(h) if len(h) else (0, 0, h, h)
                out["n"].append(len(h))
                out["node"].append(class_of(h) if len(h) else None)
                out["weight"].append(weight)
                out["l"].append(matches)
                out["prefix"].append((prefix >> np.uint64(24)).astype(np.int64))  # 40 bits tell buckets apart well enough
                out["salts"].append((estimates // 4096 + 1).astype(np.int32))
                out["bits"].append(parity(h))
                out["fine"].append(fine_parity(h))
            return {"doc_id": rows["doc_id"]} | out

        return work

    return common.map_texts(docs, ["doc_id", "text"], "doc_id long, n long, node long, weight long, l int, prefix array<long>, salts array<int>, bits binary, fine binary", make)


def can_link(n1: np.ndarray, n2: np.ndarray, bits1: np.ndarray, bits2: np.ndarray, percent: int) -> np.ndarray:
    """False only where two sets can't link: by length, or as |A ^ B| <= (100 - percent) / (100 + percent) * (|A| + |B|) fails."""
    differ = ONES[(bits1 ^ bits2).view(np.uint8)].reshape(len(n2), -1).sum(axis=1, dtype=np.int64)
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & ((100 + percent) * differ <= (100 - percent) * (n1 + n2))


class Degrees:
    """How often nodes occur in pairs, for the few that occur so often that their pairs are dealt to several tasks."""

    def __init__(self, pairs: DataFrame, often: int = 4096):
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("k"))
        least = max(often, 2 * pairs.count() // 1000)
        # nodes with more than a thousandth of all ends: fewer than a thousand of them
        self.rows = [(r["node"], -(-r["k"] // often)) for r in nodes.where(F.col("k") > least).collect()]

    def salted(self, frame: DataFrame, node: str, other: str | None = None) -> DataFrame:
        """Adds ``_salt``: of pairs by their other node, and a copy for each of other tables; 0 for all other nodes."""
        if not self.rows:
            return frame.withColumn("_salt", F.lit(0))
        heavy = frame.sparkSession.createDataFrame(pa.table({"_node": pa.array([n for n, _ in self.rows], pa.int64()), "_k": pa.array([k for _, k in self.rows], pa.int32())}))
        out = frame.join(F.broadcast(heavy), F.col(node) == F.col("_node"), "left")
        k = F.coalesce("_k", F.lit(1))
        salt = F.pmod(F.xxhash64(other), k).cast("int") if other else F.explode(F.sequence(F.lit(0), k - 1))
        return out.withColumn("_salt", salt).drop("_node", "_k")

    def join(self, pairs: DataFrame, frame: DataFrame, side: str) -> DataFrame:
        """Pairs with the row of their node on one side; ``frame`` has that node in a column of the side's name."""
        both = self.salted(pairs, side, "b" if side == "a" else "a").join(self.salted(frame, side), [side, "_salt"])
        return both.drop("_salt")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can link by length and fine parity bits."""
    side = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("fine").alias(f"fine{c}")) for c in "ab"]
    degrees = Degrees(pairs)
    rows = degrees.join(degrees.join(pairs.select("a", "b"), side[0], "a"), side[1], "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches):
        for batch in common.slices(batches, 1024):
            most = (100 - percent) * (np.asarray(batch["na"]) + np.asarray(batch["nb"]))
            near = [(100 + percent) * fine_distance(x, y) <= m for x, y, m in zip(batch["finea"].to_pylist(), batch["fineb"].to_pylist(), most.tolist())]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    return rows.select("a", "b", "na", "nb", "finea", "fineb").mapInArrow(run, "a long, b long")


def verified(docs: DataFrame, members: DataFrame, pairs: DataFrame, percent: int, work: common.Workspace, words: int = WORDS) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their whole sets."""
    # one document of each class that takes part, found by a filter of fixed size and then exactly
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(members, "node").select("node", "member")
    nodes = work.keep(nodes, "verify")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << PICK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place("member"), F.lit(64)).cast("int"))
    flags = nodes.groupBy(F.floor(place("member") / 64).alias("w")).agg(F.bit_or(bit).alias("v"))  # 2^17 rows at most
    rows = docs.where(F.col("doc_id").isNotNull()).join(F.broadcast(flags), F.floor(place("doc_id") / 64) == F.col("w"))
    rows = rows.where(F.call_function("shiftright", F.col("v"), F.pmod(place("doc_id"), F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)

    def make():
        def sets(rows):
            each = [shingles(t, words) for t in rows["text"]]
            return {"member": rows["doc_id"], "node": [class_of(h) if len(h) else None for h in each], "h": [h.tobytes() for h in each]}

        return sets

    sets = common.map_texts(rows, ["doc_id", "text"], "member long, node long, h binary", make)
    # a repeated id can have several texts: the class decides; a repeated row counts once
    sets = sets.dropDuplicates(["member", "node"]).join(nodes, ["member", "node"]).select("node", "h")
    degrees = Degrees(pairs)
    left = degrees.join(pairs, sets.select(F.col("node").alias("a"), F.col("h").alias("ha")), "a")
    full = degrees.join(left, sets.select(F.col("node").alias("b"), F.col("h").alias("hb")), "b")

    def compare(batches):
        for batch in common.slices(batches, 512):
            keep = []
            for x, y in zip(batch["ha"].to_pylist(), batch["hb"].to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "ha", "hb").mapInArrow(compare, "a long, b long")


def block_pairs(percent: int):
    """Worker over rows sorted by (token, x, y): pairs of a bucket's two blocks that can link.

    All buckets of a batch are treated at once: row i meets row i + d of its
    bucket for d = 1, 2, ... A bucket cut by the end of a batch waits for the next.
    """

    def pairs_of(part: dict[str, np.ndarray], bits: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        out, i, d = [], np.arange(len(end)), 1
        while len(i := i[i + d < end[i]]):
            j = i + d
            ok = (part["comp"][i] != part["comp"][j]) & (part["left"][i] & part["right"][j] | part["left"][j] & part["right"][i])
            p, q = i[ok], j[ok]
            if len(p):
                ok = can_link(part["n"][p], part["n"][q], bits[p], bits[q], percent)
                out.append(np.stack([p[ok], q[ok]]))
            d += 1
        p, q = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)
        x, y = part["node"][p], part["node"][q]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64()), pa.array(np.minimum(part["l"][p], part["l"][q]), pa.int32())], names=["a", "b", "l"]
        )

    def run(batches):
        rest: pa.Table | None = None
        for batch in chain(common.slices(batches, 8192), [None]):
            if batch is None and rest is None:
                return
            rows = pa.Table.from_batches([batch]) if batch is not None else rest
            if batch is not None and rest is not None:
                rows = pa.concat_tables([rest, rows])
            part = {c: rows[c].to_numpy() for c in rows.column_names if c != "bits"}
            new = np.ones(len(rows), dtype=bool)
            new[1:] = np.logical_or.reduce([part[c][1:] != part[c][:-1] for c in ("token", "x", "y")])
            starts = np.flatnonzero(new)
            if batch is not None:
                rest = rows.slice(int(starts[-1]))
                rows = rows.slice(0, int(starts[-1]))
                part = {c: v[: len(rows)] for c, v in part.items()}
                starts = starts[:-1]
            if len(rows):
                bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint8).reshape(len(rows), -1)
                yield pairs_of(part, bits, np.repeat(np.append(starts[1:], len(rows)), np.diff(np.append(starts, len(rows)))))

    return run


def join_components(docs: DataFrame, percent: int = 85, most_matches: int = 8, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; sets are of shingles of ``words`` words."""
    work = common.Workspace(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = work.keep(describe(docs, percent, most_matches, work, words), "rows")
    named = rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = named.groupBy("node").agg(F.min("doc_id").alias("member"), *[F.first(c).alias(c) for c in ("n", "weight", "l", "prefix", "salts", "bits", "fine")])
    nodes = work.keep(nodes, "nodes")

    # buckets of two classes or more; a common shingle's bucket is salted for the choice of centres
    entry = nodes.select("node", "n", "weight", "l", F.explode(F.arrays_zip("prefix", "salts")).alias("e"))
    entry = entry.select("node", "n", "weight", "l", F.col("e.prefix").alias("token"), F.pmod(F.xxhash64("node"), F.col("e.salts")).cast("int").alias("salt"), (F.col("e.salts") > 1).alias("salted"))
    from pyspark.sql import Window

    bucket = Window.partitionBy("token", "salt")
    rank = F.struct("weight", "node")
    buckets = entry.withColumns({"m": F.count(F.lit(1)).over(bucket), "centre": F.max(rank).over(bucket)}).where((F.col("m") > 1) | F.col("salted"))
    buckets = work.keep(buckets.select("node", "n", "l", "token", "salted", F.col("centre.node").alias("centre"), F.col("centre.weight").alias("weight")), "buckets")

    # each class with the centre that it meets in most buckets; centres of one salted shingle with the first of them
    heads = buckets.where(F.col("salted") & (F.col("node") == F.col("centre")))
    head = Window.partitionBy("token")
    heads = heads.select("node", F.max(F.struct("weight", "node")).over(head)["node"].alias("centre"))
    met = buckets.select("node", "centre").unionByName(heads).where(F.col("node") != F.col("centre")).groupBy("node", "centre").agg(F.count(F.lit(1)).alias("k"))
    best = met.groupBy("node").agg(F.max(F.struct("k", "centre")).alias("best")).select(F.least("node", "best.centre").alias("a"), F.greatest("node", "best.centre").alias("b")).distinct()
    members = nodes.select("node", "member")
    stars = work.keep(plausible(work.keep(best, "best"), nodes, percent), "stars")
    first = work.keep(verified(docs, members, stars, percent, work, words), "links1")
    labels = components(work, first)

    # pairs of classes in different components
    placed = buckets.join(labels, "node", "left").select("token", "node", "n", "l", F.coalesce("label", "node").alias("comp"))
    placed = work.keep(placed, "placed")
    sizes = placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.sum("k").alias("m"), F.max(F.struct("k", "comp")).alias("top"))
    sizes = sizes.where(F.col("comps") > 1).select("token", F.col("top.comp").alias("top"), F.ceil((F.col("m") - F.col("top.k")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("top.k") / BLOCK).cast("int").alias("many"))
    sizes = work.keep(sizes, "sizes")
    open_ = placed.join(sizes, "token").join(nodes.select("node", "bits"), "node")
    # blocks 0..few-1 hold all but the largest component, the rest the largest, which isn't paired with itself
    mine = F.col("comp") == F.col("top")
    spread = F.xxhash64("node")
    block = F.when(mine, F.col("few") + F.pmod(spread, F.col("many"))).otherwise(F.pmod(spread, F.col("few"))).cast("int")
    open_ = open_.withColumn("block", block)
    every = F.sequence(F.lit(0), F.when(mine, F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1))
    dealt = open_.withColumn("other", F.explode(every)).select(
        "token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"), "node", "n", "l", "comp", "bits",
    )
    dealt = dealt.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    found = dealt.mapInArrow(block_pairs(percent), "a long, b long, l int")
    pairs = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"), F.min("l").alias("l")).where(F.col("k") >= F.col("l")).select("a", "b")
    pairs = work.keep(plausible(work.keep(pairs, "found"), nodes, percent), "pairs")
    second = work.keep(verified(docs, members, pairs, percent, work, words), "links2")

    # components of components
    label_a, label_b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
    bridged = second.join(label_a, "a", "left").join(label_b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    upper = components(work, bridged).select(F.col("node").alias("low"), F.col("label").alias("high"))
    place = members.join(labels, "node", "left").select("node", "member", F.coalesce("label", "node").alias("low")).join(upper, "low", "left")
    place = work.keep(place.select("node", "member", F.coalesce("high", "low").alias("comp")), "places")
    smallest = place.groupBy("comp").agg(F.min("member").alias("component_id"))
    final = work.keep(place.join(work.keep(smallest, "smallest"), "comp").select("node", "component_id"), "final")
    work.only(rows, final)
    own = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(final, "node", "left")
    return own.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))



def representatives(df: DataFrame, percent: int = 85, words: int = WORDS) -> DataFrame:
    """The rows whose doc_id is the smallest of their component, with all columns.

    Texts without words are components of their own, and rows without an id
    have no smallest id to lose to; all of these stay. Ids are expected to be
    unique: rows that repeat an id stay or go together.
    """
    found = join_components(df, percent, words=words)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return df.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
