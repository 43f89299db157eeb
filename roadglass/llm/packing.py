"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Documents with equal texts form a group with three sizes, each taken as a share
of its total. A group goes to the shard whose residual capacity, as a share of
its capacity, has the highest dot product with these sizes; bytes, which the law
is about, weigh ``WEIGHTS`` times as much. Residuals may fall below zero: of all
shards the chosen one brings the weighted sum of squared residuals down most.

Every group is placed by itself. Those above 1/LARGE of a total, at most three
times LARGE whatever the input, are placed first, by the driver, from large to
small by the sum of the squares of their sizes. All others are dealt by the hash
of the text to parts of about ``ROWS`` rows (PARTS of them at most), and each
part is packed in a stream by one task; its capacities are its own totals, split
as the large groups left the residuals. These groups come in order of the hash:
all are small, and a mixture of shapes up to the last balances the three sizes
better than an order by size. Ties go to another shard first in each part.

A large group is divided where its shard could not be brought to even afterwards:
where it would take more of a size than the shard has left, or leave the shard's
three residuals more than UNEVEN of a shard apart (many short copies take rows
and hardly any bytes, and no other documents make up for that). Its rows are dealt
by doc_id into sub-groups of about 1/LARGE of all rows, each placed like a group of
its own. All other groups stay whole.

Slots are numbered by part and shard and moved up by the counts of the parts
before, so no task sorts a shard.

Results by case: a null text has no bytes and no tokens, and all null texts are
one group; repeated rows, also of an undivided id, get slots of their own; equal
shares are taken in order of the text's hash; an empty table gives an empty
result; texts of any length count whole; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: One over the share of a total above which the driver places a group.
LARGE = 4096
#: Rows of a part, and the most parts; beyond these parts grow, sorted on disk.
ROWS, PARTS = 8192, 4096
#: How far apart, in shards, a group that stays whole may leave the residuals of its shard, and how much more than these it may take.
UNEVEN, OVER = 0.4, 0.05
#: Weights of bytes, tokens and rows in the dot product.
WEIGHTS = np.array([4.0, 1.0, 1.0])


class Packer:
    """Residual capacities of the shards, and the choice of one for each group."""

    def __init__(self, capacity: np.ndarray, first: int = 0):
        """``capacity``: shards x 3; among equals the shard ``first`` comes first, then those after it."""
        self.order = np.roll(np.arange(len(capacity)), -first)
        # a shard that is full already counts as one of a thousandth of the mean
        self.capacity = np.maximum(capacity, np.maximum(capacity.mean(axis=0) / 1000, 1e-300))[self.order]
        self.share_left = capacity[self.order] / self.capacity

    def place(self, sizes: np.ndarray) -> int:
        best = int((self.share_left @ (sizes * WEIGHTS)).argmax())
        self.share_left[best] -= sizes / self.capacity[best]
        return int(self.order[best])

    def left(self) -> np.ndarray:
        out = np.empty_like(self.share_left)
        out[self.order] = self.share_left * self.capacity
        return out


def pack(sizes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each group, and the residuals left; sizes are shares of the totals, one row a group."""
    packer = Packer(np.full((shards, sizes.shape[1]), 1.0 / shards))
    out = np.zeros(len(sizes), dtype=np.int64)
    for i in np.argsort(-(sizes * sizes).sum(axis=1), kind="stable") if len(sizes) else []:
        out[i] = packer.place(sizes[i])
    return out, packer.left()


def too_large(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Which groups have to be divided: placed from large to small, each is held against what is left of its shard."""
    packer = Packer(np.full((shards, sizes.shape[1]), 1.0 / shards))
    out = np.zeros(len(sizes), dtype=bool)
    for i in np.argsort(-(sizes * sizes).sum(axis=1), kind="stable") if len(sizes) else []:
        before = packer.share_left.copy()
        at = int((before @ (sizes[i] * WEIGHTS)).argmax())
        packer.place(sizes[i])
        left, apart = packer.share_left[at], np.ptp(before[at])
        # small groups change little: it is the group that must have brought the residuals so far apart
        out[i] = left.min() < -OVER and before[at].min() > left.min() or np.ptp(left) > max(UNEVEN, apart)
        if out[i]:
            packer.share_left = before - sizes[i] / packer.capacity / shards
    return out


def capacities(total: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A part's capacity of each shard: its totals, split as the residuals are; evenly where nothing is left."""
    whole = left.sum(axis=0)
    even = np.full_like(left, 1.0 / len(left))
    return total * np.divide(left, whole, out=even, where=whole > 1e-12)


def _streamed(totals: list[float], parts: dict[int, np.ndarray], left: np.ndarray):
    """Worker over rows sorted by (part, group): shard and slot of each."""
    shards = len(left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, chosen, packer, used = None, None, 0, None, None
        for batch in batches:
            at, grp, given, n, size, tokens = (batch[c].to_numpy(zero_copy_only=False) for c in ("part", "grp", "given", "n", "size", "tokens"))
            shard, slot = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
            new_part = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else []
            for a, b in zip(new_part, [*new_part[1:], len(at)]):
                if at[a] != part:
                    part, group, used = int(at[a]), None, np.zeros(shards, np.int64)
                    packer = Packer(capacities(parts.get(part, np.zeros(3)), left), part % shards)
                starts = a + np.flatnonzero(np.concatenate(([True], grp[a + 1 : b] != grp[a : b - 1])))
                for i, j in zip(starts, [*starts[1:], b]):
                    if given[i] >= 0:
                        shard[i:j] = given[i:j]
                    else:
                        if grp[i] != group:
                            group = grp[i]
                            chosen = packer.place(np.array([n[i] * size[i] / totals[0], n[i] * tokens[i] / totals[1], n[i] / totals[2]]))
                        shard[i:j] = chosen
                for s in range(shards):
                    mine = a + np.flatnonzero(shard[a:b] == s)
                    slot[mine] = used[s] + np.arange(len(mine))
                    used[s] += len(mine)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["size"], batch["text_crc32"], pa.array(at, pa.int32()), pa.array(shard, pa.int32()), pa.array(slot, pa.int64())],
                names=["doc_id", "size", "text_crc32", "part", "shard", "slot"],
            )

    return run


def _small(spark, schema: str, rows: list[tuple]) -> DataFrame:
    """A table of the driver's rows; by Arrow, so that no Python worker starts for it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)], schema=kinds))


def assign(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``bytes``."""
    spark = df.sparkSession
    work = common.Workspace(spark)
    text = F.col(text_col)
    rows = work.keep(
        df.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.coalesce(F.regexp_count(text, F.lit(common.JAVA_WORD)), F.lit(0)).cast("long").alias("tokens"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("grp"),
        ),
        "rows",
    )
    # rows of a group have equal texts, so equal sizes: its count is all there is to sum
    groups = rows.groupBy("grp").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.sum("size").alias("s"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    totals = [float(max(1, x or 0)) for x in total]
    sizes = lambda n: (n * F.col("size") / totals[0], n * F.col("tokens") / totals[1], n / totals[2])
    share = F.greatest(*sizes(F.col("n")))
    large = groups.where(share > 1 / LARGE).select("grp", "size", "tokens", "n", share.alias("share")).orderBy("grp").collect()
    shares = np.array([[g["n"] * g["size"] / totals[0], g["n"] * g["tokens"] / totals[1], g["n"] / totals[2]] for g in large]).reshape(-1, 3)
    subs = {g["grp"]: max(shards, math.ceil(g["n"] / max(1.0, totals[2] / LARGE))) if divide and g["n"] > 1 else 1 for g, divide in zip(large, too_large(shares, shards))}
    heavy = rows.join(F.broadcast(_small(spark, "grp long, subs int", list(subs.items()))), "grp", "left")
    heavy = heavy.withColumn("sub", F.when(F.col("subs") > 1, F.pmod(F.xxhash64("doc_id"), F.col("subs"))).when(F.col("subs") == 1, F.lit(0)).cast("int")).drop("subs")
    split = [g for g, k in subs.items() if k > 1]
    counts = {(g["grp"], 0): g["n"] for g in large if subs[g["grp"]] == 1}
    if split:  # LARGE sub-groups and a few for each group at most
        counts |= {(r["grp"], r["sub"]): r["count"] for r in heavy.where(F.col("grp").isin(split)).groupBy("grp", "sub").count().collect()}
    of = {g["grp"]: g for g in large}
    items = sorted(counts)
    placed, left = pack(np.array([[counts[k] * of[k[0]]["size"] / totals[0], counts[k] * of[k[0]]["tokens"] / totals[1], counts[k] / totals[2]] for k in items]).reshape(-1, 3), shards)
    where = _small(spark, "grp long, sub int, given int", [(*k, int(s)) for k, s in zip(items, placed)])

    parts = int(max(1, min(PARTS, totals[2] // ROWS)))
    # rows whose shard is known go anywhere
    part = F.pmod(F.when(F.col("given") < 0, F.xxhash64("grp")).otherwise(F.xxhash64("doc_id", "grp")), F.lit(parts)).cast("int")
    dealt = heavy.join(F.broadcast(where), ["grp", "sub"], "left").withColumn("given", F.coalesce("given", F.lit(-1))).withColumn("part", part).drop("sub")
    sums = dealt.where(F.col("given") < 0).groupBy("part").agg(F.sum("size").alias("s"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    own = {r["part"]: np.array([r["s"] / totals[0], r["t"] / totals[1], r["n"] / totals[2]]) for r in sums.collect()}
    # a part is a task: dealt by its number, not by a hash of it
    dealt = dealt.repartitionById(parts, F.col("part")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("part", "grp")))
    dealt = dealt.sortWithinPartitions("part", "grp", "doc_id")
    out = work.keep(dealt.mapInArrow(_streamed(totals, own, left), "doc_id long, size long, text_crc32 long, part int, shard int, slot long"), "placed")
    used, starts = [0] * shards, []
    for r in sorted(out.groupBy("part", "shard").count().collect()):  # PARTS x shards rows at most
        starts.append((r["part"], r["shard"], used[r["shard"]]))
        used[r["shard"]] += r["count"]
    work.drop(rows)
    return out.join(F.broadcast(_small(spark, "part int, shard int, start long", starts)), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("slot")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(df: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents as Parquet, one folder a shard, with their slots, and return the assignment.

    Rows meet their places by id, and where ids repeat by a number among the rows of an id, equal texts side by side, which any of them can have.
    """
    work = common.Workspace(df.sparkSession)
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    order = Window.partitionBy("_id", "_crc").orderBy("_order")
    rows = df.withColumns({"_id": F.col(id_col).cast("long"), "_crc": crc, "_order": F.coalesce(F.xxhash64(text_col), F.lit(0))}).withColumn("_at", F.row_number().over(order)).drop("_order")
    places = work.keep(assign(df, shards, id_col, text_col), "places")
    mine = places.select(F.col("doc_id").alias("_i"), F.col("text_crc32").alias("_c"), "shard", "slot").withColumn("_n", F.row_number().over(Window.partitionBy("_i", "_c").orderBy("shard", "slot")))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_crc") == F.col("_c")) & (F.col("_at") == F.col("_n"))
    rows.join(mine, same).drop("_id", "_crc", "_at", "_i", "_c", "_n").write.partitionBy("shard").parquet(path)
    return places


