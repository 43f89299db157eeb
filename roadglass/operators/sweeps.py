"""Sweeps of settings for many keys: every setting against every row in one pass, and what the scores tell.

A sweep moves one parameter at a time away from where it starts. The steps of all
axes are an array of a few hundred entries that each row is multiplied by; scores
are weighted means by key, axis and step, combined before they are shuffled, so a
hot key costs no more than its rows.

Results by case: a key whose weights sum to zero has null scores, no peak and
passes nothing; of equal scores the first step is the peak; a sweep with a single
maximum, or whose second one is not above 1e-9, has an infinite prominence; a
table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A peak has to stand out by that much, and so many axes have to pass.
PROMINENCE, AXES = 1.05, 4


def scores(rows: DataFrame, by: Sequence[str], start: Sequence[Column], spans: Sequence[float], steps: int, score: Callable[[list[Column]], Column], weight: Column | None = None) -> DataFrame:
    """(by, axis, step, value, centre, score): the weighted mean score at each step of each axis.

    ``start`` are the parameters where a row's key begins, ``score`` makes a row's score from the parameters of a setting.
    """
    offsets = [(a, i, float(o)) for a, span in enumerate(spans) for i, o in enumerate(np.linspace(-span, span, steps))]
    table = F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(i).alias("step"), F.lit(o).alias("offset")) for a, i, o in offsets])
    names = [f"_s{i}" for i in range(len(start))]
    each = rows.withColumns(dict(zip(names, start)) | {"_w": F.lit(1.0) if weight is None else weight}).withColumn("_at", F.explode(table))
    at = [F.when(F.col("_at.axis") == i, F.col(n) + F.col("_at.offset")).otherwise(F.col(n)) for i, n in enumerate(names)]
    centre = F.get(F.array(*[F.col(n).cast("double") for n in names]), F.col("_at.axis"))
    each = each.select(*by, F.col("_at.axis").alias("axis"), F.col("_at.step").alias("step"), F.col("_at.offset").alias("offset"), centre.alias("centre"), "_w", score(at).alias("_score"))
    mean = F.try_divide(F.sum(F.col("_w") * F.col("_score")), F.sum("_w"))
    return each.groupBy(*by, "axis", "step").agg(F.min(F.col("centre") + F.col("offset")).alias("value"), F.min("centre").alias("centre"), mean.alias("score"))


def peaks(grid: DataFrame, by: Sequence[str], accept: Sequence[float]) -> DataFrame:
    """(by, axis, peak_value, displacement, n_local_maxima, prominence, passes) of each sweep.

    Prominence is the highest over the second highest of the different scores of local maxima and peak;
    ``accept`` is, by axis, how far from its centre a peak may lie.
    """
    w = Window.partitionBy(*by, "axis").orderBy("step")
    top = (F.col("score") > F.lag("score").over(w)) & (F.col("score") > F.lead("score").over(w))
    best = F.max("score").over(Window.partitionBy(*by, "axis"))
    rows = grid.withColumns({"_top": F.coalesce(top, F.lit(False)), "_best": best}).withColumn("_height", F.when(F.col("_top") | (F.col("score") == F.col("_best")), F.col("score")))
    heights = F.sort_array(F.collect_set("_height"), asc=False)
    out = rows.groupBy(*by, "axis").agg(
        F.min_by("value", F.when(F.col("score") == F.col("_best"), F.col("step"))).alias("peak_value"), F.min("centre").alias("_centre"), F.count_if(F.col("_top")).alias("n_local_maxima"), heights.alias("_heights"), F.max("score").alias("_score")
    )
    second = F.get("_heights", F.lit(1))
    out = out.withColumns({"displacement": F.when(F.col("_score").isNotNull(), F.abs(F.col("peak_value") - F.col("_centre"))), "prominence": F.when(second > 1e-9, F.get("_heights", F.lit(0)) / second).otherwise(F.lit(float("inf")))})
    allowed = F.get(F.array(*[F.lit(float(a)) for a in accept]), F.col("axis"))
    passes = F.coalesce((F.col("displacement") <= allowed) & (F.col("prominence") >= PROMINENCE), F.lit(False))
    return out.select(*by, "axis", F.when(F.col("_score").isNotNull(), F.col("peak_value")).alias("peak_value"), "displacement", "n_local_maxima", "prominence", passes.alias("passes"))


def verdicts(found: DataFrame, key: Sequence[str], kind: str, least: int = AXES) -> DataFrame:
    """(key, best_class, n_pass, verdict): the class with most axes that pass (of equals the first by name), and GO from ``least`` on."""
    each = found.groupBy(*key, kind).agg(F.count_if("passes").alias("n_pass"))
    best = each.groupBy(*key).agg(F.min(F.struct((-F.col("n_pass")).alias("n"), F.col(kind).alias("kind"))).alias("b"))
    return best.select(*key, F.col("b.kind").alias("best_class"), (-F.col("b.n")).alias("n_pass"), F.when(-F.col("b.n") >= least, "GO").otherwise("NO-GO").alias("verdict"))
