"""Quality gates, review reports and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import series as S


def circular_mean(angle: Column) -> Column:
    """Aggregate: direction of the mean unit vector."""
    return F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle)))


def percentiles(value: str, shares: Sequence[float]) -> list[Column]:
    """Aggregates p50, p95 and so on, interpolated linearly."""
    return [F.percentile(value, F.lit(p)).alias(f"p{p * 100:g}".replace(".", "_")) for p in shares]


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with the other columns of the right row of equal keys; nulls are equal. Without keys the right side is one row."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    right = right.withColumnsRenamed({c: f"_key_{c}" for c in keys})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys])
    return left.join(right, same).drop(*[f"_key_{c}" for c in keys])


def exact_percentiles(rows: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], pieces: int = 256) -> DataFrame:
    """(by, p50, p95 and so on) of groups too large for one buffer, interpolated linearly, and exact.

    A sketch of each group cuts its values into ``pieces``; the pieces' counts
    tell in which of them the wanted ranks lie, and only these are put in order,
    each by itself, over distinct values. For many small groups use percentiles.
    """
    kept = rows.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).cast("double").alias("_v"))
    cuts = kept.groupBy(*by).agg(F.percentile_approx("_v", [i / pieces for i in range(1, pieces)], 40 * pieces).alias("_cuts"))
    piece = F.aggregate("_cuts", F.lit(0), lambda n, c: n + (c < F.col("_v")).cast("int"))
    sized = kept.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    values = _beside(sized, cuts, by)
    values = values.select(*by, "_v", "_n", piece.alias("_piece"))
    counts = values.groupBy(*by, "_piece").agg(F.sum("_n").alias("_m"))
    whole, before = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select(*by, "_piece", "_m", F.sum("_m").over(whole).alias("_all"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_from"))
    ranks = [(F.lit(p) * (F.col("_all") - 1)) for p in shares]
    wanted = [f(r) for r in ranks for f in (F.floor, F.ceil)]
    hit = spans.where(F.exists(F.array(*[w.cast("long") for w in wanted]), lambda w: (w >= F.col("_from")) & (w < F.col("_from") + F.col("_m"))))
    inside = _beside(values, hit, [*by, "_piece"])
    first = F.col("_from") + F.coalesce(F.sum("_n").over(Window.partitionBy(*by, "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = inside.select(*by, "_v", "_n", "_all", first.alias("_first"))
    at = lambda w: F.max(F.when((w >= F.col("_first")) & (w < F.col("_first") + F.col("_n")), F.col("_v")))
    out = placed.groupBy(*by, "_all").agg(*[at(w).alias(f"_w{i}") for i, w in enumerate(wanted)])
    mixed = [F.col(f"_w{2 * i}") + (F.col(f"_w{2 * i + 1}") - F.col(f"_w{2 * i}")) * (r - F.floor(r)) for i, r in enumerate(ranks)]
    return out.select(*by, *[m.alias(f"p{p * 100:g}".replace(".", "_")) for m, p in zip(mixed, shares)])


def speed_gate(rows: DataFrame, by: Sequence[str], x: str, y: str, unit: int, fastest: float, widest_gap: float, t: str = "t", seq: str | None = None) -> DataFrame:
    """For each series: rows, share of steps above ``fastest``, median and p95 speed, widest gap in seconds, and the verdict on it."""
    w = S.order(by, t, seq)
    steps = rows.withColumns({"_v": S.step_speed(x, y, by, unit, t, seq), "_gap": F.col(t) - F.lag(t).over(w)})
    gap = F.max("_gap") / unit
    return steps.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.when(F.col("_v") > fastest, 1.0).otherwise(0.0)), 6).alias("reject_ratio"),
        F.round(F.percentile("_v", F.lit(0.5)), 6).alias("median_speed"),
        F.round(F.percentile("_v", F.lit(0.95)), 6).alias("p95_speed"),
        gap.alias("max_gap"),
        F.when(gap > widest_gap, "FAIL").otherwise("PASS").alias("overall"),
    )


def review_summary(rows: DataFrame, ok: str, issues: str) -> DataFrame:
    """Long form (metric, item, value) of a review: totals, share of frames that are ok, issues by category and severity.

    A null ``ok`` means not evaluated. ``issues`` is an array of structs with
    category and severity; missing ones count as other and low.
    """
    totals = rows.agg(F.count(F.lit(1)).alias("n_total"), F.count(ok).alias("n_evaluated"), F.try_divide(F.count_if(F.col(ok)), F.count(ok)).alias("ok_ratio"))
    wide = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.lit("").alias("item"), F.col(c).cast("double").alias("value")) for c in ("n_total", "n_evaluated", "ok_ratio")])).alias("s")).select("s.*")
    each = rows.select(F.explode(issues).alias("i")).select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(f"i.{m}"), F.lit(d)).alias("item")) for m, d in (("category", "other"), ("severity", "low"))])).alias("s"))
    return wide.unionByName(each.groupBy("s.metric", "s.item").agg(F.count(F.lit(1)).cast("double").alias("value")))


def sweep_peaks(grid: DataFrame, step: str, score: str) -> DataFrame:
    """Of a sweep: the best step (the first of equals), how many inner local maxima it has, and the ratio of the largest to the smallest of them.

    A sweep is one small grid of settings, so one task orders it.
    """
    w = Window.orderBy(step)
    peak = (F.col(score) > F.lag(score).over(w)) & (F.col(score) > F.lead(score).over(w))
    rows = grid.withColumn("_peak", F.coalesce(peak, F.lit(False)))
    at = lambda f: f(F.when(F.col("_peak"), F.col(score)))
    return rows.agg(F.min_by(step, F.struct(-F.col(score), F.col(step))).alias("best_step"), F.count_if(F.col("_peak")).alias("n_peaks"), F.round(at(F.max) / at(F.min), 6).alias("ratio"))


def contrast(grid: DataFrame, by: Sequence[str], score: str, least: float) -> DataFrame:
    """(by, ratio, verdict): the best score of a sweep over its worst, and GO where that is ``least`` or more; null and NO where the worst is 0."""
    ratio = F.try_divide(F.max(score), F.min(score))
    return grid.groupBy(*by).agg(ratio.alias("ratio")).withColumn("verdict", F.when(F.col("ratio") >= least, "GO").otherwise("NO"))


def mutual_information(rows: DataFrame, a: str, b: str, bins: int = 16, least: int = 20) -> DataFrame:
    """One row: mutual information in nats of two columns over equal-width bins; 0 below ``least`` rows."""
    ends = rows.agg(*[f(c).alias(f"{n}{c}") for c in (a, b) for n, f in (("lo_", F.min), ("hi_", F.max))])
    cell = lambda c: F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide((F.col(c) - F.col(f"lo_{c}")) * bins, F.col(f"hi_{c}") - F.col(f"lo_{c}"))), F.lit(0))).cast("int")
    # one row of ends, at most bins x bins cells
    cells = rows.select(a, b).join(F.broadcast(ends)).groupBy(cell(a).alias("i"), cell(b).alias("j")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(1))
    cells = cells.withColumns({"_r": F.sum("n").over(Window.partitionBy("i")), "_c": F.sum("n").over(Window.partitionBy("j")), "_t": F.sum("n").over(whole)})
    value = F.sum(F.col("n") / F.col("_t") * F.log(F.col("n") * F.col("_t") / (F.col("_r") * F.col("_c"))))
    return cells.agg(F.when(F.max("_t") >= least, F.greatest(value, F.lit(0.0))).otherwise(F.lit(0.0)).alias("mutual_information"))


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n), plot-ready; values outside are left out, the upper end belongs to the last bin."""
    place = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(value).between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def topic_summary(messages: DataFrame, topic: str, schema: str, t: str, seq: str) -> DataFrame:
    """For each topic: messages, last schema, first and last time, seconds, and rate (10 without duration)."""
    seconds = (F.max(t) - F.min(t)) / 1_000_000
    return messages.groupBy(F.col(topic).alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(schema, F.struct(t, seq)).alias("schema"), F.min(t).alias("t_start"), F.max(t).alias("t_end"), seconds.alias("seconds"),
        F.when(seconds > 0, F.count(F.lit(1)) / seconds).otherwise(10.0).alias("rate"),
    )


def timings(steps: DataFrame, step: str = "step", seconds: str = "seconds", code: str = "code") -> DataFrame:
    """(step, seconds, status) of the steps of a run, and their total: "ok" for code 0, else "rc=" and the code; the total has no status."""
    each = steps.select(F.col(step).alias("step"), F.col(seconds).cast("double").alias("seconds"), F.when(F.col(code) == 0, "ok").otherwise(F.concat(F.lit("rc="), F.col(code).cast("string"))).alias("status"))
    return each.unionByName(each.agg(F.lit("total").alias("step"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"), F.lit(None).cast("string").alias("status")))
