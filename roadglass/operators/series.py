"""Time-series operators.

A series is the rows with equal ``by`` columns, in order of ``t`` (a BIGINT)
and, where times can be equal, ``seq``. As-of joins are one union and one
window, never a range join: each side is shuffled once by the series key. Times
stay integers; only differences become seconds. ``unit`` is ticks a second.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

INF = float("inf")


def order(by: Sequence[str], t: str = "t", seq: str | None = None):
    return Window.partitionBy(*by).orderBy(t, *([seq] if seq else []))


def _merged(left: DataFrame, right: DataFrame, by: Sequence[str], t: str, values: Sequence[str], before: bool) -> DataFrame:
    """Both sides as one; right rows sort before left rows of equal time where ``before``, else after."""
    ref = F.struct(F.col(t).alias("t"), *[F.col(v).alias(v) for v in values])
    lefts = left.select(*by, t, F.struct(*left.columns).alias("_left"), F.lit(None).cast(right.select(ref.alias("r")).schema["r"].dataType).alias("_ref"), F.lit(1).alias("_side"))
    rights = right.select(*by, t, F.lit(None).cast(lefts.schema["_left"].dataType).alias("_left"), ref.alias("_ref"), F.lit(0 if before else 2).alias("_side"))
    return lefts.unionByName(rights)


def _around(by: Sequence[str], t: str) -> tuple[Column, Column]:
    """The latest right row up to each row of both sides, and the earliest from it on.

    The second runs over the order turned round: frames that only grow are kept
    up row by row, those that look ahead to the end are computed anew for each row.
    """
    grow = lambda *o: Window.partitionBy(*by).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)
    return F.last("_ref", ignorenulls=True).over(grow(F.asc(t), F.asc("_side"))), F.last("_ref", ignorenulls=True).over(grow(F.desc(t), F.desc("_side")))


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], values: Sequence[str], t: str = "t", direction: str = "backward", clamp: bool = False, tolerance: int | None = None) -> DataFrame:
    """Every left row with ``ref_t`` and the values of one right row of its series, or nulls.

    backward: the latest at or before; forward: the earliest at or after;
    nearest: the nearer of both, the earlier on a tie. ``clamp`` takes the row on
    the other side where there is none. ``tolerance``: farther rows are nulls.
    Right rows of equal time: backward takes the last, forward the first.
    """
    merged_back = _merged(left, right, by, t, values, True)
    back, ahead = _around(by, t)
    if direction == "backward":
        found = merged_back.withColumn("_p", back)
        found = found.withColumn("_n", ahead) if clamp else found.withColumn("_n", F.lit(None).cast(found.schema["_ref"].dataType))
        pick = F.coalesce("_p", "_n")
    elif direction == "forward":
        found = _merged(left, right, by, t, values, False).withColumn("_n", ahead)
        found = found.withColumn("_p", back) if clamp else found.withColumn("_p", F.lit(None).cast(found.schema["_ref"].dataType))
        pick = F.coalesce("_n", "_p")
    elif direction == "nearest":
        # a right row at the very time sorts before and is the backward one
        found = merged_back.withColumns({"_p": back, "_n": ahead})
        nearer = (F.col(t) - F.col("_p.t")) <= (F.col("_n.t") - F.col(t))
        pick = F.when(F.col("_p").isNull(), F.col("_n")).when(F.col("_n").isNull() | nearer, F.col("_p")).otherwise(F.col("_n"))
        if not clamp:
            pick = F.when(F.col("_p").isNotNull() | F.col("_n").isNotNull(), pick)
    else:
        raise ValueError(direction)
    found = found.where(F.col("_left").isNotNull()).withColumn("_r", pick)
    ref = F.col("_r")
    if tolerance is not None:
        ref = F.when(F.abs(F.col("_r.t") - F.col(t)) <= tolerance, F.col("_r"))
    return found.withColumn("_r", ref).select("_left.*", F.col("_r.t").alias("ref_t"), *[F.col(f"_r.{v}").alias(v) for v in values])


def bracket(left: DataFrame, right: DataFrame, by: Sequence[str], values: Sequence[str], t: str = "t") -> DataFrame:
    """Left rows with the right rows around them as structs ``a`` and ``b``, and the fraction between.

    Times outside the span are clamped to it; a span of no width has fraction 0.
    """
    back, ahead = _around(by, t)
    rows = _merged(left, right, by, t, values, True).withColumns({"_p": back, "_n": ahead})
    rows = rows.where(F.col("_left").isNotNull()).withColumns({"a": F.coalesce("_p", "_n"), "b": F.coalesce("_n", "_p")})
    width = F.col("b.t") - F.col("a.t")
    inside = F.greatest(F.lit(0), F.least(width, F.col(t) - F.col("a.t")))
    return rows.select("_left.*", "a", "b", F.when(width > 0, inside / width).otherwise(F.lit(0.0)).alias("fraction"))


def interpolate(left: DataFrame, right: DataFrame, by: Sequence[str], values: Sequence[str], t: str = "t", quaternion: Sequence[str] = ()) -> DataFrame:
    """Linear interpolation of the values, and slerp of an xyzw quaternion."""
    rows = bracket(left, right, by, [*values, *quaternion], t)
    out = [(F.col(f"a.{v}") + (F.col(f"b.{v}") - F.col(f"a.{v}")) * F.col("fraction")).alias(v) for v in values]
    if quaternion:
        turned = [f"_turned{i}" for i in range(4)]
        rows = geo.with_slerp(rows, [F.col(f"a.{q}") for q in quaternion], [F.col(f"b.{q}") for q in quaternion], F.col("fraction"), turned)
        out += [F.col(c).alias(q) for c, q in zip(turned, quaternion)]
    return rows.select(*left.columns, *out)


def nearest_k(left: DataFrame, right: DataFrame, by: Sequence[str], k: int, reach: int, t: str = "t", left_id: str = "left_id", right_id: str = "right_id") -> DataFrame:
    """The k right rows nearest in time to each left row, then those of them within ``reach``.

    Rows beyond ``reach`` can only be cut off afterwards, so buckets of that
    width suffice: a left row meets the right rows of its own and both
    neighbouring buckets in an equi-join. Ties go to the earlier row, then the id.
    """
    lefts = left.select(*by, F.col(left_id), F.col(t).alias("t_left"), F.explode(F.array(*[F.floor(F.col(t) / reach).cast("long") + i for i in (-1, 0, 1)])).alias("_bucket"))
    rights = right.select(*by, F.col(right_id), F.col(t).alias("t_right"), F.floor(F.col(t) / reach).cast("long").alias("_bucket"))
    gap = F.abs(F.col("t_right") - F.col("t_left"))
    rows = lefts.join(rights, [*by, "_bucket"]).where(gap <= reach)
    near = Window.partitionBy(*by, left_id).orderBy(gap, "t_right", right_id)
    return rows.withColumn("k", F.row_number().over(near)).where(F.col("k") <= k).select(*by, left_id, right_id, "t_left", "t_right", "k")


def ticks(rows: DataFrame, by: Sequence[str], interval: int, values: Sequence[str], t: str = "t") -> DataFrame:
    """(by, tick, ref_t, values): the first row at or after each multiple of the interval from the start, or the last row."""
    span = rows.groupBy(*by).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))
    count = F.floor((F.col("_b") - F.col("_a")) / interval).cast("int")
    targets = span.where(count >= 1).select(*by, "_a", F.explode(F.sequence(F.lit(1), count)).alias("tick")).select(*by, "tick", (F.col("_a") + F.col("tick") * interval).alias(t))
    return asof(targets, rows, by, values, t, "forward", clamp=True)


def gradient(value: Column, by: Sequence[str], t: str = "t", seq: str | None = None) -> Column:
    """Central difference by row, one-sided at the ends; 0 for a single row."""
    w = order(by, t, seq)
    ahead, back = F.lead(value).over(w), F.lag(value).over(w)
    return F.coalesce((ahead - back) / 2, ahead - value, value - back, F.lit(0.0))


def yaw_rate(rows: DataFrame, by: Sequence[str], east: str, north: str, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds ``heading`` and ``yaw_rate`` from positions; rows of a series of fewer than three get zeros."""
    w = order(by, t, seq)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    out = rows.withColumns({"_n": n, "heading": F.atan2(gradient(F.col(east), by, t, seq), gradient(F.col(north), by, t, seq)), "_dt": gradient(F.col(t).cast("double"), by, t, seq) / unit})
    rate = F.coalesce(F.try_divide(geo.wrap_angle(F.col("heading") - F.lag("heading").over(w)), F.col("_dt")), F.lit(0.0))
    short = F.col("_n") < 3
    return out.withColumns({"yaw_rate": F.when(short, 0.0).otherwise(rate), "heading": F.when(short, 0.0).otherwise(F.col("heading"))}).drop("_n", "_dt")


def acceleration(rows: DataFrame, by: Sequence[str], east: str, north: str, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds ``speed``, the length of the gradients of both positions over that of time, and ``acceleration``, its gradient over time.

    Where time stands still the speed is not a number, and neither are the
    accelerations it enters; all such are 0, as all are in a series of fewer than three rows.
    """
    dt = gradient(F.col(t).cast("double"), by, t, seq) / unit
    way = F.hypot(gradient(F.col(east), by, t, seq), gradient(F.col(north), by, t, seq))
    out = rows.withColumns({"_n": F.count(F.lit(1)).over(Window.partitionBy(*by)), "_dt": dt, "_way": way})
    out = out.withColumn("speed", F.coalesce(F.try_divide("_way", "_dt"), F.lit(float("nan"))))
    rate = F.coalesce(F.try_divide(gradient(F.col("speed"), by, t, seq), F.col("_dt")), F.lit(0.0))
    return out.withColumn("acceleration", F.when((F.col("_n") < 3) | F.isnan(rate) | (F.abs(rate) == INF), 0.0).otherwise(rate)).drop("_n", "_dt", "_way")


def step_speed(x: str, y: str, by: Sequence[str], unit: int, t: str = "t", seq: str | None = None) -> Column:
    """Speed from each row to the next; infinite where time doesn't advance, null at the last."""
    w = order(by, t, seq)
    dt = (F.lead(t).over(w) - F.col(t)) / unit
    way = F.hypot(F.lead(x).over(w) - F.col(x), F.lead(y).over(w) - F.col(y))
    return F.when(dt > 0, F.try_divide(way, dt)).when(dt.isNotNull(), F.lit(INF))


def speed_profile(rows: DataFrame, by: Sequence[str], x: str, y: str, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """(by, t_mid, speed) for each step, steps taking a millionth of a second at least."""
    w = order(by, t, seq)
    dt = F.greatest((F.lead(t).over(w) - F.col(t)) / unit, F.lit(1e-6))
    way = F.hypot(F.lead(x).over(w) - F.col(x), F.lead(y).over(w) - F.col(y))
    mid = F.floor((F.col(t) + F.lead(t).over(w)) / 2).cast("long")
    return rows.select(*by, mid.alias("t_mid"), (way / dt).alias("speed")).where(F.col("t_mid").isNotNull())


def speed_jumps(rows: DataFrame, by: Sequence[str], x: str, y: str, limit: float, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds ``jump``: reached and left faster than the limit; the ends look at their one step."""
    w = order(by, t, seq)
    out = rows.withColumn("_out", step_speed(x, y, by, unit, t, seq)).withColumn("_in", F.lag("_out").over(w))
    if limit <= 0:
        return out.withColumn("jump", F.lit(False)).drop("_in", "_out")
    left, came = F.col("_out") > limit, F.col("_in") > limit
    jump = F.when(F.col("_out").isNull() & F.col("_in").isNull(), False).when(F.col("_in").isNull(), left).when(F.col("_out").isNull(), came).otherwise(left & came)
    return out.withColumn("jump", jump).drop("_in", "_out")


def zero_jumps(rows: DataFrame, by: Sequence[str], lat: str, lon: str, t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds ``zero`` (a fix at 0, 0 other than a finite first) and ``finite``."""
    finite = ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lat) < INF) & (F.abs(lon) < INF)
    first = F.row_number().over(order(by, t, seq)) == 1
    return rows.withColumns({"finite": finite, "zero": (F.col(lat) == 0) & (F.col(lon) == 0) & ~(first & finite)})


def pulses(rows: DataFrame, by: Sequence[str], value: str, enter: float, leave: float, unit: int, t: str = "t", seq: str | None = None, least_s: float = 0.0, most_s: float = INF, carry: Sequence[str] = (), least_rows: int = 2) -> DataFrame:
    """Hysteresis: a pulse opens where abs(value) >= enter and closes at the next row below ``leave``.

    Returns t_start, t_peak, t_end, peak (the first largest by size) and, for
    each carried column, its values at the start and the end. A pulse still open
    at the end of a series is none. Needs 0 < leave <= enter.
    """
    if not 0 < leave <= enter:
        raise ValueError("0 < leave <= enter is needed")
    w = order(by, t, seq)
    size = F.abs(F.col(value))
    low = size < leave
    marked = rows.withColumns(
        {
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*by)),
            "_island": F.coalesce(F.sum(low.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_at": F.row_number().over(w),
        }
    ).where(F.col("_n") >= least_rows)
    island = Window.partitionBy(*by, "_island").orderBy("_at")
    start = F.min(F.when(size >= enter, F.col("_at"))).over(island.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inside = marked.withColumn("_start", start).where(F.col("_at") >= F.col("_start"))
    keep = F.struct(F.col(t).alias("t"), *[F.col(c) for c in carry])
    out = inside.groupBy(*by, "_island").agg(
        F.min_by(keep, "_at").alias("_s"),
        F.max_by(keep, "_at").alias("_e"),
        F.max_by(F.struct(F.col(t).alias("t"), F.col(value).alias("v")), F.struct(size, -F.col("_at"))).alias("_p"),
        F.max_by(low, "_at").alias("_closed"),
    )
    seconds = (F.col("_e.t") - F.col("_s.t")) / unit
    return out.where(F.col("_closed") & (seconds >= least_s) & (seconds <= most_s)).select(
        *by, F.col("_s.t").alias("t_start"), F.col("_p.t").alias("t_peak"), F.col("_e.t").alias("t_end"), F.col("_p.v").alias("peak"),
        *[F.col(f"{side}.{c}").alias(f"{c}_{name}") for c in carry for side, name in (("_s", "start"), ("_e", "end"))],
    )


def merge_opposite(events: DataFrame, by: Sequence[str], gap: int) -> DataFrame:
    """Fold events in order of start: one of the other sign within ``gap`` of the last end joins it, the larger peak stays.

    The state is the merged event, so this is a fold and not a window: one pass
    over the events of a series, which are far fewer than its samples.
    """
    fields = ("t_start", "t_peak", "t_end", "peak")
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by([(f, "ascending") for f in fields])
        done: list[list] = []
        for event in zip(*(table[f].to_pylist() for f in fields)):
            if done and event[0] - done[-1][2] <= gap and (done[-1][3] > 0) != (event[3] > 0):
                last = done[-1]
                last[2] = event[2]
                if abs(event[3]) > abs(last[3]):
                    last[1], last[3] = event[1], event[3]
            else:
                done.append(list(event))
        key = table.select(list(by)).slice(0, 1)
        columns = [pa.concat_arrays([pa.repeat(key[c][0], len(done))]) for c in by] + [pa.array([e[i] for e in done], table.schema.field(f).type) for i, f in enumerate(fields)]
        return pa.Table.from_arrays(columns, names=[*by, *fields])

    return events.groupBy(*by).applyInArrow(fold, ", ".join(f"`{c}` {kinds[c]}" for c in (*by, *fields)))


def drop_drifting(events: DataFrame, rows: DataFrame, by: Sequence[str], heading: str, wait: int, limit: float, t: str = "t") -> DataFrame:
    """Events whose heading is back within ``limit`` of its start ``wait`` after their end, or that end too near the last row to tell."""
    last = rows.groupBy(*by).agg(F.max(t).alias("_last"))
    base = asof(events.withColumn("_q", F.col("t_start")), rows.withColumn("_q", F.col(t)), by, [heading], "_q", "backward").withColumnRenamed(heading, "_h0").drop("ref_t")
    later = asof(base.withColumn("_q", F.col("t_end") + wait), rows.withColumn("_q", F.col(t)), by, [heading], "_q", "forward", clamp=True)
    far = F.abs(geo.wrap_angle(F.col(heading) - F.col("_h0")))
    return later.where((F.col("ref_t") <= F.col("t_end")) | (far <= limit)).select(*events.columns)


def islands(rows: DataFrame, by: Sequence[str], flag: str, t: str = "t", seq: str | None = None) -> DataFrame:
    """Rows where the flag holds, with ``island``, a number shared by neighbours, and ``at``, the row's number in its series."""
    w = order(by, t, seq)
    out = rows.withColumn("at", F.row_number().over(w))
    out = out.where(F.col(flag))
    return out.withColumn("island", F.col("at") - F.row_number().over(w))


def stops(rows: DataFrame, by: Sequence[str], x: str, y: str, below: float, least_s: float, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """Stretches of steps slower than ``below``: t_start, t_mid, t_end, seconds; the middle is the row halfway."""
    w = order(by, t, seq)
    steps = rows.withColumn("_speed", step_speed(x, y, by, unit, t, seq)).withColumn("_next", F.lead(t).over(w)).withColumn("_slow", F.coalesce(F.col("_speed") < below, F.lit(False)))
    slow = islands(steps, by, "_slow", t, seq)
    # the rows of an island have neighbouring numbers, so its size tells which of them is the middle one
    island = Window.partitionBy(*by, "island")
    placed = slow.withColumns({"_size": F.count(F.lit(1)).over(island), "_at": F.row_number().over(island.orderBy("at"))})
    middle = F.max(F.when(F.col("_at") == F.floor(F.col("_size") / 2) + 1, F.col(t)))
    spans = placed.groupBy(*by, "island").agg(F.min(t).alias("t_start"), F.max("_next").alias("t_end"), middle.alias("t_mid"))
    seconds = (F.col("t_end") - F.col("t_start")) / unit
    return spans.where(seconds >= least_s).select(*by, "t_start", "t_mid", "t_end", seconds.alias("seconds"))


def slow_episodes(rows: DataFrame, by: Sequence[str], speed: str, limit: float, least_s: float, unit: int, t: str = "t", seq: str | None = None) -> DataFrame:
    """Stretches of rows with speed <= limit that last long enough, each with its slowest row (the first of equals)."""
    found = islands(rows.withColumn("_slow", F.coalesce(F.col(speed) <= limit, F.lit(False))), by, "_slow", t, seq)
    spans = found.groupBy(*by, "island").agg(F.min(t).alias("t_start"), F.max(t).alias("t_end"), F.min_by(F.struct(F.col(t).alias("t"), F.col(speed).alias("v")), F.struct(F.col(speed), F.col("at"))).alias("_m"))
    return spans.where((F.col("t_end") - F.col("t_start")) / unit >= least_s).select(*by, "t_start", "t_end", F.col("_m.t").alias("t_slowest"), F.col("_m.v").alias("slowest"))


def corridor(rows: DataFrame, by: Sequence[str], east: str, north: str, spread: str, sigma: float, t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds the points ``sigma`` spreads to the left and right of the way, across its direction."""
    de, dn = gradient(F.col(east), by, t, seq), gradient(F.col(north), by, t, seq)
    out = rows.withColumns({"_de": de, "_dn": dn}).withColumn("_len", F.greatest(F.hypot("_de", "_dn"), F.lit(1e-6)))
    ne, nn = -F.col("_dn") / F.col("_len"), F.col("_de") / F.col("_len")
    reach = sigma * F.col(spread)
    return out.withColumns({"left_e": F.col(east) + ne * reach, "left_n": F.col(north) + nn * reach, "right_e": F.col(east) - ne * reach, "right_n": F.col(north) - nn * reach}).drop("_de", "_dn", "_len")


def total_turn(angle: Column, by: Sequence[str], t: str = "t", seq: str | None = None) -> Column:
    """Size of the turn from the row before; summed, how much of the circle a series covers."""
    return F.abs(geo.wrap_angle(angle - F.lag(angle).over(order(by, t, seq))))


def stride(rows: DataFrame, by: Sequence[str], every: int, cap: int | None = None, t: str = "t", seq: str | None = None) -> DataFrame:
    """Every n-th row of a series from its first, then the first ``cap`` of them."""
    at = F.row_number().over(order(by, t, seq)) - 1
    out = rows.withColumn("_at", at).where(F.col("_at") % every == 0)
    return (out.where(F.col("_at") < cap * every) if cap is not None else out).drop("_at")


def first_rows(rows: DataFrame, by: Sequence[str], n: int, t: str = "t", seq: str | None = None) -> DataFrame:
    return rows.withColumn("_at", F.row_number().over(order(by, t, seq))).where(F.col("_at") <= n).drop("_at")


def evenly(rows: DataFrame, by: Sequence[str], k: int, t: str = "t", seq: str | None = None, rounding: str = "floor") -> DataFrame:
    """k rows at even distances from the first to the last; ``floor`` cuts positions, ``half_even`` rounds them; repeats count once."""
    w = order(by, t, seq)
    out = rows.withColumns({"_at": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*by))})
    cut = F.floor if rounding == "floor" else F.bround
    place = lambda i: cut(i * (F.col("_n") - 1) / max(1, k - 1) if k > 1 else i * 0.0).cast("long")
    return out.where(F.array_contains(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), place), F.col("_at").cast("long"))).drop("_at", "_n")


#: Bits of a hash by which a sample's rows are counted.
SAMPLE_BITS = 16


def sample(rows: DataFrame, keys: Sequence[str], n: int, seed: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """Of each group the n rows with the smallest hashes of their keys (of equal hashes the smaller keys): the same at every run and partitioning.

    A histogram of the hashes' first bits tells which of them are chosen whole and
    which one is chosen in part; only that one is put in order, so neither all rows
    are sorted nor n of them meet in a task.
    """
    h = F.xxhash64(*keys, F.lit(seed))
    each = rows.withColumns({"_h": h, "_bin": F.call_function("shiftright", h, F.lit(64 - SAMPLE_BITS))})
    same = [F.col(f"_by{i}") for i in range(len(by))]
    group = each.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_bin")
    counts = group.groupBy(*same, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*same).orderBy("_bin"))
    # the bin in which the n-th row lies, and how many come before it
    counts = counts.withColumn("_upto", upto).where(F.col("_upto") - F.col("_n") < n)
    cut = counts.groupBy(*same).agg(F.max_by(F.struct("_bin", F.col("_n"), (F.col("_upto") - F.col("_n")).alias("_before")), "_bin").alias("_cut"))
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)), F.lit(True))
    # one row a group
    found = each.join(cut if by else F.broadcast(cut), on).where(F.col("_bin") <= F.col("_cut._bin"))
    last = Window.partitionBy(*by, "_bin").orderBy("_h", *keys)
    edge = found.where(F.col("_bin") == F.col("_cut._bin")).withColumn("_at", F.row_number().over(last)).where(F.col("_at") + F.col("_cut._before") <= n)
    return found.where(F.col("_bin") < F.col("_cut._bin")).select(*rows.columns).unionByName(edge.select(*rows.columns))


def union_events(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
