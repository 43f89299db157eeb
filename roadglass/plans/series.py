"""Time-series queries over the events table."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import series as S
from .base import SIG, query, sig, table

US = 1_000_000
BY = ["series"]
PI2 = 2 * pi
R = geo.EARTH_RADIUS_M


@query("asof_forward_fill", f"""WITH {SIG} SELECT p.event_id, p.series, p.t, coalesce(c.value, -1.0) AS last_click
FROM (SELECT * FROM sig WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM sig WHERE event_type = 'click') c ON p.series = c.series AND p.t >= c.t""")
def asof_forward_fill(spark, sf_dir):
    s = sig(spark, sf_dir)
    left = s.where("event_type = 'purchase'").select("event_id", "series", "t")
    right = s.where("event_type = 'click'").select("series", "t", F.col("value").alias("last_click"))
    return S.asof(left, right, BY, ["last_click"]).select("event_id", "series", "t", F.coalesce("last_click", F.lit(-1.0)).alias("last_click"))


@query("asof_forward", f"""WITH {SIG} SELECT p.event_id, p.series, p.t, c.t AS ref_t, c.value AS next_click
FROM (SELECT * FROM sig WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM sig WHERE event_type = 'click') c ON p.series = c.series AND p.t <= c.t""")
def asof_forward(spark, sf_dir):
    s = sig(spark, sf_dir)
    right = s.where("event_type = 'click'").select("series", "t", F.col("value").alias("next_click"))
    return S.asof(s.where("event_type = 'purchase'").select("event_id", "series", "t"), right, BY, ["next_click"], direction="forward")


NEAREST = f"""WITH {SIG}, p AS (SELECT * FROM sig WHERE event_type = 'purchase'), c AS (SELECT * FROM sig WHERE event_type = 'click'),
b AS (SELECT p.event_id, p.series, p.t, c.t AS t0, c.value AS v0 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.t >= c.t),
n AS (SELECT p.event_id, c.t AS t1, c.value AS v1 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.t <= c.t),
r AS (SELECT event_id, series, t, CASE WHEN t0 IS NULL THEN t1 WHEN t1 IS NULL OR t - t0 <= t1 - t THEN t0 ELSE t1 END AS ref_t,
 CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL OR t - t0 <= t1 - t THEN v0 ELSE v1 END AS near_click FROM b JOIN n USING (event_id))"""


@query("asof_nearest", NEAREST + " SELECT event_id, series, t, ref_t, near_click FROM r")
def asof_nearest(spark, sf_dir):
    s = sig(spark, sf_dir)
    right = s.where("event_type = 'click'").select("series", "t", F.col("value").alias("near_click"))
    return S.asof(s.where("event_type = 'purchase'").select("event_id", "series", "t"), right, BY, ["near_click"], direction="nearest")


@query("asof_nearest_tolerance", NEAREST + " SELECT event_id, series, t, ref_t, near_click FROM r WHERE abs(ref_t - t) <= 7200000000")
def asof_nearest_tolerance(spark, sf_dir):
    s = sig(spark, sf_dir)
    right = s.where("event_type = 'click'").select("series", "t", F.col("value").alias("near_click"))
    return S.asof(s.where("event_type = 'purchase'").select("event_id", "series", "t"), right, BY, ["near_click"], direction="nearest", tolerance=7200 * US).where("ref_t IS NOT NULL")


@query("knn_in_time", f"""WITH {SIG}, j AS (SELECT p.series, p.event_id AS left_id, c.event_id AS right_id, p.t AS t_left, c.t AS t_right,
 row_number() OVER (PARTITION BY p.event_id ORDER BY abs(c.t - p.t), c.t, c.event_id) AS k
 FROM sig p JOIN sig c ON p.series = c.series WHERE p.event_type = 'purchase' AND c.event_type = 'view')
SELECT series, left_id, right_id, t_left, t_right, CAST(k AS INTEGER) AS k FROM j WHERE k <= 3 AND abs(t_right - t_left) <= 36000000000""")
def knn_in_time(spark, sf_dir):
    s = sig(spark, sf_dir)
    left = s.where("event_type = 'purchase'").select("series", "t", F.col("event_id").alias("left_id"))
    right = s.where("event_type = 'view'").select("series", "t", F.col("event_id").alias("right_id"))
    return S.nearest_k(left, right, BY, 3, 36000 * US)


@query("time_ticks", f"""WITH {SIG}, g AS (SELECT series, min(t) AS a, max(t) AS b FROM sig GROUP BY series),
q AS (SELECT series, i AS tick, a + i * 86400000000 AS t, b FROM (SELECT *, unnest(range(1, CAST(floor((b - a) / 86400000000) AS BIGINT) + 1)) AS i FROM g))
SELECT q.series, CAST(q.tick AS INTEGER) AS tick, q.t, s.t AS ref_t, s.value FROM q ASOF LEFT JOIN sig s ON q.series = s.series AND q.t <= s.t""")
def time_ticks(spark, sf_dir):
    return S.ticks(sig(spark, sf_dir), BY, 86400 * US, ["value"])


@query("linear_interpolate", f"""WITH {SIG}, p AS (SELECT * FROM sig WHERE event_type = 'purchase'), c AS (SELECT * FROM sig WHERE event_type = 'click'),
b AS (SELECT p.event_id, p.series, p.t, c.t AS t0, c.sv AS v0 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.t >= c.t),
n AS (SELECT p.event_id, c.t AS t1, c.sv AS v1 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.t <= c.t)
SELECT event_id, series, t, round(CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL OR t1 = t0 THEN v0 ELSE v0 + (v1 - v0) * (t - t0) / (t1 - t0) END, 6) AS sv FROM b JOIN n USING (event_id)""")
def linear_interpolate(spark, sf_dir):
    s = sig(spark, sf_dir)
    out = S.interpolate(s.where("event_type = 'purchase'").select("event_id", "series", "t"), s.where("event_type = 'click'").select("series", "t", "sv"), BY, ["sv"])
    return out.withColumn("sv", F.round("sv", 6))


@query("slerp_poses", f"""WITH {SIG}, q AS (SELECT event_id, k, sin(value / 200) AS s0, cos(value / 200) AS c0, sin(sv / 100) AS s1, cos(sv / 100) AS c1, (k % 10) / 10.0 AS f FROM sig),
d AS (SELECT *, s0 * s1 + c0 * c1 AS dot FROM q), e AS (SELECT *, CASE WHEN dot < 0 THEN -1.0 ELSE 1.0 END AS sg, least(1.0, abs(dot)) AS ad FROM d),
w AS (SELECT *, CASE WHEN ad > 0.9995 THEN 1 - f ELSE sin((1 - f) * acos(ad)) / sin(acos(ad)) END AS a, sg * CASE WHEN ad > 0.9995 THEN f ELSE sin(f * acos(ad)) / sin(acos(ad)) END AS b FROM e),
z AS (SELECT event_id, a * s0 + b * s1 AS qz, a * c0 + b * c1 AS qw FROM w)
SELECT event_id, round(qz / sqrt(qz * qz + qw * qw), 6) + 0.0 AS qz, round(qw / sqrt(qz * qz + qw * qw), 6) + 0.0 AS qw FROM z""")
def slerp_poses(spark, sf_dir):
    zero = F.lit(0.0)
    p = [zero, zero, 3 * F.sin(F.col("value") / 200), 3 * F.cos(F.col("value") / 200)]  # of any length
    q = [zero, zero, F.sin(F.col("sv") / 100) / 2, F.cos(F.col("sv") / 100) / 2]
    out = geo.with_slerp(sig(spark, sf_dir), p, q, (F.col("k") % 10) / 10.0, ["x", "y", "z", "w"])
    return out.select("event_id", (F.round("z", 6) + 0.0).alias("qz"), (F.round("w", 6) + 0.0).alias("qw"))


@query("series_gradient", f"""WITH {SIG}, g AS (SELECT event_id, series, t, sv, value, count(*) OVER (PARTITION BY series) AS n, lag(sv) OVER w AS sp, lead(sv) OVER w AS sn, lag(value) OVER w AS vp, lead(value) OVER w AS vn, lag(t) OVER w AS tp, lead(t) OVER w AS tn FROM sig WINDOW w AS (PARTITION BY series ORDER BY t, event_id)),
d AS (SELECT *, coalesce((sn - sp) / 2, sn - sv, sv - sp, 0) AS de, coalesce((vn - vp) / 2, vn - value, value - vp, 0) AS dn, coalesce((tn - tp) / 2, tn - t, t - tp, 0) / 1e6 AS dt FROM g),
s AS (SELECT *, CASE WHEN dt = 0 THEN 'nan'::DOUBLE ELSE sqrt(de * de + dn * dn) / dt END AS v FROM d),
a AS (SELECT *, CASE WHEN lag(v) OVER w IS NULL AND lead(v) OVER w IS NULL THEN 0 WHEN lag(v) OVER w IS NULL THEN lead(v) OVER w - v WHEN lead(v) OVER w IS NULL THEN v - lag(v) OVER w ELSE (lead(v) OVER w - lag(v) OVER w) / 2 END AS dv FROM s WINDOW w AS (PARTITION BY series ORDER BY t, event_id))
SELECT event_id, round(de, 6) AS slope, round(CASE WHEN isnan(v) THEN -1 ELSE v END, 6) AS speed, round(CASE WHEN n < 3 OR dt = 0 OR isnan(dv) THEN 0 ELSE dv / dt END, 6) AS acceleration FROM a""")
def series_gradient(spark, sf_dir):
    s = sig(spark, sf_dir)
    slope = S.gradient(F.col("sv"), BY, "t", "event_id")
    out = S.acceleration(s.withColumn("slope", F.round(slope, 6)), BY, "sv", "value", US, "t", "event_id")
    return out.select("event_id", "slope", F.round(F.when(F.isnan("speed"), -1.0).otherwise(F.col("speed")), 6).alias("speed"), F.round("acceleration", 6).alias("acceleration"))


STEP = """st AS (SELECT *, CASE WHEN lead(t) OVER w IS NULL THEN NULL WHEN lead(t) OVER w > t THEN abs(lead(sv) OVER w - sv) / ((lead(t) OVER w - t) / 1e6) ELSE 'infinity'::DOUBLE END AS o
 FROM sig WINDOW w AS (PARTITION BY series ORDER BY t, event_id))"""


@query("speed_jumps", f"""WITH {SIG}, {STEP}, i AS (SELECT *, lag(o) OVER (PARTITION BY series ORDER BY t, event_id) AS p FROM st)
SELECT event_id, CASE WHEN o IS NULL AND p IS NULL THEN false WHEN p IS NULL THEN o > 0.01 WHEN o IS NULL THEN p > 0.01 ELSE o > 0.01 AND p > 0.01 END AS jump FROM i""")
def speed_jumps(spark, sf_dir):
    s = sig(spark, sf_dir).withColumn("zero", F.lit(0.0))
    return S.speed_jumps(s, BY, "sv", "zero", 0.01, US, "t", "event_id").select("event_id", "jump")


@query("zero_jump_filter", f"""WITH {SIG}, q AS (SELECT event_id, series, t, k, CASE WHEN k % 7 = 0 THEN 0.0 ELSE sv END AS lat, CASE WHEN k % 7 = 0 THEN 0.0 ELSE value END AS lon, row_number() OVER (PARTITION BY series ORDER BY t, event_id) AS rn FROM sig)
SELECT event_id FROM q WHERE NOT (lat = 0 AND lon = 0 AND rn > 1) AND k % 11 <> 0""")
def zero_jump_filter(spark, sf_dir):
    s = sig(spark, sf_dir)
    gone = F.col("k") % 7 == 0
    s = s.withColumns({"lat": F.when(gone, 0.0).otherwise(F.col("sv")), "lon": F.when(gone, 0.0).otherwise(F.col("value"))})
    return S.zero_jumps(s, BY, "lat", "lon", "t", "event_id").where("finite AND NOT zero AND k % 11 <> 0").select("event_id")


PULSES = """m AS (SELECT *, coalesce(sum(CASE WHEN abs(sv) < 120 THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS isl,
 row_number() OVER (PARTITION BY series ORDER BY t, event_id) AS rn FROM sig),
st2 AS (SELECT *, min(CASE WHEN abs(sv) >= 200 THEN rn END) OVER (PARTITION BY series, isl) AS s0 FROM m),
pl AS (SELECT series, isl, arg_min(t, rn) AS t_start, arg_max(t, rn) AS t_end, first(t ORDER BY abs(sv) DESC, rn) AS t_peak, first(sv ORDER BY abs(sv) DESC, rn) AS peak, arg_max(abs(sv) < 120, rn) AS closed,
 arg_min(k, rn) AS k0, arg_max(k, rn) AS k1 FROM st2 WHERE rn >= s0 GROUP BY series, isl),
pulses AS (SELECT series, t_start, t_peak, t_end, peak FROM pl WHERE closed)"""


def _pulses(spark, sf_dir):
    return S.pulses(sig(spark, sf_dir), BY, "sv", 200.0, 120.0, US, "t", "event_id")


@query("hysteresis_pulses", f"WITH {SIG}, {PULSES} SELECT *, CASE WHEN peak > 0 THEN 'harsh_accel' ELSE 'harsh_decel' END AS kind FROM pulses")
def hysteresis_pulses(spark, sf_dir):
    return _pulses(spark, sf_dir).withColumn("kind", F.when(F.col("peak") > 0, "harsh_accel").otherwise("harsh_decel"))


@query("pulse_merge", f"""WITH RECURSIVE {SIG}, {PULSES}, n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t_start, t_peak, t_end, peak) AS rn FROM pulses),
f AS (SELECT series, rn, 1 AS grp, t_start, t_peak, t_end, peak FROM n WHERE rn = 1 UNION ALL
 SELECT n.series, n.rn, CASE WHEN j.near THEN f.grp ELSE f.grp + 1 END, CASE WHEN j.near THEN f.t_start ELSE n.t_start END,
  CASE WHEN j.near AND abs(n.peak) <= abs(f.peak) THEN f.t_peak ELSE n.t_peak END, n.t_end, CASE WHEN j.near AND abs(n.peak) <= abs(f.peak) THEN f.peak ELSE n.peak END
 FROM f JOIN n ON n.series = f.series AND n.rn = f.rn + 1, LATERAL (SELECT n.t_start - f.t_end <= 259200000000 AND (f.peak > 0) <> (n.peak > 0) AS near) j)
SELECT series, t_start, t_peak, t_end, peak FROM f QUALIFY row_number() OVER (PARTITION BY series, grp ORDER BY rn DESC) = 1""")
def pulse_merge(spark, sf_dir):
    return S.merge_opposite(_pulses(spark, sf_dir), BY, 3 * 86400 * US)


@query("return_drift_filter", f"""WITH {SIG}, {PULSES}, lst AS (SELECT series, max(t) AS last FROM sig GROUP BY series),
b AS (SELECT p.*, s.value / 60 AS h0 FROM pulses p JOIN sig s ON s.series = p.series AND s.t = p.t_start),
q AS (SELECT b.*, b.t_end + 10800000000 AS q FROM b),
l AS (SELECT q.*, coalesce(s.t, lst.last) AS rt, coalesce(s.value, z.value) / 60 AS h1 FROM q ASOF LEFT JOIN sig s ON q.series = s.series AND q.q <= s.t JOIN lst ON lst.series = q.series JOIN sig z ON z.series = lst.series AND z.t = lst.last)
SELECT series, t_start, t_peak, t_end, peak FROM l WHERE rt <= t_end OR abs((h1 - h0 + pi()) - 2 * pi() * floor((h1 - h0 + pi()) / (2 * pi())) - pi()) <= 1.5""")
def return_drift_filter(spark, sf_dir):
    s = sig(spark, sf_dir).withColumn("heading", F.col("value") / 60)
    return S.drop_drifting(_pulses(spark, sf_dir), s, BY, "heading", 10800 * US, 1.5)


@query("stops", f"""WITH {SIG}, {STEP}, a AS (SELECT *, row_number() OVER w AS rn, lead(t) OVER w AS nx FROM st WINDOW w AS (PARTITION BY series ORDER BY t, event_id)),
i AS (SELECT *, rn - row_number() OVER (PARTITION BY series ORDER BY rn) AS isl FROM a WHERE coalesce(o < 0.005, false)),
g AS (SELECT series, min(t) AS t_start, max(nx) AS t_end, CAST(floor((min(rn) + max(rn) + 1) / 2) AS BIGINT) AS mid FROM i GROUP BY series, isl)
SELECT g.series, g.t_start, a.t AS t_mid, g.t_end, (g.t_end - g.t_start) / 1e6 AS seconds FROM g JOIN a ON a.series = g.series AND a.rn = g.mid WHERE (g.t_end - g.t_start) / 1e6 >= 3600""")
def stops(spark, sf_dir):
    s = sig(spark, sf_dir).withColumn("zero", F.lit(0.0))
    return S.stops(s, BY, "sv", "zero", 0.005, 3600.0, US, "t", "event_id")


@query("low_speed_episodes", f"""WITH {SIG}, a AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t, event_id) AS rn FROM sig),
i AS (SELECT *, rn - row_number() OVER (PARTITION BY series ORDER BY rn) AS isl FROM a WHERE value <= 60)
SELECT series, min(t) AS t_start, max(t) AS t_end, first(t ORDER BY value, rn) AS t_slowest, first(value ORDER BY value, rn) AS slowest FROM i GROUP BY series, isl HAVING (max(t) - min(t)) / 1e6 >= 1800""")
def low_speed_episodes(spark, sf_dir):
    return S.slow_episodes(sig(spark, sf_dir), BY, "value", 60.0, 1800.0, US, "t", "event_id")


@query("step_speed_gate", f"""WITH {SIG}, {STEP}, p AS (SELECT series, o, lag(t) OVER (PARTITION BY series ORDER BY t, event_id) AS tp, t FROM st)
SELECT series, count(*) AS n, round(avg(CASE WHEN o > 0.02 THEN 1.0 ELSE 0.0 END), 6) AS reject_ratio, round(quantile_cont(o, 0.5), 6) AS median_speed, round(quantile_cont(o, 0.95), 6) AS p95_speed,
 max(t - tp) / 1e6 AS max_gap, CASE WHEN max(t - tp) / 1e6 > 86400 THEN 'FAIL' ELSE 'PASS' END AS overall FROM p GROUP BY series""")
def step_speed_gate(spark, sf_dir):
    from ..operators import reports

    s = sig(spark, sf_dir).withColumn("zero", F.lit(0.0))
    return reports.speed_gate(s, BY, "sv", "zero", US, fastest=0.02, widest_gap=86400.0, t="t", seq="event_id")


@query("yaw_coverage", f"""WITH {SIG}, a AS (SELECT series, value / 50 - lag(value / 50) OVER (PARTITION BY series ORDER BY t, event_id) AS d FROM sig)
SELECT series, round(coalesce(sum(abs((d + pi()) - 2 * pi() * floor((d + pi()) / (2 * pi())) - pi())), 0), 6) AS turned FROM a GROUP BY series""")
def yaw_coverage(spark, sf_dir):
    turned = S.total_turn(F.col("value") / 50, BY, "t", "event_id")
    return sig(spark, sf_dir).withColumn("d", turned).groupBy("series").agg(F.round(F.coalesce(F.sum("d"), F.lit(0.0)), 6).alias("turned"))


@query("stride_sample", f"""WITH {SIG}, a AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) - 1 AS pos FROM sig)
SELECT event_type, event_id, t FROM a WHERE pos % 5 = 0 AND pos < 200""")
def stride_sample(spark, sf_dir):
    return S.stride(sig(spark, sf_dir), ["event_type"], 5, 40, "t", "event_id").select("event_type", "event_id", "t")


def _even(cut: str) -> str:
    return f"""WITH {SIG}, a AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t, event_id) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM sig),
g AS (SELECT DISTINCT series, CAST({cut}(i * (n - 1) / 6.0) AS BIGINT) AS pos FROM (SELECT DISTINCT series, n FROM a), (SELECT unnest(range(7)) AS i))
SELECT series, event_id, t FROM a JOIN g USING (series, pos)"""


@query("even_sample_trunc", _even("floor"))
def even_sample_trunc(spark, sf_dir):
    return S.evenly(sig(spark, sf_dir), BY, 7, "t", "event_id").select("series", "event_id", "t")


@query("even_sample_round", _even("round_even").replace("/ 6.0)", "/ 6.0, 0)"))
def even_sample_round(spark, sf_dir):
    return S.evenly(sig(spark, sf_dir), BY, 7, "t", "event_id", "half_even").select("series", "event_id", "t")


@query("per_topic_limit", f"WITH {SIG} SELECT event_type, event_id, t FROM sig QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) <= 25")
def per_topic_limit(spark, sf_dir):
    return S.first_rows(sig(spark, sf_dir), ["event_type"], 25, "t", "event_id").select("event_type", "event_id", "t")


@query("scan_filtered", f"""WITH {SIG} SELECT event_type, event_id, t FROM sig WHERE event_type IN ('click', 'view') AND t BETWEEN 1704412800000000 AND 1705276800000000
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) <= 100""")
def scan_filtered(spark, sf_dir):
    s = sig(spark, sf_dir).where("event_type IN ('click', 'view') AND t BETWEEN 1704412800000000 AND 1705276800000000")
    return S.first_rows(s, ["event_type"], 100, "t", "event_id").select("event_type", "event_id", "t")


@query("corridor", f"""WITH {SIG}, g AS (SELECT event_id, value AS e, sv AS n, k / 50.0 AS sd, coalesce((lead(value) OVER w - lag(value) OVER w) / 2, lead(value) OVER w - value, value - lag(value) OVER w, 0) AS de,
 coalesce((lead(sv) OVER w - lag(sv) OVER w) / 2, lead(sv) OVER w - sv, sv - lag(sv) OVER w, 0) AS dn FROM sig WINDOW w AS (PARTITION BY series ORDER BY t, event_id)),
u AS (SELECT *, greatest(sqrt(de * de + dn * dn), 1e-6) AS len FROM g)
SELECT event_id, round(e - dn / len * 2 * sd, 5) AS left_e, round(n + de / len * 2 * sd, 5) AS left_n, round(e + dn / len * 2 * sd, 5) AS right_e, round(n - de / len * 2 * sd, 5) AS right_n FROM u""")
def corridor(spark, sf_dir):
    s = sig(spark, sf_dir).withColumn("spread", F.col("k") / 50.0)
    out = S.corridor(s, BY, "value", "sv", "spread", 2.0, "t", "event_id")
    return out.select("event_id", *[F.round(c, 5).alias(c) for c in ("left_e", "left_n", "right_e", "right_n")])


@query("union_events", f"""WITH {SIG}, {PULSES}, lo AS (SELECT series, t_start, t_slowest AS t_peak, t_end, slowest AS magnitude, 'stop' AS kind FROM (WITH a AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t, event_id) AS rn FROM sig),
i AS (SELECT *, rn - row_number() OVER (PARTITION BY series ORDER BY rn) AS isl FROM a WHERE value <= 60)
SELECT series, min(t) AS t_start, max(t) AS t_end, first(t ORDER BY value, rn) AS t_slowest, first(value ORDER BY value, rn) AS slowest FROM i GROUP BY series, isl HAVING (max(t) - min(t)) / 1e6 >= 1800))
SELECT series, t_start, t_peak, t_end, peak AS magnitude, 'pulse' AS kind FROM pulses UNION ALL SELECT * FROM lo""")
def union_events(spark, sf_dir):
    p = _pulses(spark, sf_dir).select("series", "t_start", "t_peak", "t_end", F.col("peak").alias("magnitude"), F.lit("pulse").alias("kind"))
    low = S.slow_episodes(sig(spark, sf_dir), BY, "value", 60.0, 1800.0, US, "t", "event_id")
    low = low.select("series", "t_start", F.col("t_slowest").alias("t_peak"), "t_end", F.col("slowest").alias("magnitude"), F.lit("stop").alias("kind"))
    return S.union_events(p, low)


@query("sweep_peak", f"""WITH {SIG}, g AS (SELECT k AS step, round(avg(value), 9) AS score FROM sig GROUP BY k), n AS (SELECT *, lag(score) OVER (ORDER BY step) AS p, lead(score) OVER (ORDER BY step) AS q FROM g)
SELECT (SELECT step FROM g ORDER BY score DESC, step LIMIT 1) AS best_step, count(*) AS n_peaks, round(max(score) / min(score), 6) AS ratio FROM n WHERE score > p AND score > q""")
def sweep_peak(spark, sf_dir):
    from ..operators import reports

    grid = sig(spark, sf_dir).groupBy(F.col("k").alias("step")).agg(F.round(F.avg("value"), 9).alias("score"))
    return reports.sweep_peaks(grid, "step", "score")


@query("circular_mean", f"WITH {SIG} SELECT series, round(atan2(avg(sin(value / 50)), avg(cos(value / 50))), 6) AS mean_angle FROM sig GROUP BY series")
def circular_mean(spark, sf_dir):
    from ..operators import reports

    return sig(spark, sf_dir).groupBy("series").agg(F.round(reports.circular_mean(F.col("value") / 50), 6).alias("mean_angle"))


@query("enu_projection", f"""WITH {SIG}, o AS (SELECT series, first(35 + value / 1000 ORDER BY t, event_id) AS lat0, first(139 + sv / 1000 ORDER BY t, event_id) AS lon0 FROM sig GROUP BY series),
p AS (SELECT event_id, 35 + value / 1000 AS lat, 139 + sv / 1000 AS lon, lat0, lon0 FROM sig JOIN o USING (series))
SELECT event_id, round(radians(lon - lon0) * {R} * cos(radians(lat0)), 4) AS east, round(radians(lat - lat0) * {R}, 4) AS north, round(lat, 9) AS back_lat, round(lon, 9) AS back_lon FROM p""")
def enu_projection(spark, sf_dir):
    w = S.order(BY, "t", "event_id")
    s = sig(spark, sf_dir).withColumns({"lat": 35 + F.col("value") / 1000, "lon": 139 + F.col("sv") / 1000})
    s = s.withColumns({"lat0": F.first("lat").over(w), "lon0": F.first("lon").over(w)})
    east, north = geo.enu(F.col("lat"), F.col("lon"), F.col("lat0"), F.col("lon0"))
    lat, lon = geo.from_enu(east, north, F.col("lat0"), F.col("lon0"))
    return s.select("event_id", F.round(east, 4).alias("east"), F.round(north, 4).alias("north"), F.round(lat, 9).alias("back_lat"), F.round(lon, 9).alias("back_lon"))


@query("mercator", f"WITH {SIG} SELECT event_id, round(radians(139 + sv / 1000) * {R}, 4) AS x, round(ln(tan(pi() / 4 + radians(35 + value / 1000) / 2)) * {R}, 4) AS y FROM sig")
def mercator(spark, sf_dir):
    x, y = geo.mercator(35 + F.col("value") / 1000, 139 + F.col("sv") / 1000)
    return sig(spark, sf_dir).select("event_id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("rpy_quat_roundtrip", f"""WITH {SIG}, a AS (SELECT event_id, sv / 500 AS r, value / 500 AS p, (sv - value) / 400 AS y FROM sig)
SELECT event_id, round(r, 6) + 0.0 AS roll, round(p, 6) + 0.0 AS pitch, round(y, 6) + 0.0 AS yaw, round(sin(r / 2) * cos(p / 2) * cos(y / 2) - cos(r / 2) * sin(p / 2) * sin(y / 2), 6) + 0.0 AS qx FROM a""")
def rpy_quat_roundtrip(spark, sf_dir):
    """Euler angles to a quaternion, a rotation, a quaternion again and back to the angles nearest to them."""
    given, names = ["roll0", "pitch0", "yaw0"], ("roll", "pitch", "yaw")
    s = sig(spark, sf_dir).select("event_id", *[c.alias(n) for c, n in zip((F.col("sv") / 500, F.col("value") / 500, (F.col("sv") - F.col("value")) / 400), given)])
    s = s.select("event_id", *given, *[c.alias(f"q{i}") for i, c in enumerate(geo.rpy_to_quaternion(*map(F.col, given)))])
    s = s.select("event_id", *given, "q0", *[c.alias(f"r{i}") for i, c in enumerate(geo.rotation_of_quaternion([1.5 * F.col(f"q{i}") for i in range(4)]))])
    s = s.select("event_id", *given, "q0", *[c.alias(f"p{i}") for i, c in enumerate(geo.quaternion_of_rotation([F.col(f"r{i}") for i in range(9)]))])
    s = geo.same_rpy(s, geo.quaternion_to_rpy([F.col(f"p{i}") for i in range(4)]), [F.col(n) for n in given], names)
    return s.select("event_id", *[(F.round(n, 6) + 0.0).alias(n) for n in names], (F.round("q0", 6) + 0.0).alias("qx"))


@query("packet_decode", f"WITH {SIG} SELECT event_id, k & 127 AS mode FROM sig WHERE k & 64 = 0 AND (k & 127) < 31")
def packet_decode(spark, sf_dir):
    from ..sources import messages

    packet = F.concat(F.repeat(F.lit("00"), 68), F.lpad(F.hex(F.col("k").bitwiseAND(F.lit(127)).bitwiseOR(F.when(F.col("k").bitwiseAND(F.lit(64)) > 0, 128).otherwise(0))), 2, "0"), F.lit("000000"))
    s = sig(spark, sf_dir).select("event_id", F.unhex(packet).alias("data"))
    return messages.position_modes(s).select("event_id", "mode")


@query("rolling_shutter", f"WITH {SIG} SELECT event_id, CASE WHEN k % 3 = 0 THEN t ELSE t + CAST(round_even((k - 40 / 2) * 0.0000125 * 1e9, 0) AS BIGINT) END AS t_row FROM sig")
def rolling_shutter(spark, sf_dir):
    line = F.when(F.col("k") % 3 != 0, F.lit(0.0000125))
    return sig(spark, sf_dir).select("event_id", geo.rolling_shutter_time(F.col("t"), F.col("k"), F.lit(40), line).alias("t_row"))
