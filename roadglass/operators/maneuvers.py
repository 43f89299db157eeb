"""Vehicle maneuvers: lane changes, harsh acceleration and braking, stops, each as events with one schema.

Events: the ``by`` columns, t_start, t_peak, t_end, magnitude, kind. Times are
nanoseconds unless ``unit`` says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import radians

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from . import series as S

#: Thresholds of the detectors.
ENTER_YAW_RATE, LEAVE_YAW_RATE = radians(2.0), radians(0.5)
LEAST_PULSE_S, MOST_PULSE_S = 0.5, 6.0
MOST_NET_HEADING = radians(20)
MERGE_GAP_S = 2.0
RETURN_CHECK_S, MOST_RETURN_DRIFT = 3.0, radians(3.0)
GRAVITY = 9.80665
ENTER_HARSH, LEAVE_HARSH = 0.35 * GRAVITY, 0.15 * GRAVITY
LEAST_HARSH_S, MOST_HARSH_S = 0.3, 5.0
STOP_SPEED, LEAST_STOP_S = 0.5, 2.0
FASTEST_FIX = 50.0

EVENT = ("t_start", "t_peak", "t_end", "magnitude", "kind")


def lane_changes(rows: DataFrame, by: Sequence[str], yaw_rate: str = "yaw_rate", heading: str = "heading", t: str = "t", seq: str | None = None, unit: int = 10**9) -> DataFrame:
    """Yaw-rate pulses that end near the heading they began with, halves of one S joined, curves taken out."""
    found = S.pulses(rows, by, yaw_rate, ENTER_YAW_RATE, LEAVE_YAW_RATE, unit, t, seq, LEAST_PULSE_S, MOST_PULSE_S, carry=[heading], least_rows=3)
    turned = F.abs(geo.wrap_angle(F.col(f"{heading}_end") - F.col(f"{heading}_start")))
    short = found.where(turned <= MOST_NET_HEADING).select(*by, "t_start", "t_peak", "t_end", "peak")
    merged = S.merge_opposite(short, by, int(MERGE_GAP_S * unit))
    kept = S.drop_drifting(merged, rows, by, heading, int(RETURN_CHECK_S * unit), MOST_RETURN_DRIFT, t)
    return kept.select(*by, "t_start", "t_peak", "t_end", F.col("peak").alias("magnitude"), F.lit("lane_change").alias("kind"))


def harsh_events(rows: DataFrame, by: Sequence[str], accel: str = "accel_x", t: str = "t", seq: str | None = None, unit: int = 10**9) -> DataFrame:
    found = S.pulses(rows, by, accel, ENTER_HARSH, LEAVE_HARSH, unit, t, seq, LEAST_HARSH_S, MOST_HARSH_S)
    return found.select(*by, "t_start", "t_peak", "t_end", F.col("peak").alias("magnitude"), F.when(F.col("peak") > 0, "harsh_accel").otherwise("harsh_decel").alias("kind"))


def local(fixes: DataFrame, by: Sequence[str], t: str = "t", seq: str | None = None) -> DataFrame:
    """Adds east and north in metres of the first fix of the series."""
    w = S.order(by, t, seq)
    out = fixes.withColumns({"_lat0": F.first("lat").over(w), "_lon0": F.first("lon").over(w)})
    east, north = geo.enu(F.col("lat"), F.col("lon"), F.col("_lat0"), F.col("_lon0"))
    return out.withColumns({"east": east, "north": north}).drop("_lat0", "_lon0")


def stop_events(fixes: DataFrame, by: Sequence[str], t: str = "t", seq: str | None = None, unit: int = 10**9) -> DataFrame:
    found = S.stops(local(fixes, by, t, seq), by, "east", "north", STOP_SPEED, LEAST_STOP_S, unit, t, seq)
    return found.select(*by, "t_start", F.col("t_mid").alias("t_peak"), "t_end", F.col("seconds").alias("magnitude"), F.lit("stop").alias("kind"))


def flagged(fixes: DataFrame, by: Sequence[str], t: str = "t", seq: str | None = None, unit: int = 10**9, fastest: float = FASTEST_FIX) -> DataFrame:
    """Adds jump, zero and finite to fixes; callers filter on status only afterwards."""
    return S.speed_jumps(S.zero_jumps(local(fixes, by, t, seq), by, "lat", "lon", t, seq), by, "east", "north", fastest, unit, t, seq)


def placed(events: DataFrame, fixes: DataFrame, by: Sequence[str], t: str = "t") -> DataFrame:
    """(t_ns, lat, lon, maneuver_type, magnitude) at the fix nearest to each event's peak; a series without fixes has none."""
    at = S.asof(events.withColumn(t, F.col("t_peak")), fixes.select(*by, t, "lat", "lon"), by, ["lat", "lon"], t, "nearest")
    return at.where("ref_t IS NOT NULL").select(*by, F.col("t_peak").alias("t_ns"), "lat", "lon", F.col("kind").alias("maneuver_type"), F.abs("magnitude").alias("magnitude"))
