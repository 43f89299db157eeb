"""Hysteresis pulses over a stream, with state for each series, and windowed rates with a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "series long, t_start long, t_peak long, t_end long, peak double"
STATE = "t_start long, t_peak long, peak double, open boolean"


def stream_pulses(rows: DataFrame, enter: float, leave: float, series: str = "series", t: str = "t", value: str = "v") -> DataFrame:
    """Closed pulses in append mode. A series' rows must come in order of time from batch to batch; inside one they are sorted.

    The state is the open pulse alone, so it stays as small as the number of series.
    """
    if not 0 < leave <= enter:
        raise ValueError("0 < leave <= enter is needed")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, peak_t, peak, open_ = state.get if state.exists else (0, 0, 0.0, False)
        out = []
        batch = pd.concat(list(parts)).sort_values("t", kind="stable")
        for at, v in zip(batch["t"].tolist(), batch["v"].tolist()):
            if not open_:
                if abs(v) >= enter:
                    start, peak_t, peak, open_ = at, at, v, True
                continue
            if abs(v) > abs(peak):
                peak_t, peak = at, v
            if abs(v) < leave:
                out.append((key[0], start, peak_t, at, peak))
                open_ = False
        state.update((start, peak_t, peak, open_))
        yield pd.DataFrame(out, columns=["series", "t_start", "t_peak", "t_end", "peak"])

    named = rows.select(F.col(series).cast("long").alias("series"), F.col(t).cast("long").alias("t"), F.col(value).cast("double").alias("v"))
    return named.groupBy("series").applyInPandasWithState(step, SCHEMA, STATE, "append", GroupStateTimeout.NoTimeout)


def stream_rates(rows: DataFrame, time: str, topic: str, width: str = "10 seconds", late: str = "30 seconds") -> DataFrame:
    """(window, topic, n) by event time; rows later than the watermark are left out."""
    return rows.withWatermark(time, late).groupBy(F.window(time, width), F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("n"))
