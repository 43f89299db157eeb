"""Sinks: event CSV, review reports."""

from __future__ import annotations

import io
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager, redirect_stdout
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reports

EVENT_COLUMNS = ("t_ns", "lat", "lon", "maneuver_type", "magnitude")


def write_events(events: DataFrame, path: str) -> None:
    """One CSV file with a header, also without events. Events are few: they are computed in parallel and meet in one task to be written."""
    events.select(*EVENT_COLUMNS).repartition(1).sortWithinPartitions(*EVENT_COLUMNS).write.mode("overwrite").csv(path, header=True)


def write_report(rows: DataFrame, path: str, ok: str = "frame_ok", issues: str = "issues") -> DataFrame:
    """JSON lines, Parquet if there are rows, and the summary, which is returned."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/results")
    if rows.limit(1).count():
        rows.write.mode("overwrite").parquet(f"{path}/table")
    summary = reports.review_summary(rows, ok, issues)
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    return summary


#: Fixed value: what stands for an answer that is no JSON after the second call.
FALLBACK_ISSUE = {"category": "other", "severity": "high", "description": "LLM output unparsable as JSON after retry", "region": None, "landmark": None, "instance_name": None}
AGAIN = "\n\nYour previous reply was not valid JSON. Reply with ONLY the JSON object."


def review(frames: DataFrame, ask: Callable[[str], str], key: list[str], folder: str, prompt: str = "prompt", again: str = AGAIN) -> DataFrame:
    """Adds the client's last ``answer``, ``parsed`` (JSON), ``parse_ok`` and ``calls`` to each frame.

    Answers are written below ``folder``, which all machines share, by the frame's
    key before anything reads them: the first ones as ``first``, those of the
    second call, for frames whose first answer is no JSON object, as ``second``.
    All later steps read these tables, so they see one answer, and a frame is asked
    once or twice. With the same folder again, frames that have an answer are not
    asked again: a run that broke off goes on. What is no JSON after the second
    call becomes a fallback: frame_ok null and one issue of high severity, with the
    answer as ``raw_response``. Only a task that is lost before its answers are
    written asks for its frames anew. Frames that repeat a key are an error.
    """
    from ..functions import text

    spark = frames.sparkSession
    kinds = ", ".join(f"`{c}` {frames.schema[c].dataType.simpleString()}" for c in key)
    if frames.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError(f"frames repeat a key of {key}")

    def call(rows: DataFrame, suffix: str) -> DataFrame:
        def run(batches):
            for pdf in batches:
                yield pdf[key].assign(answer=[ask(p + suffix) for p in pdf["_prompt"]])

        return rows.select(*key, F.coalesce(prompt, F.lit("")).alias("_prompt")).mapInPandas(run, f"{kinds}, answer string")

    def stored(name: str) -> DataFrame:
        at = f"{folder.rstrip('/')}/{name}"
        spark.createDataFrame([], f"{kinds}, answer string").write.mode("append").parquet(at)
        return spark.read.schema(f"{kinds}, answer string").parquet(at)

    def answers(rows: DataFrame, suffix: str, name: str) -> DataFrame:
        """The rows' answers, those that were there and new ones."""
        call(rows.join(stored(name).select(*key), key, "left_anti"), suffix).write.mode("append").parquet(f"{folder.rstrip('/')}/{name}")
        return stored(name).join(rows.select(*key), key, "left_semi").withColumn("parsed", text.parse_answer(F.col("answer")))

    first = answers(frames, "", "first").withColumn("calls", F.lit(1))
    bad = frames.join(first.where("parsed IS NULL").select(*key), key, "left_semi")
    second = answers(bad, again, "second").withColumn("calls", F.lit(2))
    known = first.where("parsed IS NOT NULL").unionByName(second)
    issue = F.struct(*[F.lit(v).cast("string").alias(k) for k, v in FALLBACK_ISSUE.items()])
    fallback = F.to_json(F.struct(F.lit(None).cast("boolean").alias("frame_ok"), F.array(issue).alias("issues"), F.lit("").alias("overall_notes"), F.col("answer").alias("raw_response")), {"ignoreNullFields": "false"})
    told = known.select(*key, "answer", F.coalesce(F.to_json("parsed"), fallback).alias("parsed"), F.col("parsed").isNotNull().alias("parse_ok"), "calls")
    return frames.join(told, key)


@contextmanager
def logged(folder: str, name: str) -> Iterator[str]:
    """What the driver prints meanwhile also goes to a file, whose path it yields."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    shown = sys.stdout

    class Both(io.TextIOBase):
        def write(self, said: str) -> int:
            shown.write(said)
            return log.write(said)

        def flush(self) -> None:
            shown.flush()
            log.flush()

    path = Path(folder) / name
    with path.open("w") as log, redirect_stdout(Both()):
        yield str(path)
