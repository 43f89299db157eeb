"""The bag source through a stand-in reader, logs of the driver, and the bounded optimiser."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadglass.operators import solve
from roadglass.sources import mcap, messages, sinks

KINDS = {"/imu": "sensor_msgs/msg/Imu", "/fix": "sensor_msgs/msg/NavSatFix", "/imu2": "sensor_msgs/msg/Imu"}


@pytest.fixture
def bags(tmp_path):
    for n in range(3):
        rows = [{"topic": t, "schema": KINDS[t], "t": 1000 * n + 10 * i + k, "data": f"{n}.{i}"} for i in range(20) for k, t in enumerate(KINDS) if not (n == 0 and t == "/imu2")]
        (tmp_path / f"part_{n}.mcap").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (tmp_path / "notes.txt").write_text("no bag")
    return tmp_path


def asked(folder):
    return [json.loads(line) for f in sorted(folder.glob("*.asked")) for line in f.read_text().splitlines()]


def test_messages_in_log_order(spark, bags):
    got = messages.scan(mcap.read(spark, str(bags), "fake_bags")).orderBy(*messages.ORDER).collect()
    assert len(got) == 160 and [(r["file_seq"], r["log_time_ns"]) for r in got] == sorted((r["file_seq"], r["log_time_ns"]) for r in got)
    assert bytes(got[0]["data"]) == b"0.0" and {r["schema_name"] for r in got} == set(KINDS.values())


def test_topics_and_times_reach_the_reader(spark, bags):
    rows = messages.scan(mcap.read(spark, str(bags), "fake_bags"), ["/imu", "/fix"], 1.05e-6, 1.1e-6).collect()
    assert {r["topic"] for r in rows} == {"/imu", "/fix"} and all(1050 <= r["log_time_ns"] <= 1100 for r in rows) and rows
    told = [x for x in asked(bags) if "topics" in x]
    assert told and all(x == {"topics": ["/fix", "/imu"], "start": 1050, "end": 1101} for x in told)


def test_topics_by_summaries_alone(spark, bags):
    assert [r["topic"] for r in mcap.topics_by_schema(spark, str(bags), "sensor_msgs/msg/Imu", "fake_bags").collect()] == ["/imu", "/imu2"]
    one = mcap.summaries(spark, str(bags / "part_0.mcap"), "fake_bags").orderBy("topic").collect()
    assert [(r["topic"], r["messages"], r["start_ns"], r["end_ns"]) for r in one] == [("/fix", 20, 0, 191), ("/imu", 20, 0, 191)]
    assert asked(bags) and all(x == {"summary": True} for x in asked(bags))


def test_files_without_summary_or_statistics(spark, bags):
    (bags / "part_0.mcap").rename(bags / "nosummary_0.mcap")
    (bags / "part_1.mcap").rename(bags / "nostatistics_1.mcap")
    got = mcap.summaries(spark, str(bags), "fake_bags").collect()
    assert {(r["path"].split("/")[-1], r["messages"]) for r in got} == {("nostatistics_1.mcap", None), ("part_2.mcap", 20)}
    assert [r["topic"] for r in mcap.topics_by_schema(spark, str(bags), "sensor_msgs/msg/Imu", "fake_bags").collect()] == ["/imu", "/imu2"]


def test_what_is_printed_is_logged(tmp_path, capsys):
    with sinks.logged(str(tmp_path / "new"), "run.log") as path:
        print("one step")
    print("after")
    with open(path) as f:
        assert f.read() == "one step\n"
    assert capsys.readouterr().out == "one step\nafter\n"


@pytest.mark.parametrize("low, high, want", [([-5, -5], [5, 5], [1, 1]), ([-5, -5], [0.5, 5], [0.5, 0.25]), ([2, -5], [5, 5], [2, 4])])
def test_minimise_a_valley_inside_a_box(low, high, want):
    valley = lambda s: (1 - s[:, 0]) ** 2 + 20 * (s[:, 1] - s[:, 0] ** 2) ** 2
    x, value = solve.minimise(valley, [-1.0, 1.0] if low[0] < 0 else [3.0, 1.0], low, high, rounds=200)
    assert np.allclose(x, want, atol=2e-2) and value <= valley(np.array([want], float))[0] + 1e-3


def test_minimise_over_rows(spark):
    rows = spark.range(200).select((F.col("id") / 10).alias("a"), (3 * F.col("id") / 10 - 7).alias("b"))
    cost = lambda p: (p[0] * F.col("a") + p[1] - F.col("b")) * (p[0] * F.col("a") + p[1] - F.col("b")) / 200
    x, _ = solve.minimise(solve.costs_of(rows, cost, 2), [0.0, 0.0], [-10, -10], [10, 10])
    assert np.allclose(x, [3, -7], atol=0.05)
