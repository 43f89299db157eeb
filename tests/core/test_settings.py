"""Nested documents against plain dicts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from roadglass.operators import settings

SCHEMA = "vehicle string, document string, rank int, text string"


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("body", F.try_parse_json("text"))


def flat(tree, path=()):
    out = {}
    for k, v in tree.items():
        if isinstance(v, dict):
            out |= flat(v, (*path, k))
        else:
            out[(*path, k)] = v
    return out


def deep(a, b):
    out = dict(a)
    for k, v in b.items():
        out[k] = deep(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) and (v or not a[k]) else v
    return out


def values(frame):
    return {(r["vehicle"], tuple(r["path"])): json.loads(r["v"]) for r in frame.withColumn("v", F.to_json("value")).collect()}


TREES = [
    ("defaults.json", 0, {"a": 1, "b": {"x": 1, "y": {"z": [1, 2], "w": None}}, "name.with.dots": "s", "list": []}),
    ("user.json", 1, {"a": 2, "b": {"y": {"z": [3]}, "new": True}, "é": "ü"}),
    ("late.json", 2, {"b": {"x": {"deeper": 5}}, "list": {"now": "an object"}}),
]


@pytest.fixture
def frame(spark):
    rows = [(v, d, r, json.dumps(t)) for v in ("car", "bus") for d, r, t in TREES if v == "car" or r < 2]
    return docs(spark, [*rows, ("bad", "x.json", 0, "no json"), ("bad", "y.json", 0, "[1, 2]"), ("bad", "z.json", 0, None), ("bad", "e.json", 0, "{}")])


def test_leaves_are_all_values(spark, frame):
    got = settings.leaves(frame, ["vehicle"]).where("document = 'defaults.json' AND vehicle = 'car'")
    assert values(got) == {("car", p): v for p, v in flat(TREES[0][2]).items()}
    assert settings.leaves(frame.where("vehicle = 'bad'"), ["vehicle"]).count() == 0
    shallow = values(settings.leaves(frame.where("document = 'user.json'"), ["vehicle"], 1))
    assert shallow["car", ("b",)] == {"y": {"z": [3]}, "new": True}


def test_documents_over_each_other(spark, frame):
    got = values(settings.overlaid(settings.leaves(frame, ["vehicle"]), ["vehicle"]))
    want = {}
    for v, n in (("car", 3), ("bus", 2)):
        tree = {}
        for _, _, t in TREES[:n]:
            tree = deep(tree, t)
        want |= {(v, p): x for p, x in flat(tree).items()}
    assert got == want


def test_the_top_level_as_a_whole_like_an_update(spark, frame):
    got = values(settings.overlaid(settings.leaves(frame, ["vehicle"]), ["vehicle"], 1))
    want = {}
    for v, n in (("car", 3), ("bus", 2)):
        tree = {}
        for _, _, t in TREES[:n]:
            tree.update(t)
        want |= {(v, p): x for p, x in flat(tree).items()}
    assert got == want


def test_random_documents(spark):
    rng = random.Random(4)

    def tree(depth):
        return {k: tree(depth - 1) if depth and rng.random() < 0.5 else rng.randint(0, 9) for k in rng.sample("abcd", rng.randint(1, 3))}

    rows, want = [], {}
    for v in range(30):
        whole = {}
        for r in range(4):
            t = tree(3)
            rows.append((str(v), f"{r}.json", r, json.dumps(t)))
            whole = deep(whole, t)
        want |= {(str(v), p): x for p, x in flat(whole).items()}
    assert values(settings.overlaid(settings.leaves(docs(spark, rows), ["vehicle"]), ["vehicle"])) == want


def test_lookups_with_types_and_defaults(spark, frame):
    found = settings.overlaid(settings.leaves(frame, ["vehicle"]), ["vehicle"])
    keys = spark.createDataFrame([("car",), ("bus",), ("none",)], "vehicle string")
    got = {r["vehicle"]: r for r in settings.looked_up(keys, found, ["vehicle"], {"a": (["a"], "int", 7), "z": (["b", "y", "z"], "array<int>", None), "dots": (["name.with.dots"], "string", "none"), "wrong": (["name.with.dots"], "int", -1)}).collect()}
    assert [tuple(got[v][c] for c in ("a", "z", "dots", "wrong")) for v in ("car", "bus", "none")] == [(2, [3], "s", -1), (2, [3], "s", -1), (7, None, "none", -1)]


def test_transforms_of_which_the_last_parent_wins(spark):
    one, two = {"base": {"front": {"x": 1, "yaw": 0.5}, "rear": {"x": 2}}, "note": "text"}, {"other": {"front": {"y": 3}}}
    rows = docs(spark, [("car", "a.json", 0, json.dumps(one)), ("car", "b.json", 1, json.dumps(two))])
    got = {r["child"]: r for r in settings.children(settings.leaves(rows, ["vehicle"]), ["vehicle"]).collect()}
    assert (got["front"]["parent"], got["front"]["x"], got["front"]["y"]) == ("other", 0.0, 3.0) and (got["rear"]["parent"], got["rear"]["x"], got["rear"]["yaw"]) == ("base", 2.0, 0.0)


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"k": {"v": 1}}))
    (tmp_path / "b.yaml").write_text("k:\n  v: 2\n")
    pytest.importorskip("yaml")
    got = settings.overlaid(settings.leaves(settings.read(spark, str(tmp_path / "*"))))
    assert [(r["path"], r["v"]) for r in got.withColumn("v", F.to_json("value")).collect()] == [(["k", "v"], "2")]
