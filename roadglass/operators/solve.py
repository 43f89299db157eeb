"""Robust rigid alignment: a driver loop over distributed sums.

Each evaluation is one aggregate: matches inside the gate are found by the grid
join, and 21 + 6 + 3 sums (normal matrix, gradient, cost, squares, count) reach
the driver. Levenberg-Marquardt works on these six unknowns.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from . import spatial

#: Damping at the start, its factors and bounds, tries a step, and the largest step.
DAMPING, EASE, HARDEN, LEAST_DAMPING, MOST_DAMPING, TRIES = 1e-3, 0.5, 3.0, 1e-7, 1e4, 8
MOST_TURN, MOST_SHIFT = 0.2, 0.5


def skew(v: np.ndarray) -> np.ndarray:
    x, y, z = v
    return np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])


def se3_exp(step: np.ndarray) -> np.ndarray:
    """4x4 of a turn vector and a shift."""
    turn, shift = step[:3], step[3:]
    angle, k, out = float(np.linalg.norm(turn)), skew(turn), np.eye(4)
    if angle < 1e-12:
        out[:3, :3], out[:3, 3] = np.eye(3) + k, shift
        return out
    a, b, c = np.sin(angle) / angle, (1 - np.cos(angle)) / angle**2, (angle - np.sin(angle)) / angle**3
    out[:3, :3] = np.eye(3) + a * k + b * k @ k
    out[:3, 3] = (np.eye(3) + b * k + c * k @ k) @ shift
    return out


@dataclass
class Sums:
    h: np.ndarray
    g: np.ndarray
    cost: float
    squares: float
    n: int


def residuals(points: DataFrame, target: DataFrame, pose: np.ndarray, gate: float, point_id: str, target_id: str) -> DataFrame:
    """(left_id, r, px, py, pz, nx, ny, nz) of the matches: signed distance to the target's plane, and the moved point."""
    r, t = [F.lit(float(v)) for v in pose[:3, :3].ravel()], [F.lit(float(v)) for v in pose[:3, 3]]
    moved = points.select(F.col(point_id), *[c.alias(n) for c, n in zip(geo.apply_transform(r, t, [F.col(c) for c in spatial.XYZ]), spatial.XYZ)])
    near = spatial.nearest(moved, target, gate, point_id, target_id)
    planes = target.select(F.col(target_id).alias("right_id"), *[F.col(c).alias(f"t{c}") for c in spatial.XYZ], "nx", "ny", "nz")
    rows = near.join(moved.withColumnRenamed(point_id, "left_id"), "left_id").join(planes, "right_id")
    off = sum(((F.col(c) - F.col(f"t{c}")) * F.col(f"n{c}") for c in spatial.XYZ), F.lit(0.0))
    return rows.select("left_id", off.alias("r"), *[F.col(c).alias(f"p{c}") for c in spatial.XYZ], "nx", "ny", "nz")


def normal_sums(rows: DataFrame, huber: float) -> DataFrame:
    """One row: h00..h55 (upper half), g0..g5, cost, squares, n. The unknowns are a turn about the origin, then a shift."""
    p, n, r = [F.col(f"p{c}") for c in spatial.XYZ], [F.col(f"n{c}") for c in spatial.XYZ], F.col("r")
    j = [p[1] * n[2] - p[2] * n[1], p[2] * n[0] - p[0] * n[2], p[0] * n[1] - p[1] * n[0], *n]
    w = geo.huber_weight(r, huber)
    size = F.abs(r)
    cost = F.when(size <= huber, 0.5 * r * r).otherwise(huber * (size - 0.5 * huber))
    return rows.agg(
        *[F.coalesce(F.sum(w * j[a] * j[b]), F.lit(0.0)).alias(f"h{a}{b}") for a in range(6) for b in range(a, 6)],
        *[F.coalesce(F.sum(w * j[a] * r), F.lit(0.0)).alias(f"g{a}") for a in range(6)],
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost"), F.coalesce(F.sum(r * r), F.lit(0.0)).alias("squares"), F.count(F.lit(1)).alias("n"),
    )


def evaluate(points: DataFrame, target: DataFrame, pose: np.ndarray, gate: float, huber: float, point_id: str, target_id: str) -> Sums:
    row = normal_sums(residuals(points, target, pose, gate, point_id, target_id), huber).first()
    h = np.zeros((6, 6))
    for a in range(6):
        for b in range(a, 6):
            h[a, b] = h[b, a] = row[f"h{a}{b}"]
    return Sums(h, np.array([row[f"g{a}"] for a in range(6)]), row["cost"], row["squares"], row["n"])


def without_weak(step: np.ndarray, h: np.ndarray, share: float) -> np.ndarray:
    """The step less its parts along directions whose eigenvalue is below a share of the largest."""
    values, vectors = np.linalg.eigh(h)
    weak = vectors[:, values < share * values.max()]
    return step - weak @ (weak.T @ step)


@dataclass
class Term:
    """Points against a target, and how much they weigh in a joint alignment."""

    points: DataFrame
    target: DataFrame
    weight: float = 1.0
    point_id: str = "point"
    target_id: str = "target"


def combined(sums: Sequence[Sums], weights: Sequence[float]) -> Sums:
    """One system of several terms, each by the number of its matches, so that a term of few points isn't drowned by one of many."""
    h, g, cost = np.zeros((6, 6)), np.zeros(6), 0.0
    for s, w in zip(sums, weights):
        n = max(s.n, 1)
        h, g, cost = h + w * s.h / n, g + w * s.g / n, cost + w * s.cost / n
    return Sums(h, g, cost, sum(s.squares for s in sums), sum(s.n for s in sums))


def align_terms(terms: Sequence[Term], start: np.ndarray, gates: list[float], huber: float = 0.1, steps: int = 20, tolerance: float = 1e-6, weak: float = 0.0) -> tuple[np.ndarray, float, list[int]]:
    """(pose, rms, matches of each term): one pose that moves the points of all terms, from coarse to fine gates. A step is kept only if the cost falls."""
    kept = [Term(t.points.cache(), t.target.cache(), t.weight, t.point_id, t.target_id) for t in terms]
    pose = start.copy()

    def at(p: np.ndarray, gate: float) -> tuple[Sums, list[int]]:
        each = [evaluate(t.points, t.target, p, gate, huber, t.point_id, t.target_id) for t in kept]
        return combined(each, [t.weight for t in kept]), [s.n for s in each]

    try:
        now, matches = at(pose, gates[0])
        for gate in gates:
            damping = DAMPING
            now, matches = at(pose, gate)
            for _ in range(steps):
                if now.n < 6:
                    break
                for _ in range(TRIES):
                    step = -np.linalg.solve(now.h + damping * (np.diag(np.diag(now.h)) + 1e-12 * np.eye(6)), now.g)
                    if weak:
                        step = without_weak(step, now.h, weak)
                    step = np.concatenate([np.clip(step[:3], -MOST_TURN, MOST_TURN), np.clip(step[3:], -MOST_SHIFT, MOST_SHIFT)])
                    tried = se3_exp(step) @ pose
                    then, found = at(tried, gate)
                    if then.n >= 6 and then.cost < now.cost:
                        pose, now, matches, damping = tried, then, found, max(LEAST_DAMPING, damping * EASE)
                        break
                    damping = min(MOST_DAMPING, damping * HARDEN)
                else:
                    break
                if np.abs(step).max() < tolerance:
                    break
        return pose, float(np.sqrt(now.squares / max(1, now.n))), matches
    finally:
        for t in kept:
            t.points.unpersist()
            t.target.unpersist()


def align(points: DataFrame, target: DataFrame, start: np.ndarray, gates: list[float], huber: float = 0.1, point_id: str = "point", target_id: str = "target", steps: int = 20, tolerance: float = 1e-6, weak: float = 0.0) -> tuple[np.ndarray, float, int]:
    """(pose, rms, matches) of one term, from coarse to fine gates."""
    pose, rms, matches = align_terms([Term(points, target, 1.0, point_id, target_id)], start, gates, huber, steps, tolerance, weak)
    return pose, rms, matches[0]


def costs_of(rows: DataFrame, cost: Callable[[Sequence], "F.Column"], names: int) -> Callable[[np.ndarray], np.ndarray]:
    """Sums of a cost over all rows for several settings of ``names`` parameters at once, in one aggregate.

    ``cost`` makes a column from the parameters of one setting; settings are few and become aggregates side by side.
    """

    def evaluate_all(settings: np.ndarray) -> np.ndarray:
        sums = [F.sum(cost([F.lit(float(v)) for v in s[:names]])).alias(f"c{i}") for i, s in enumerate(settings)]
        return np.array(rows.agg(*sums).first(), dtype=float)

    return evaluate_all


def descent(start: Sequence[float], low: Sequence[float], high: Sequence[float], rounds: int = 40, step: float = 1e-4, tolerance: float = 1e-10) -> Generator[np.ndarray, np.ndarray, tuple[np.ndarray, float]]:
    """Projected BFGS inside a box as a generator: it yields settings, is sent their costs, and returns (parameters, cost).

    Gradients are central differences, so a round takes two calls: all differences
    at once, then all lengths of the line search at once.
    """
    low, high = np.asarray(low, float), np.asarray(high, float)
    x = np.clip(np.asarray(start, float), low, high)
    wide = step * np.maximum(high - low, 1e-12)
    h, old = np.eye(len(x)), None
    value = float((yield x[None])[0])
    for _ in range(rounds):
        up, down = np.minimum(x + wide, high), np.maximum(x - wide, low)
        around = np.concatenate([np.where(np.eye(len(x), dtype=bool), up, x), np.where(np.eye(len(x), dtype=bool), down, x)])
        c = yield around
        g = (c[: len(x)] - c[len(x) :]) / np.maximum(up - down, 1e-300)
        if old is not None:
            s, y = x - old[0], g - old[1]
            if s @ y > 1e-14:
                r = np.eye(len(x)) - np.outer(s, y) / (s @ y)
                h = r @ h @ r.T + np.outer(s, s) / (s @ y)
        free = ~((x <= low) & (g > 0) | (x >= high) & (g < 0))
        way = np.where(free, -(np.where(free[:, None] & free, h, 0) @ g), 0.0)
        if way @ g >= 0:
            way, h = np.where(free, -g, 0.0), np.eye(len(x))
        size = 1.0 if old is not None else min(1.0, float(np.max(high - low)) / 4 / max(float(np.abs(way).max()), 1e-300))
        tried = np.clip(x + way * (size * 0.5 ** np.arange(12))[:, None], low, high)
        c = yield tried
        best = int(np.argmin(c))
        if not c[best] < value - tolerance * max(1.0, abs(value)):
            break
        old, x, value = (x, g), tried[best], float(c[best])
    return x, value


def minimise(costs: Callable[[np.ndarray], np.ndarray], start: Sequence[float], low: Sequence[float], high: Sequence[float], rounds: int = 40, step: float = 1e-4, tolerance: float = 1e-10) -> tuple[np.ndarray, float]:
    """(parameters, cost) of a minimum inside a box, by projected BFGS (``descent``)."""
    search = descent(start, low, high, rounds, step, tolerance)
    asked = next(search)
    while True:
        try:
            asked = search.send(costs(asked))
        except StopIteration as found:
            return found.value


def costs_by_key(rows: DataFrame, key: str, cost: Callable[[Sequence[Column]], Column], names: int) -> Callable[[dict], dict]:
    """Sums of a cost for each key, each with settings of its own, in one aggregate over the rows.

    ``cost`` makes a column from columns of parameters. Settings travel as a table by key, an array of them in each row, so keys can be many.
    """
    kind = rows.schema[key].dataType.simpleString()

    def evaluate_all(asked: dict) -> dict:
        table = [(k, [[float(v) for v in s[:names]] for s in settings]) for k, settings in asked.items()]
        settings = rows.sparkSession.createDataFrame(table, f"`{key}` {kind}, _settings array<array<double>>")
        each = rows.join(settings, key).select("*", F.posexplode("_settings").alias("_at", "_p"))
        sums = each.groupBy(key, "_at").agg(F.sum(cost([F.col("_p")[i] for i in range(names)])).alias("c")).collect()
        out = {k: np.full(len(s), np.inf) for k, s in asked.items()}
        for r in sums:
            out[r[key]][r["_at"]] = r["c"]
        return out

    return evaluate_all


def minimise_many(costs: Callable[[int], Callable[[dict], dict]], starts: dict, low: Sequence[float], high: Sequence[float], stages: int = 1, **how) -> dict:
    """Key to (parameters, cost): a bounded fit for each key, all in step, a round of all of them in one aggregate.

    ``costs`` gives the costs by key of a stage of the schedule (a finer blur, a
    narrower gate); each stage starts where the one before ended. A key whose fit has
    ended is not asked for again in its stage.
    """
    found = {k: (np.asarray(x, float), np.inf) for k, x in starts.items()}
    for stage in range(stages):
        ask = costs(stage)
        searches = {k: descent(x, low, high, **how) for k, (x, _) in found.items()}
        asked = {k: next(s) for k, s in searches.items()}
        while asked:
            told, following = ask(asked), {}
            for k in asked:
                try:
                    following[k] = searches[k].send(told[k])
                except StopIteration as done:
                    found[k] = done.value
            asked = following
    return found
