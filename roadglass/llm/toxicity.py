"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features are the distinct words, word pairs and pairs with one word skipped,
hashed to 2^20 numbers. FTRL-proximal keeps a learning rate for each coordinate
and sets small weights to exactly zero (L1), so the model that reaches the
executors is a short list of (number, weight).

Training takes a bounded sample of labelled rows, about ``positives`` and
``negatives`` of them at most and no more than ``sample_bytes`` of their texts,
chosen by a hash of the id; the intercept is then corrected for the shares. One
task sees the sample's features in the order of that hash, ``epochs`` times,
positives with ``weight``. Scoring reads every text whole.

Results by case: a null text is empty and gets the intercept's score; without
labels the score is 0; of several labels for an id the largest counts, of several
texts the one whose features come first, so that repeated rows teach once (each
gets a score); a null label teaches nothing; ids with equal ranks are learned in
order of a second hash; an empty table gives none; texts of any length are scored
whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 20
TOKEN = re.compile(r"\w+").findall
#: Words whose hash a worker remembers.
REMEMBERED = 300_000
#: Odd multipliers that mix the hashes of words into features.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "replace")) + 1
        return value


_hashes = _Hashes()


def feature_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text, and of the feature, for all occurrences in a slice of texts."""
    words = [TOKEN(t.lower()) for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    h = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    with np.errstate(over="ignore"):
        a, b, c = (h * np.uint64(m) for m in MIX)
        docs, found = [doc], [a]
        for gap, second in ((1, b), (2, c)):
            same = doc[:-gap] == doc[gap:]
            docs.append(doc[:-gap][same])
            found.append(((a[:-gap] ^ second[gap:]) * np.uint64(MIX[gap]))[same])
    return np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


class FTRL:
    """Follow the regularised leader, proximal form, on sets of binary features."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 12.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)  # the last is the intercept

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def learn(self, at: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(at)
        g = (1 / (1 + math.exp(-max(-35.0, min(35.0, float(w.sum()))))) - label) * weight
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def sparse(self) -> tuple[list[int], list[float]]:
        w = self.weights(np.arange((1 << BITS) + 1))
        at = np.flatnonzero(w)
        return at.tolist(), w[at].tolist()


def fit(
    docs: DataFrame, labels: DataFrame, positives: int = 8000, negatives: int = 12000, sample_bytes: int = 128_000_000, epochs: int = 4, weight: float = 4.0,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> dict[int, float]:
    """Weights by feature number from rows that are not held out; empty without labels."""
    marked = labels.where(~common.held_out(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    n = {r["y"]: r["n"] for r in marked.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: min(1.0, most / max(1, n.get(y, 0))) for y, most in ((1, positives), (0, negatives))}
    mixed = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    # ids of the sample: about positives + negatives of them at most
    sample = marked.where(mixed / (1 << 30) < F.when(F.col("y") > 0, share[1]).otherwise(share[0])).withColumn("rank", mixed)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.select(F.xxhash64("id").alias("id"), "rank", "y", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    # the first ids by hash whose different texts fit the bound, counted in 1024 steps of the hash
    sizes = rows.groupBy("id", "h").agg(F.first("rank").alias("rank"), F.first(F.octet_length("text")).alias("size"))
    size, least = 0, 1 << 30
    for r in sorted(sizes.groupBy(F.shiftright("rank", 20).alias("step")).agg(F.sum("size").alias("size")).collect()):
        size += r["size"]
        if size > sample_bytes:
            least = r["step"] << 20
            break
    rows = rows.where(F.col("rank") < least)

    def make():
        given: set[tuple[int, int]] = set()  # of this task; as many as the sample has different texts at most

        def work(part):
            new = []
            for i, key in enumerate(zip(part["id"], part["h"])):
                if key not in given:
                    given.add(key)
                    new.append(i)
            doc, found = feature_rows([part["text"][i] for i in new])
            keys = np.unique((doc << BITS) | found)
            cuts = np.searchsorted(keys >> BITS, np.arange(len(new) + 1))
            return {"id": [part["id"][i] for i in new], "rank": [part["rank"][i] for i in new], "y": [int(part["y"][i] > 0) for i in new], "at": [(keys[a:b] & ((1 << BITS) - 1)).tolist() for a, b in zip(cuts, cuts[1:])]}

        return work

    def train(batches):
        seen = [x for b in batches for x in zip(b["rank"].to_pylist(), b["id"].to_pylist(), b["y"].to_pylist(), (np.append(np.asarray(a.values, dtype=np.int32), np.int32(1 << BITS)) for a in b["at"]))]
        seen.sort(key=lambda x: (*x[:3], x[3].tobytes()))
        model = FTRL()
        for _ in range(epochs):
            last = None
            for _, own, y, at in seen:
                if own != last:
                    model.learn(at, y, weight if y else 1.0)
                last = own
        if seen:
            at, w = model.sparse()
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "w": pa.array(w, pa.float64())})

    features = common.map_texts(rows, ["id", "h", "text", "rank", "y"], "id long, rank long, y int, at array<int>", make)
    out = {r["at"]: r["w"] for r in features.repartition(1).mapInArrow(train, "at int, w double").collect()}
    if out:
        out[1 << BITS] = out.get(1 << BITS, 0.0) + math.log(share[0] / share[1])
    return out


def score(df: DataFrame, weights: dict[int, float], threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    at = np.array(sorted(weights), dtype=np.int64)
    w = np.array([weights[i] for i in at], dtype=np.float64)

    def make():
        dense = np.zeros(1 << BITS)
        dense[at[at < 1 << BITS]] = w[at < 1 << BITS]
        start = float(w[at == 1 << BITS].sum()) if len(at) else -math.inf

        def work(rows):
            doc, found = feature_rows([t or "" for t in rows[text_col]])
            hit = dense[found] != 0
            keys = np.unique((doc[hit] << BITS) | found[hit])
            sums = np.bincount(keys >> BITS, weights=dense[keys & ((1 << BITS) - 1)], minlength=len(rows[text_col])) + start
            p = 1 / (1 + np.exp(-np.clip(sums, -700, 700))) if len(at) else np.zeros(len(sums))
            return {"doc_id": rows[id_col], "held_out": rows["held_out"], "score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

        return work

    rows = df.select(F.col(id_col), F.col(text_col), common.held_out(F.col(id_col)).alias("held_out"))
    return common.map_texts(rows, [id_col, text_col, "held_out"], "doc_id long, held_out boolean, score double, predicted int", make)
