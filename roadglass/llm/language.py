"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams of one to three characters,
by rank. A document's own list is compared with each profile by the out-of-place
distance: the sum of differences in rank, with the length of a profile for an
n-gram that it lacks. The nearest profile names the language; the score is one
minus the distance as a share of the largest possible distance.

Texts are lower-cased; each run of characters that are not letters becomes one
word boundary, and boundaries take part in n-grams at either end. Three code
points of 21 bits fill one 64-bit integer, so n-grams are exact integers.

Profiles are learned from a bounded sample: about ``rows_per_language`` labelled
rows of each language, chosen by a hash of the id. Prediction reads every text
whole. Languages come in blocks of about ``LANGUAGES``, so that what is broadcast
is bounded; each block is learned, and held against all texts, in a pass of its
own, and the smallest distance of all blocks counts. Most corpora have one block.

Results by case: a null text, or one without letters, is ``und`` with score 0,
and so is all if nothing can be learned; equal counts rank by n-gram, equal
distances by name; rows with a null language or text teach nothing; repeated
rows teach as often as they occur and get a result each; an empty table gives
none; texts of any length are read whole; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BOUNDARY = 1
UNKNOWN = "und"
#: Spreads the n-grams of one language over tasks before the final choice.
SALTS = 16
#: Languages that are broadcast at a time.
LANGUAGES = 1000
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams in ascending order, and how often each occurs."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    c = np.concatenate(([BOUNDARY], np.where(_letter_table()[c], c, BOUNDARY), [BOUNDARY]))
    c = c[np.concatenate(([True], (c[1:] != BOUNDARY) | (c[:-1] != BOUNDARY)))]
    if len(c) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = (c[:-1] << 21) | c[1:]
    triples = ((pairs[:-1] << 21) | c[2:])[c[1:-1] != BOUNDARY]
    return np.unique(np.concatenate((c[c != BOUNDARY], pairs, triples)), return_counts=True)


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes by rank."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def fit_profiles(df: DataFrame, train: Column, size: int = 400, rows_per_language: int = 3000, a_block: int = LANGUAGES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Iterator[dict[str, np.ndarray]]:
    """N-gram codes by rank for each language, a block of languages at a time; the driver gets a_block x size rows for each."""
    rows = df.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    counted = rows.groupBy("lang").count()
    blocks = -(-counted.count() // a_block)

    def make():
        def work(part):
            by = {}
            for lang, text in zip(part["lang"], part["text"]):
                by.setdefault(lang, []).append(text)
            out = {"lang": [], "code": [], "n": []}
            for lang, texts in by.items():
                codes, counts = ngram_counts("\n".join(texts))
                out["lang"] += [lang] * len(codes)
                out["code"] += codes.tolist()
                out["n"] += counts.tolist()
            return out

        return work

    share = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    order = [F.desc("n"), F.asc("code")]
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("code"), F.lit(SALTS))).orderBy(*order)
    last = Window.partitionBy("lang").orderBy(*order)
    for k in range(blocks):
        own = counted if blocks == 1 else counted.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k)
        chosen = rows.join(F.broadcast(own), "lang").where(share * F.col("count") < rows_per_language)
        grams = common.map_texts(chosen, ["lang", "text"], "lang string, code long, n long", make).groupBy("lang", "code").agg(F.sum("n").alias("n"))
        best = grams.withColumn("r", F.row_number().over(first)).where(F.col("r") <= size).withColumn("r", F.row_number().over(last)).where(F.col("r") <= size)
        out: dict[str, list[int]] = {}
        for r in sorted(best.select("lang", "code", "r").collect(), key=lambda r: (r["lang"], r["r"])):
            out.setdefault(r["lang"], []).append(r["code"])
        if out:
            yield {lang: np.array(codes, dtype=np.int64) for lang, codes in out.items()}


class Ranker:
    """Distances of texts to a block of profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.names, self.size = sorted(profiles), size
        self.codes = np.unique(np.concatenate([profiles[n] for n in self.names]))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, dtype=np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[name]), k] = np.arange(len(profiles[name]))

    def nearest(self, text: str | None) -> tuple[int | None, str | None, int]:
        """(distance, name, largest possible distance) of the nearest profile; nulls without letters."""
        codes, counts = ngram_counts(text or "")
        if not len(codes):
            return None, None, 0
        own = top(codes, counts, self.size)
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        ranks = self.ranks[at]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(distance))
        return int(distance[best]), self.names[best], self.size * len(own)


def identify(df: DataFrame, profiles: Iterable[dict[str, np.ndarray]], size: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, by the nearest of all blocks of profiles."""
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), common.held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"),
        F.lit(None).cast("long").alias("distance"), F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("most"),
    )
    for block in profiles:

        def make(block=block):
            ranker = Ranker(block, size)

            def work(part):
                for i, text in enumerate(part["text"]):
                    distance, name, most = ranker.nearest(text)
                    if distance is not None and (part["distance"][i] is None or (distance, name) < (part["distance"][i], part["name"][i])):
                        part["distance"][i], part["name"][i], part["most"][i] = distance, name, most
                return part

            return work

        rows = common.map_texts(rows, rows.columns, "doc_id long, held_out boolean, text string, distance long, name string, most long", make)
    found = F.col("name").isNotNull()
    return rows.select("doc_id", "held_out", F.when(found, F.col("name")).otherwise(UNKNOWN).alias("lang_pred"), F.when(found, 1 - F.col("distance") / F.col("most")).otherwise(0.0).alias("score"))
