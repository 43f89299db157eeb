"""Token counts without token ids: pieces per distinct pre-token, joined to frequencies.

A text becomes a bag of pre-tokens. A first pass over the texts finds the
distinct pre-tokens of the corpus and how often each occurs; the tokenizer's
model counts the pieces of each of them once, into a table. A second pass joins
each text's bag with that table and sums. The join is in two parts: the
commonest ``head`` pre-tokens at most are broadcast and looked up where the bag
is made; what else a bag holds, by far the smaller part of it, is written out as
(row, pre-token, frequency) and meets the table in a shuffled equi-join. So
neither the broadcast nor a worker's memory grows with the corpus, and each
shuffled pre-token is one that is rare.

Special strings in a text count as one token each, as the library has it by
default. Characters whose case folding or class depends on the Unicode version
go through the library's own normaliser and splitter instead of Python's. Pieces
are counted by the model behind its byte step alone: a pre-token is normalised
already, and normalising once more can change it.

Results by case: a null text is empty, with 0 bytes and tokens; repeated rows
give repeated results; an empty table gives none; pre-tokens of any length are
counted whole; other columns, whatever their names, are not read. A vocabulary
that splits texts in another way is refused.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Normaliser and splitter of word_bpe_49k.json.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
SPLITTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, BYTES]}
#: Below this code point Python and the library agree on case, class and composition of all characters but the capital sigma.
AGREED = "԰"
#: Most pre-tokens that are broadcast.
HEAD = 1 << 18
#: Distinct pre-tokens that a worker gathers before it passes them on.
GATHERED = 200_000


class PieceCounter:
    """Splits texts into pre-tokens, and counts the pieces of pre-tokens, by a word-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        with open(path) as f:
            told = json.load(f)
        if told["normalizer"] != NORMALIZER or told["pre_tokenizer"] != SPLITTER or any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in told["added_tokens"]):
            raise ValueError(f"{path} normalises or splits texts in a way that is not known here")
        whole = Tokenizer.from_file(path)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        self.model = Tokenizer.from_str(json.dumps(told | {"normalizer": None, "pre_tokenizer": BYTES, "added_tokens": [], "truncation": None, "padding": None}))
        self.split = regex.compile(SPLIT).findall
        specials = [x["content"] for x in told["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.marks = sorted({s[:2] for s in specials})

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return self.split(text.lower())
        if max(text) < AGREED and "Σ" not in text:
            return self.split(unicodedata.normalize("NFC", text).lower())
        plain = self.normalizer.normalize_str(text)
        return [plain[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(plain)]

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Number of special strings, and all pre-tokens."""
        if self.special and any(m in text for m in self.marks) and (parts := self.special.split(text))[1:]:
            return len(parts) - 1, list(chain.from_iterable(map(self.pre_tokens, parts)))
        return 0, self.pre_tokens(text)

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch(tokens, add_special_tokens=False)]


class Head(dict):
    """Pieces of the broadcast pre-tokens; 0 for others."""

    def __missing__(self, token: str) -> int:
        return 0


_loaded: dict[str, PieceCounter] = {}


def loaded(vocabulary: str) -> PieceCounter:
    """One counter for each worker and vocabulary: an absolute path, or a name of the public tokenizers."""
    if vocabulary not in _loaded:
        import public_tokenizers

        _loaded[vocabulary] = PieceCounter(vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary))
    return _loaded[vocabulary]


_heads: dict[str, Head] = {}


def _head(name: str, sent) -> Head:
    """The broadcast head, made a Head once for each worker and call."""
    if name not in _heads:
        _heads.clear()
        _heads[name] = Head(sent.value)
    return _heads[name]


def distinct_pre_tokens(df: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """(token, n): each pre-token of the corpus and how often it occurs."""

    def run(batches):
        counter, seen = loaded(vocabulary), Counter()

        def gathered():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["token", "n"])

        for part in common.slices(batches):
            seen.update(chain.from_iterable(counter.parts(t)[1] for t in part.column(0).to_pylist() if t))
            if len(seen) > GATHERED:
                yield gathered()
                seen.clear()
        yield gathered()

    return df.select(text_col).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


def with_pieces(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """(token, n, pieces)."""

    def make():
        counter = loaded(vocabulary)
        return lambda rows: rows | {"pieces": counter.pieces(rows["token"])}

    return common.map_texts(tokens, ["token", "n"], "token string, n long, pieces long", make)


def commonest(pieces: DataFrame, most: int) -> tuple[Column, dict[str, int]]:
    """What tells the head from the rest of the table, and the head: ``most`` pre-tokens at most.

    A histogram of a few thousand levels tells from which frequency on no more than that many reach the driver.
    """
    level = F.when(F.col("n") <= 1000, F.col("n")).otherwise(1000 + F.floor(100 * F.log(F.col("n") / 1000))).cast("long")
    least, total = None, 0
    for row in sorted(pieces.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return F.lit(False), {}
    return level >= least, {r["token"]: r["pieces"] for r in pieces.where(level >= least).select("token", "pieces").collect()}


def token_counts(df: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    spark = df.sparkSession
    work = common.Workspace(spark)
    pieces = work.keep(with_pieces(work.keep(distinct_pre_tokens(df, vocabulary, text_col), "distinct"), vocabulary), "pieces")
    in_head, known = commonest(pieces, head)
    sent, name = spark.sparkContext.broadcast(known), work.top

    def make():
        counter, get = loaded(vocabulary), _head(name, sent).__getitem__

        def work(rows):
            out = {c: [] for c in ("n_bytes", "known", "rest")}
            for text in rows["text"]:
                text = text or ""
                special, tokens = counter.parts(text)
                bag = Counter(tokens)
                found = list(map(get, bag))
                out["n_bytes"].append(len(text) if text.isascii() else len(text.encode()))
                out["known"].append(special + sum(map(int.__mul__, found, bag.values())))
                out["rest"].append([{"token": t, "f": f} for p, (t, f) in zip(found, bag.items()) if not p] if 0 in found else [])
            return {"row": rows["row"], "doc_id": rows["doc_id"]} | out

        return work

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bags = work.keep(common.map_texts(rows, ["row", "doc_id", "text"], "row long, doc_id long, n_bytes long, known long, rest array<struct<token:string,f:long>>", make), "bags")
    rare = bags.select("row", F.explode("rest").alias("e")).select("row", "e.token", "e.f").join(pieces.where(~in_head).select("token", "pieces"), "token")
    rare = rare.groupBy("row").agg(F.sum(F.col("f") * F.col("pieces")).alias("more"))
    n = F.col("known") + F.coalesce("more", F.lit(0).cast("long"))
    return bags.drop("rest").join(rare, "row", "left").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
