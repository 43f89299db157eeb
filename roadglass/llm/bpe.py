"""Byte-level BPE: encode and decode whole texts by a table of merge ranks.

Merging one pre-token takes pairs in order of rank, leftmost first. A queue of
ranks gives that order: each rank has a bucket of positions in a doubly linked
list of symbols, and a bitmap in two levels of 256-bit words says which buckets
have entries, so the next rank is two find-first-set steps away however long the
pre-token is. Merges leave entries behind that no longer hold; they are recognised when
they come up, because the pair at that position has another rank by then.
A text of n bytes takes O(n log b), b the largest bucket, and never O(n^2).

Results by case: a null text is the empty text, with no token, the hashes of
empty strings; repeated rows give repeated results; an empty table gives none;
pre-tokens of any length are merged whole; equal ranks merge from the left;
columns are carried along under any name but those of results, which are refused.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame

from . import common

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Pre-tokens that a worker remembers in each of two generations.
REMEMBERED = 330_000
#: Longer pre-tokens are encoded anew each time, so that the memory stays small.
LONGEST_REMEMBERED = 64


class RankQueue:
    """Buckets of list positions by merge rank; a two-level bitmap of 256-bit words finds the smallest rank in use.

    A bucket is a position, or a heap of positions where a rank has several,
    since equal ranks are merged from the left.
    """

    BITS = [1 << i for i in range(256)]

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0
        self.buckets: dict[int, int | list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        buckets = self.buckets
        if rank in buckets:
            bucket = buckets[rank]
            if bucket.__class__ is int:
                buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
            else:
                heappush(bucket, position)
        else:
            buckets[rank] = position
            word = rank >> 8
            if not self.low[word]:
                self.top |= self.BITS[word]
            self.low[word] |= self.BITS[rank & 255]

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        word = (top & -top).bit_length() - 1
        bits = self.low[word]
        rank = (word << 8) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        if bucket.__class__ is int:
            del self.buckets[rank]
            self.low[word] = bits = bits & (bits - 1)
            if not bits:
                self.top = top & (top - 1)
            return rank, bucket
        position = heappop(bucket)
        if len(bucket) == 1:
            self.buckets[rank] = bucket[0]
        return rank, position


class ByteBPE:
    """A rank table with its pre-token pattern: encode, decode."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        size = max(ranks.values(), default=-1) + 1
        self.queue = RankQueue(size)
        self.vocabulary: list[bytes] = [b""] * size
        for symbol, rank in ranks.items():
            self.vocabulary[rank] = symbol
        self.decimal = [str(i) for i in range(size)]
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.remembered = REMEMBERED

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks, queue = self.ranks, self.queue
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if n < 2:
            return [ranks[piece]]
        after = list(range(1, n + 2))  # start of the next symbol; n ends the list
        before = list(range(-1, n))  # start of the previous symbol
        # the queue's push and pop, in line: most of the time of short pre-tokens is theirs
        get, buckets, low, bits_of, top = ranks.get, queue.buckets, queue.low, queue.BITS, 0
        pair = [get(piece[i : i + 2]) for i in range(n - 1)]  # rank of the pair that starts here, or None
        pair += (None, None)
        fresh = list(enumerate(pair))
        while True:
            for i, rank in fresh:
                if rank is not None:
                    bucket = buckets.get(rank)
                    if bucket is None:
                        buckets[rank] = i
                        word = rank >> 8
                        top |= bits_of[word]
                        low[word] |= bits_of[rank & 255]
                    elif bucket.__class__ is int:
                        buckets[rank] = [bucket, i] if bucket < i else [i, bucket]
                    else:
                        heappush(bucket, i)
            while top:
                word = (top & -top).bit_length() - 1
                bits = low[word]
                rank = (word << 8) + (bits & -bits).bit_length() - 1
                bucket = buckets[rank]
                if bucket.__class__ is int:
                    i = bucket
                    del buckets[rank]
                    low[word] = bits = bits & (bits - 1)
                    if not bits:
                        top &= top - 1
                else:
                    i = heappop(bucket)
                    if len(bucket) == 1:
                        buckets[rank] = bucket[0]
                if pair[i] == rank:
                    break  # else stale: merged away, or with another neighbour now
            else:
                break
            j = after[i]
            k = after[i] = after[j]
            pair[j] = found = None
            if k < n:
                before[k] = i
                found = get(piece[i : after[k]])
            pair[i] = found
            fresh = [(i, found)]
            if i:
                h = before[i]
                found = get(piece[h:k])
                if found != pair[h]:
                    pair[h] = found
                    fresh.append((h, found))
        out, i = [], 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out

    def ids_of(self, token: str) -> tuple[int, ...]:
        ids = self.young.get(token)
        if ids is None:
            ids = self.old.get(token)
            if ids is None:
                ids = tuple(self.merge(token.encode()))
            if len(token) <= LONGEST_REMEMBERED:
                if len(self.young) >= self.remembered:
                    self.old, self.young = self.young, {}
                self.young[token] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        tokens = self.split(text)
        found = list(map(self.young.get, tokens))
        if None in found:
            found = [self.ids_of(t) if ids is None else ids for t, ids in zip(tokens, found)]
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


_loaded: dict[tuple[str, str], ByteBPE] = {}


def loaded(path: str, pattern: str) -> ByteBPE:
    """One codec for each worker and vocabulary; later tasks of the worker find its memory warm."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBPE.load(path, pattern)
    return _loaded[path, pattern]


def _locate(vocabulary: str, pattern: str | None) -> tuple[str, str]:
    """Where this machine has the vocabulary: an absolute path, or a name of the public tokenizers."""
    import os

    import public_tokenizers

    return vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary), pattern or public_tokenizers.PATTERN


def encode(df: DataFrame, vocabulary: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; a null text gives an empty array."""
    if id_col == "ids":
        raise ValueError("the id column can't be named ids")

    def make():
        codec = loaded(*_locate(vocabulary, pattern))
        return lambda rows: {id_col: rows[id_col], "ids": [codec.encode(t or "") for t in rows[text_col]]}

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_texts(df, [id_col, text_col], f"`{id_col}` {kind}, ids array<int>", make)


def decode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; bytes that are not UTF-8 become U+FFFD; null ids give an empty text."""
    if id_col == "text":
        raise ValueError("the id column can't be named text")

    def make():
        codec = loaded(*_locate(vocabulary, None))
        return lambda rows: {id_col: rows[id_col], "text": [codec.decode(x or []).decode("utf-8", "replace") for x in rows[ids_col]]}

    kind = df.schema[id_col].dataType.simpleString()
    return common.map_texts(df, [id_col, ids_col], f"`{id_col}` {kind}, text string", make)


def digests(df: DataFrame, vocabulary: str, pattern: str | None = None, extra: list[str] | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """Encode, decode the ids again and hash both; the ids of a text live only while it is hashed.

    ``extra`` columns of the input are carried along. ``remembered`` pre-tokens,
    in each of two generations, are what a worker's memory goes by.
    """
    extra = extra or []
    if clash := {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}.intersection(extra):
        raise ValueError(f"extra columns with names of results: {sorted(clash)}")

    def make():
        codec = loaded(*_locate(vocabulary, pattern))
        codec.remembered = remembered

        def work(rows):
            out = {c: rows[c] for c in ["doc_id", *extra]} | {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in rows["text"]:
                ids = codec.encode(text or "")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(codec.joined(ids).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            return out

        return work

    columns = ["doc_id", "text", *[c for c in extra if c != "text"]]
    schema = SCHEMA + "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in extra)
    return common.map_texts(df, columns, schema, make)
