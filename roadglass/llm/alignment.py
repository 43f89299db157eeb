"""Alignment of two tokenizers over the bytes of each text.

Both tokenizers cut the same bytes. A label string says of each byte whether a
token of A ends there, one of B, both or none; a regular expression scans it for
spans up to each both-label, and the labels of a span count its tokens of A and B:
that span is one group. Where both end, their tokens are linked.

A and B are a byte-level BPE of the tokenizers library and a sentencepiece model
that writes spaces as U+2581. Neither has a token that goes on across the start of
a run of white space (checked when they are loaded: no piece of B holds U+2581, or
another character that may start a cut, but at its beginning), so a text is cut
there, each distinct stretch is encoded and labelled once while a worker
remembers it, and texts are put together from stretches. Stretches are labelled
many at a time, as one label string: every stretch ends with a both-label.

How often two ids are linked in the corpus takes a pass of its own: each task
counts, Spark sums. Of two linked tokens one's bytes end the other's, so there are
no more pairs than the vocabularies have bytes, about half a million here
(``most_pairs``), whatever the corpus: that table is bounded and is broadcast to
the pass that counts for each text.

Results by case: texts that are null, empty, or whose tokens of A or B don't join
to a space and the text (a U+2581 in the text, for one) have no tokens, zeros and
an empty string, and count nowhere; repeated rows count and give results each time;
an empty table gives none; texts of any length are aligned whole; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: White space of Unicode, and what Python takes for it too.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: In texts without any of these a stretch is a word and the one space or line break before it; those of ASCII come first.
ODD = ("  ", " \n", "\n ", "\n\n", *(c for c in SPACES if c not in " \n"))
ASCII = sum(x.isascii() for x in ODD)
#: Such stretches that are encoded as one text.
JOINED = 1000
#: Starts the key of a stretch that neither begins with a line break nor with one space before a word; no text holds it.
OTHER = "\ud800"
#: Stretches, and characters of them, that a worker remembers; the commonest third stays when it forgets.
REMEMBERED, CHARACTERS = 400_000, 40_000_000
#: Labels: A ends, B ends, both.
A_END, B_END, BOTH = 1, 2, 3
#: Characters about whose class libraries of different age may differ; below, all agree.
_newer = re.compile("[\u0530-\U0010ffff]").search
_GROUP = re.compile(rb"[^\x03]*\x03")


def byte_of_character() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        with open(a_path) as f:
            told = json.load(f)
        split = told["pre_tokenizer"]
        if told["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{a_path} is not a byte-level vocabulary with the usual splitter")
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        to_byte = byte_of_character()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        special = {x["id"] for x in told["added_tokens"]}
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if i in special else bytes(map(to_byte.__getitem__, token))
        # where ids follow the order of merges, a faster library merges alike; it may split characters that are newer than this one in another way
        model, self.fast = told["model"], None
        if not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")) and all(model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] == 256 + i for i, m in enumerate(model["merges"])):
            import public_tokenizers
            import tiktoken

            ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in special}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b = self.b
        self.b_bytes, inner = [], set()
        for i in range(b.get_piece_size()):
            piece = b.id_to_piece(i)
            if b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
                inner.update(piece.lstrip("▁")[:1] if piece[0] == "▁" else "", piece[1:] if piece[0] != "▁" else piece.lstrip("▁")[1:])
                if "▁" in piece.lstrip("▁") or "\n" in piece:
                    raise ValueError(f"{b_path} has pieces that go on across spaces or line breaks")
        self.lead = b.encode("\n")
        if b"".join(self.b_bytes[i] for i in self.lead) != b" \n":
            raise ValueError(f"{b_path} adds no space, or changes line breaks")
        # white space that may stand in the middle of a piece starts no cut
        soft = re.escape("".join(c for c in SPACES[1:] if c in inner))
        w = re.escape(SPACES)
        self.stretches = re.compile(rf"[{w}]*[^{w}]+" + (rf"(?:[{soft}][{w}]*[^{w}]*)*" if soft else "") + rf"|[{w}]+").findall
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def most_pairs(self) -> int:
        """No corpus links more pairs of ids: one of two linked tokens ends the other."""
        return int(self.a_sizes.sum() + self.b_sizes.sum())

    def keys(self, text: str) -> list[str]:
        """Keys of the stretches of a space and the text."""
        if text[-1] not in " \n" and text[0] not in " \n" and not any(x in text for x in ODD[: ASCII if text.isascii() else None]):
            return text.replace("\n", " \n").split(" ")
        return [self.key(x) for x in self.stretches(" " + text)]

    @staticmethod
    def key(stretch: str) -> str:
        if stretch[0] == "\n":
            return stretch
        return stretch[1:] if stretch[0] == " " and len(stretch) > 1 and stretch[1] not in SPACES else OTHER + stretch

    @staticmethod
    def stretch(key: str) -> str:
        return key if key[0] == "\n" else key[1:] if key[0] == OTHER else " " + key

    def _encode_each(self, stretches: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        fast = [k for k, x in enumerate(stretches) if self.fast and not _newer(x)]
        a = dict(zip(fast, map(self.fast, (stretches[k] for k in fast)))) if fast else {}
        slow = [k for k in range(len(stretches)) if k not in a]
        a |= zip(slow, (x.ids for x in self.a.encode_batch_fast([stretches[k] for k in slow], add_special_tokens=False)))
        # B puts a space before: that of the stretch, or one before a line break that is cut off again
        b = self.b.encode([x[1:] if x[0] == " " else "\n" + x for x in stretches], num_threads=1)
        lead = len(self.lead)
        return zip(map(a.__getitem__, range(len(stretches))), (ids if x[0] == " " else ids[lead:] for x, ids in zip(stretches, b)))

    def encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, how many each stretch has, the same of B, and which stretches don't equal their tokens and have none.

        Words with one space or line break before are encoded many at a time as one text, which is cut where they begin.
        """
        n = len(stretches)
        raw = [x.encode() for x in stretches]
        size = np.fromiter(map(len, raw), np.int64, n)
        bad = np.zeros(n, dtype=bool)
        whole = [k for k, x in enumerate(stretches) if x[0] in " \n" and x[1:] and x[1] not in SPACES and x[-1] not in SPACES]
        single = np.ones(n, dtype=bool)
        newer = {k for k in whole if _newer(stretches[k])}
        kinds = [[k for k in whole if k not in newer], sorted(newer)]
        lots = [kind[k : k + JOINED] for kind in kinds for k in range(0, len(kind), JOINED)]
        ids: list[list[np.ndarray | None]] = [[None] * n, [None] * n]
        for lot, *got in zip(lots, *zip(*self._encode_each(["".join(stretches[k] for k in lot) for lot in lots]))) if lots else ():
            text, ends = b"".join(raw[k] for k in lot), np.cumsum(size[lot])
            if all(b"".join(map(table.__getitem__, x)) == text for table, x in zip((self.a_bytes, self.b_bytes), got)):
                single[lot] = False
                for side, sizes, x in zip(ids, (self.a_sizes, self.b_sizes), got):
                    x = np.array(x, dtype=np.int64)
                    at = np.searchsorted(np.cumsum(sizes[x]), ends, "right").tolist()
                    for k, s, e in zip(lot, [0, *at], at):
                        side[k] = x[s:e]
        rest = np.flatnonzero(single).tolist()
        for k, *got in zip(rest, *zip(*self._encode_each([stretches[k] for k in rest]))) if rest else ():
            bad[k] = any(b"".join(map(table.__getitem__, x)) != raw[k] for table, x in zip((self.a_bytes, self.b_bytes), got))
            for side, x in zip(ids, got):
                side[k] = np.array([] if bad[k] else x, dtype=np.int64)
        flat = []
        for side in ids:
            flat += [np.concatenate(side) if n else np.zeros(0, dtype=np.int64), np.fromiter(map(len, side), np.int64, n)]
        return *flat, bad


_loaded: dict[tuple[str, str], Tokenizers] = {}


def loaded(a: str, b: str) -> Tokenizers:
    """One pair for each worker: absolute paths, or names of the public tokenizers."""
    if (a, b) not in _loaded:
        import public_tokenizers

        _loaded[a, b] = Tokenizers(*(x if os.path.isabs(x) else public_tokenizers.path(x) for x in (a, b)))
    return _loaded[a, b]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All items, and how many each list has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def labels(n: int, a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """A label for each of n bytes."""
    out = np.zeros(n, dtype=np.uint8)
    out[a_ends - 1] = A_END
    out[b_ends - 1] |= B_END
    return out


def group_sizes(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B each group has: the labels of each span up to a both-label."""
    told: dict[bytes, tuple[int, int]] = {}
    spans = _GROUP.findall(label.tobytes().translate(None, b"\0"))  # bytes without a label count for nothing
    for span in set(spans):
        both = span.count(BOTH)
        told[span] = (span.count(A_END) + both, span.count(B_END) + both)
    return tuple(np.array([told[s] for s in spans], dtype=np.int64).reshape(-1, 2).T)


class Aligned:
    """Stretches of a batch: counts, links and groups written out."""

    def __init__(self, t: Tokenizers, stretches: list[str], written: bool):
        n = len(stretches)
        a, a_n, b, b_n, self.bad = t.encode(stretches)
        a_end, b_end = np.cumsum(t.a_sizes[a]), np.cumsum(t.b_sizes[b])
        label = labels(int(a_end[-1]) if n and len(a_end) else 0, a_end, b_end)
        a_last, b_last = label[a_end - 1] == BOTH, label[b_end - 1] == BOTH
        self.n_a, self.n_b = a_n, b_n
        self.link_a, self.link_b = a[a_last], b[b_last]
        self.group_a, self.group_b = group_sizes(label)
        upto = np.concatenate([[0], np.cumsum(a_last)])
        self.n_groups = np.diff(upto[np.concatenate([[0], np.cumsum(a_n)])])
        self.a, self.b = a, b
        self.written = self._write(a, b, a_last, b_last, n) if written else None

    def _write(self, a, b, a_last, b_last, n: int) -> list[str]:
        """The groups of each stretch as a1,a2|b1; and so on."""
        before_a, before_b = np.cumsum(self.group_a) - self.group_a, np.cumsum(self.group_b) - self.group_b
        out = np.empty(len(a) + len(b), dtype=np.int64)
        out[np.arange(len(a)) + np.repeat(before_b, self.group_a)] = a * 4 + a_last
        out[np.arange(len(b)) + np.repeat(before_a + self.group_a, self.group_b)] = b * 4 + 2 + b_last
        parts = list(map(_number.__getitem__, out.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[s:e]) for s, e in zip([0, *ends], ends)]


class _Numbers(dict):
    """An id and what follows it: 4 * id + 2 if of B + 1 if the last of its side in the group."""

    def __missing__(self, code: int) -> str:
        self[code] = text = f"{code >> 2}{(',', '|', ',', ';')[code & 3]}"
        return text


_number = _Numbers()


class Memory(dict):
    """Key of a stretch to its number, and what is known of it by number.

    With a table of pairs (codes in order, counts, whether best), links are
    looked up at once; without, they are kept to be counted.
    """

    def __init__(self, t: Tokenizers, table: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
        self.t, self.table = t, table
        self.new: list[str] = []
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.characters, self.parts, self.texts = 0, [], []
        self.hits = np.zeros(0, dtype=np.int64)
        self.values = np.zeros((6, 0), dtype=np.int64)  # tokens of A and B, groups, best links, sum of counts, bad

    def __missing__(self, key: str) -> int:
        self[key] = i = len(self)
        self.new.append(key)
        return i

    def look(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all stretches, and how many each text has; new ones are learned."""
        found = [list(map(self.__getitem__, self.t.keys(x))) if x else [] for x in texts]
        self.learn()
        flat, sizes = _flat(found)
        wrong = self.values[5][flat] > 0
        if wrong.any():  # as a whole, such a text joins to itself or not
            for i in np.unique(np.repeat(np.arange(len(texts)), sizes)[wrong]).tolist():
                found[i] = [self[OTHER + " " + texts[i]]]
            self.learn()
            flat, sizes = _flat(found)
        return flat, sizes

    def learn(self) -> None:
        if not self.new:
            return
        stretches = [self.t.stretch(k) for k in self.new]
        self.characters += sum(map(len, stretches))
        got = Aligned(self.t, stretches, written=self.table is not None)
        best = total = np.zeros(len(stretches), dtype=np.int64)
        if self.table is None:
            self.parts.append((len(self.values[0]), got))
        else:
            codes, counts, is_best = self.table
            at = np.searchsorted(codes, got.link_a * len(self.t.b_bytes) + got.link_b)
            end = np.cumsum(got.n_groups)
            best, total = (np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], end])]) for x in (is_best[at].astype(np.int64), counts[at]))
            self.texts += got.written
        self.values = np.concatenate([self.values, [got.n_a, got.n_b, got.n_groups, best, total, got.bad.astype(np.int64)]], axis=1)
        self.new = []

    def full(self) -> bool:
        return len(self) > REMEMBERED or self.characters > CHARACTERS

    def commonest(self, hits: np.ndarray) -> list[str]:
        """Keys that came twice or more, the commonest third of what is remembered at most."""
        order = np.argsort(-hits, kind="stable")[: REMEMBERED // 3]
        stay = set(order[hits[order] > 1].tolist())
        return [k for k, i in self.items() if i in stay and len(k) < 100]

    def renew(self, hits: np.ndarray) -> None:
        """Forget all but the commonest, which are learned again."""
        stay = self.commonest(hits)
        self.forget()
        for k in stay:
            self[k]
        self.learn()


_memory: dict[str, Memory] = {}


def _remembered(name: str, make) -> Memory:
    """One memory for each worker and pass."""
    if name not in _memory:
        _memory.clear()
        _memory[name] = make()
    return _memory[name]


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([x, np.zeros(n - len(x), dtype=x.dtype)]) if n > len(x) else x


def pair_counts(df: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, text_col: str = "text") -> DataFrame:
    """(a_id, b_id, n): how often each two ids are linked in the corpus; rows are bounded by the vocabularies."""

    def run(batches):
        t = loaded(a, b)
        memory = _remembered(f"pairs {a} {b}", lambda: Memory(t, None))
        hits = np.zeros(len(memory), dtype=np.int64)

        def gathered():
            codes, weights = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for start, got in memory.parts:
                n = hits[start : start + len(got.n_a)]
                n = np.repeat(_grown(n, len(got.n_a)), got.n_groups)
                codes.append((got.link_a * len(t.b_bytes) + got.link_b)[n > 0])
                weights.append(n[n > 0])
            code, at = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(at, np.concatenate(weights), len(code)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (code // len(t.b_bytes), code % len(t.b_bytes), n)], names=["a_id", "b_id", "n"])

        for part in common.slices(batches):
            flat, _ = memory.look(part.column(0).to_pylist())
            hits = _grown(hits, len(memory)) + np.bincount(flat, minlength=len(memory))
            if memory.full():
                yield gathered()
                memory.renew(hits)
                hits = np.zeros(len(memory), dtype=np.int64)
        yield gathered()

    return df.select(text_col).mapInArrow(run, "a_id long, b_id long, n long").groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def digests(df: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = df.sparkSession
    t = loaded(a, b)
    counted = pair_counts(df, a, b, text_col).toArrow()
    if len(counted) > t.most_pairs():
        raise AssertionError("more pairs than the vocabularies can have")
    a_id, b_id, n = (counted[c].to_numpy() for c in ("a_id", "b_id", "n"))
    code = a_id * len(t.b_bytes) + b_id
    order = np.argsort(code)
    highest = np.zeros(len(t.b_bytes), dtype=np.int64)
    np.maximum.at(highest, b_id, n)
    sent = spark.sparkContext.broadcast((code[order], n[order], (n == highest[b_id])[order]))
    name = f"digests {a} {b} {uuid.uuid4().hex}"

    def run(batches):
        memory = _remembered(name, lambda: Memory(loaded(a, b), sent.value))
        for part in common.slices(batches):
            texts = part.column(1).to_pylist()
            flat, sizes = memory.look(texts)
            memory.hits = _grown(memory.hits, len(memory)) + np.bincount(flat, minlength=len(memory))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            sums = np.diff(np.concatenate([np.zeros((5, 1), dtype=np.int64), np.cumsum(memory.values[:5, flat], axis=1)], axis=1)[:, bounds], axis=1)
            written = list(map(memory.texts.__getitem__, flat.tolist()))
            ends = bounds.tolist()
            joined = ["".join(written[s:e])[:-1] for s, e in zip(ends, ends[1:])]
            sha = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in joined]
            n_a, n_b, groups, best, total = (pa.array(x) for x in sums)
            yield pa.RecordBatch.from_arrays([part.column(0), n_a, n_b, groups, groups, best, total, pa.array(sha, pa.string())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            if memory.full():
                memory.renew(memory.hits)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def groups(df: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, groups): the groups of every text, each with its ids of A and of B."""

    def make():
        t = loaded(a, b)

        def work(rows):
            out = []
            for text in rows["text"]:
                got = Aligned(t, [" " + text] if text else [], written=False)
                a_end, b_end = np.cumsum(got.group_a), np.cumsum(got.group_b)
                a_parts, b_parts = np.split(got.a, a_end[:-1]), np.split(got.b, b_end[:-1])
                out.append([{"a": x.tolist(), "b": y.tolist()} for x, y in zip(a_parts, b_parts)] if len(got.group_a) else [])
            return {"doc_id": rows["doc_id"], "groups": out}

        return work

    return common.map_texts(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], "doc_id long, groups array<struct<a:array<long>,b:array<long>>>", make)
