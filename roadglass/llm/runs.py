"""Periodic runs of words, by the Kolpakov-Kucherov method.

A run is a longest stretch of consecutive words with a smallest period q that
repeats at least three times, here also of 24 words at least. The words of a
text are factorised: each factor is the longest stretch that also starts earlier,
or a new word. A suffix automaton of the words finds the factors and where each
occurred first. Main's algorithm then finds the runs that touch or cross a border
of two factors: for every period up to the longer one of the two factors, how far
words that lie a period apart agree to the right and to the left of the border.
With exponents of three or more, no run that touches a border is missed: of a run
[i, j] with period p, the words from i + p on occurred earlier, so at most one
border lies in i + p .. j. If one does, it cuts 2p words or more in two, and the
larger part, p or more, belongs to one of its factors; if none does, the factor
that holds them has 2p words or more and starts in the run, or ends with it, or
holds the run inside. The runs inside a factor are copied from the factor's
earlier occurrence.

Only stretches of a text that can hold a run are factorised: the words of a run
of length L are covered by sequences of 16 words that occur twice (the run
without its first period equals the run without its last one, and L - q is 16 or
more), so each run lies in one stretch of covered words. That is exact, and spares
texts without any such repetition.

Extensions compare slices, so the work is a small multiple of the words of the
covered stretches; the automaton takes some 60 bytes a word there. Texts need no
shuffle, each is a row of its own.

Results by case: a null text and one without words have no run, four nulls, and
the digests of the empty string; ties go to the smallest start, then period;
repeated rows give repeated results, an empty table none; texts of any length are
searched whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Least length of a run in words, and least number of its periods.
LENGTH, PERIODS = 24, 3
#: Words of the sequences that cover every run twice: LENGTH less a third of it.
COVER = LENGTH - LENGTH // PERIODS
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Automaton:
    """Suffix automaton of a sequence of small integers; a state's first way out lies in arrays, further ones in a dict."""

    def __init__(self, w: Sequence[int]):
        link, length, first, symbol, to, more = array("q", [-1]), array("q", [0]), array("q", [-1]), array("q", [-1]), array("q", [0]), {}
        self.first, self.symbol, self.to, self.more = first, symbol, to, more
        last = 0
        for x, c in enumerate(w):
            state = len(link)
            link.append(0)
            length.append(x + 1)
            first.append(x)
            symbol.append(-1)
            to.append(0)
            p = last
            last = state
            while p != -1:
                s = symbol[p]
                if s == -1:
                    symbol[p], to[p] = c, state
                elif s == c:
                    q = to[p]
                    break
                else:
                    ways = more.get(p)
                    if ways is None:
                        more[p] = {c: state}
                    elif c in ways:
                        q = ways[c]
                        break
                    else:
                        ways[c] = state
                p = link[p]
            else:
                continue
            if length[q] == length[p] + 1:
                link[state] = q
                continue
            clone = len(link)
            link.append(link[q])
            length.append(length[p] + 1)
            first.append(first[q])
            symbol.append(symbol[q])
            to.append(to[q])
            if q in more:
                more[clone] = dict(more[q])
            while p != -1:
                if symbol[p] == c:
                    if to[p] != q:
                        break
                    to[p] = clone
                elif p in more and more[p].get(c) == q:
                    more[p][c] = clone
                else:
                    break
                p = link[p]
            link[q] = link[state] = clone


def factors(w: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, end, start of an earlier occurrence or -1) of each factor; occurrences may overlap."""
    a = Automaton(w)
    first, symbol, to, more, n = a.first, a.symbol, a.to, a.more, len(w)
    out, b = [], 0
    while b < n:
        state, x, seen = 0, b, -1
        while x < n:
            c = w[x]
            following = to[state] if symbol[state] == c else more[state][c]
            if first[following] >= x:
                break
            state, seen, x = following, first[following], x + 1
        out.append((b, x, seen - (x - b) + 1) if x > b else (b, b + 1, -1))
        b = max(x, b + 1)
    return out


def _agree(w: list, a: int, b: int, end: int) -> int:
    """How many words from a and from b on agree, b + that at most end."""
    n, step, most = 0, 8, end - b
    while n < most:
        if w[a + n : a + min(most, n + step)] == w[b + n : b + min(most, n + step)]:
            n = min(most, n + step)
            step *= 2
        elif step > 8:
            step = 8
        else:
            while n < most and w[a + n] == w[b + n]:
                n += 1
            return n
    return most


def matches(w: list) -> list[int]:
    """At each position, how many words from there agree with the beginning."""
    n = len(w)
    z, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        if i < right and z[i - left] < right - i:
            z[i] = z[i - left]
            continue
        k = max(0, right - i)
        if i + k < n and w[k] == w[i + k]:
            k += _agree(w, k, i + k, n)
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _at_border(w: list, low: int, border: int, high: int, most: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of stretches of period 1 to ``most`` around a border that have PERIODS periods, seen in low..high."""
    out = []
    right, left = w[border:high], w[low:border][::-1]
    # the period lies to the right: w[border + i] == w[border + p + i], w[border - 1 - i] == w[border + p - 1 - i]
    forward = matches(right) if right else []
    backward = matches(left + [-1] + w[low : border + min(most, high - border)][::-1]) if left else []
    reach = min(most, high - border)
    for p in range(1, reach + 1):
        f = forward[p] if p < len(right) else 0
        b = min(backward[len(left) + 1 + reach - p], len(left)) if left else 0
        if f + b >= (PERIODS - 1) * p and f + b + p >= LENGTH:
            out.append((border - b, border + p + f, p))
    # the period lies to the left: w[border - p + i] == w[border + i], w[border - p - 1 - i] == w[border - 1 - i]
    reach = min(most, border - low)
    forward = matches(right + [-1] + w[border - reach : high]) if right else []
    backward = matches(left) if left else []
    for p in range(1, reach + 1):
        f = min(forward[len(right) + 1 + reach - p], len(right)) if right else 0
        b = backward[p] if p < len(left) else 0
        if f + b >= (PERIODS - 1) * p and f + b + p >= LENGTH:
            out.append((border - p - b, border + f, p))
    return out


def _whole(w: list, start: int, end: int, p: int) -> tuple[int, int]:
    """The stretch with this period that holds start..end, as far as it goes."""
    end += _agree(w, end - p, end, len(w))
    back = 0
    while start - back > 0 and w[start - back - 1] == w[start - back - 1 + p]:
        back += 1
    return start - back, end


def kolpakov_kucherov(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with three periods and LENGTH words or more, by start and period."""
    parts = factors(w)
    found: dict[tuple[int, int], int] = {}
    starts: list[tuple[int, int]] = []  # (start, end) of the runs so far, in order

    def add(start: int, end: int, p: int) -> None:
        if (start, end) not in found:
            starts.insert(bisect_left(starts, (start, end)), (start, end))
            found[start, end] = p
        elif p < found[start, end]:
            found[start, end] = p

    for k, (b, e, seen) in enumerate(parts):
        # runs inside the factor, off its ends, occurred before
        if seen >= 0 and e - b > LENGTH:
            shift = b - seen
            for start, end in starts[bisect_left(starts, (seen + 1, 0)) : bisect_left(starts, (seen + e - b, 0))]:
                if end < seen + e - b:
                    add(start + shift, end + shift, found[start, end])
        after = parts[k + 1][1] if k + 1 < len(parts) else e
        most = max(e - b, after - e)
        low = max(0, e - (e - b) - most)
        if after - low < LENGTH:
            continue
        for start, end, p in _at_border(w, low, e, after, min(most, (after - low) // 2 + 1)):
            if (start, end) not in found or p < found[start, end]:
                add(*_whole(w, start, end, p) if start == low or end == after else (start, end), p)
    return [(start, end - start, found[start, end]) for start, end in starts]


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def covered(w: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) of words covered by sequences of COVER words that occur twice; by hashes, so there may be more than that, never less."""
    n = len(w)
    if n < LENGTH:
        return []
    h = _spread(w.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for step in (1, 2, 4, 8):
        h = _spread(h[:-step] * np.uint64(0x100000001B3) + h[step:])
    order = np.argsort(h, kind="stable")
    twice = np.zeros(len(h), dtype=bool)
    same = h[order][1:] == h[order][:-1]
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return []
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + COVER, -1)
    inside = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return [(int(a), int(b)) for a, b in turns.reshape(-1, 2) if b - a >= LENGTH]


def find_runs(words: Sequence[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text, by start and period."""
    if len(words) < LENGTH:
        return []
    known: dict[str, int] = {}
    ids = [known.setdefault(x, len(known)) for x in words]
    out = []
    for a, b in covered(np.array(ids)):
        own: dict[int, int] = {}
        out += [(a + s, n, p) for s, n, p in kolpakov_kucherov([own.setdefault(x, len(own)) for x in ids[a:b]])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [x for x, k in zip(words, keep.tolist()) if k]


def folded(words: list[str], doc_id: int | None) -> list[str]:
    """The words of the digest query: every tenth document, by the hash of its id, repeats a stretch of its words to its end."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    stretch = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (stretch * -(-(n - a) // len(stretch)))[: n - a]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def run_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: bool = False) -> DataFrame:
    """One row for each text: how many runs, the one of greatest exponent, and digests of all runs and of the text without repetitions.

    ``fold`` first lets every tenth document repeat itself (``folded``).
    """

    def make():
        def work(rows):
            out = {c: [] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                words = common.WORD.findall(text or "")
                if fold:
                    words = folded(words, doc_id)
                runs = find_runs(words)
                # the greatest length / period, exactly: compared by cross-multiplication through integers
                best = None
                for r in runs:
                    if best is None or r[1] * best[2] > best[1] * r[2]:
                        best = r
                out["n_runs"].append(len(runs))
                for c, v in zip(("start", "length", "period"), best or (None,) * 3):
                    out[c].append(v)
                out["exponent_milli"].append(1000 * best[1] // best[2] if best else None)
                out["runs_sha256"].append(_sha256("".join("%d,%d,%d\n" % r for r in runs)))
                out["collapsed_sha256"].append(_sha256(" ".join(collapsed(words, runs))))
            return {"doc_id": rows["doc_id"]} | out

        return work

    return common.map_texts(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], SCHEMA, make)


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, runs array of (start, length, period)): the text without repetitions, its words joined by one space, and all runs."""

    def make():
        def work(rows):
            out = {"text": [], "runs": []}
            for text in rows["text"]:
                words = common.WORD.findall(text or "")
                found = find_runs(words)
                out["text"].append(" ".join(collapsed(words, found)))
                out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in found])
            return {"doc_id": rows["doc_id"]} | out

        return work

    return common.map_texts(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], "doc_id long, text string, runs array<struct<start:long,length:long,period:long>>", make)
