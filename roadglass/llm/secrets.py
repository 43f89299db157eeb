"""Secret scanning: three exact patterns, and a battery of randomness tests for what they miss.

A candidate is a maximal run of 20 or more characters of the usual encodings;
"=" ends a run, as padding or after a name. Where a run holds "+", "/", "-" or
"_", words at its ends that "/", "-" or "_" set apart (of paths and prefixes: a
word or number no longer than 19) are cut off, and its parts between all these
signs, and between those of either base64, are candidates too; of those that are
found random and overlap one is kept (below).
The smallest encoding that has all characters is inferred; runs of digits alone
are numbers and never candidates. Three tests of "each symbol is drawn evenly
and independently" run over the symbol numbers: chi-squared uniformity over the
alphabet, runs above and below its middle, and serial correlation at lag one.
Fisher's method combines their p-values.

False discoveries are controlled twice, by Benjamini-Hochberg within each class
of encoding and length, over all candidates of the corpus:

- the battery's combined p-values: where they are small enough for the class,
  the candidate is not random (a word, counter or repeat). Of those rejected so
  at most ``rate`` are random strings in truth.
- passing says little for a short string, so what passes is also held against
  ordinary text: the chance that text of this length, over the same alphabet,
  repeats its symbols as rarely (the chi-squared statistic), changes between
  lower case, upper case and digits as often (the runs), and has as many digits;
  Fisher's method combines those of the three that the alphabet has. Of those
  reported at most ``rate`` are such text. Letters have their shares in the
  corpus outside of runs (blended with LETTERS letters of English); changes and
  digits have the corpus's rates in words, but at least those of names written in
  camel case and of names with a digit in ten characters.

One pass counts the letters, the next a histogram of fixed size, from which the
driver takes two limits for each class.

Results by case: a null or empty text has no spans; repeated rows give repeated
results and each of them counts; an empty table gives none; a text of any length
is scanned whole, in linear time; of overlapping candidates the one with the
lowest text chance is kept, of equals the longer, then the first; other columns,
whatever their names, are not read (``redact`` carries them along).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Order of kinds where spans start together; the last is what the tests add.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs of 24 or more are the long ones of all maximal runs
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
SIGN = re.compile(r"[+/_-]")
#: What stands at the ends of a run as a word of its own: names of paths, prefixes of keys.
PLAIN = r"(?:[a-z]{1,19}|[A-Z]{2,19}|[A-Z][a-z]{1,18}|[a-z]{1,3}[0-9]{1,2}|[0-9]{1,4})"
PLAIN_START, PLAIN_END = re.compile(rf"[/_-]?(?:{PLAIN}[/_-])+"), re.compile(rf"(?:[/_-]{PLAIN})+[/_-]?\Z")

#: Parts of a run: without the signs of base64, without those of base64url, and without any.
PARTS = (re.compile(r"[A-Za-z0-9_-]{20,}"), re.compile(r"[A-Za-z0-9+/]{20,}"), re.compile(r"[A-Za-z0-9]{20,}"))

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from small to large alphabets; decimal runs are numbers, not secrets.
ENCODINGS = {
    "decimal": DIGITS,
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
#: Per cent of each letter in English prose, a to z.
LETTER_SHARES = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Least rates of ordinary text: changes of the kind of character from one to the next, as in camel case with words of eight letters, and digits.
CHANGES, DIGIT_SHARE = 1 / 8, 0.1
#: Letters of English that the corpus's own are blended with.
LETTERS = 20_000
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 48, 80)
#: Histogram bins a power of ten, and bins in all, of the battery's p-value and of the text chance.
BINS_A_DECADE, RANDOM_BINS, BINS = 4, 49, 161


class Limits(NamedTuple):
    """What a corpus tells: letter counts a to z, and for each class (encoding, length class) the bins from which on a candidate is not random, and is not text."""

    letters: tuple[int, ...]
    classes: dict[tuple[str, int], tuple[int, int]]
    mix: tuple[float, float] = (CHANGES, DIGIT_SHARE)  # rates of changes and of digits in words


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _bin(p: float, bins: int) -> int:
    return min(bins - 1, int(-math.log10(max(p, 1e-300)) * BINS_A_DECADE))


def infer(run: str) -> str | None:
    found = set(run)
    return next((name for name, alphabet in _SETS.items() if found <= alphabet), None)


#: Kind of each character: a, A or 0.
_KIND = {c: k for k, cs in (("a", LOWER), ("A", UPPER), ("0", DIGITS)) for c in cs}
_KINDS = {**{i: " " for i in range(128)}, **{ord(c): k for c, k in _KIND.items()}}
_SETS = {k: frozenset(v) for k, v in ENCODINGS.items()}
_PLACES = {k: {c: i for i, c in enumerate(v)} for k, v in ENCODINGS.items()}


def random_chance(run: str, encoding: str) -> float:
    """Fisher's combination of the three tests; small: not random."""
    place = _PLACES[encoding]
    symbols = [place[c] for c in run]
    n, size = len(symbols), len(place)
    chi = size / n * sum(c * c for c in Counter(symbols).values()) - n
    p_chi = _tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = [2 * s >= size for s in symbols]
    share = (size // 2) / size
    changes = sum(a != b for a, b in zip(high, high[1:]))
    each = 2 * share * (1 - share)
    spread = math.sqrt((n - 1) * each * (1 - each)) or 1
    p_runs = 2 * _tail(abs(changes - (n - 1) * each) / spread)
    mean = sum(symbols) / n
    total = sum((s - mean) ** 2 for s in symbols)
    serial = sum((a - mean) * (b - mean) for a, b in zip(symbols, symbols[1:])) / total if total else 1.0
    p_serial = 2 * _tail(abs(serial + 1 / n) * math.sqrt(n))
    x = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-x) * (1 + x + x * x / 2)  # chi-squared with six degrees of freedom, at 2x


def _text_moments(encoding: str, letters: tuple[int, ...]) -> tuple[float, float]:
    """Chances that two, and three, symbols of ordinary text over this alphabet are equal."""
    english = sum(LETTER_SHARES)
    shares = [n + LETTERS * x / english for n, x in zip(letters, LETTER_SHARES)]
    weights = [shares[ord(c) - 97] for c in dict.fromkeys(x.lower() for x in ENCODINGS[encoding]) if c.isalpha()]
    total = sum(weights)
    return sum((w / total) ** 2 for w in weights), sum((w / total) ** 3 for w in weights)


def moments(letters: tuple[int, ...] = (0,) * 26, mix: tuple[float, float] = (CHANGES, DIGIT_SHARE)) -> dict[str, tuple[float, ...]]:
    """By encoding the chances of two and three equal symbols, and the rates of changes and digits; None where the alphabet has neither."""
    out = {}
    for k, alphabet in ENCODINGS.items():
        if k != "decimal":
            kinds = {_KIND[c] for c in alphabet if c in _KIND}
            out[k] = (*_text_moments(k, letters), mix[0] if len(kinds) > 1 else None, mix[1] if "0" in kinds else None)
    return out




ENGLISH = moments()


def _above(found: int, n: int, rate: float) -> float:
    """Chance of as many hits in n tries at this rate."""
    return _tail((found - 0.5 - n * rate) / math.sqrt(n * rate * (1 - rate))) if n else 1.0


def changes_of(kinds: str) -> int:
    """How often the kind changes from one character to the next; a small letter behind a capital is no change, as words begin so."""
    return sum(map(kinds.count, ("aA", "a0", "A0", "0a", "0A")))


def text_chance(run: str, encoding: str, of: dict[str, tuple[float, ...]] = ENGLISH) -> float:
    """Chance that ordinary text of this length repeats its symbols as rarely, changes its kind as often and has as many digits, by Fisher's method."""
    n = len(run)
    two, three, change, digit = of[encoding]
    pairs = sum(c * (c - 1) for c in Counter(run).values())
    mean = n * (n - 1) * two
    spread = math.sqrt(max(4 * n * (n - 1) * (n - 2) * (three - two * two), 0.0) + 2 * n * (n - 1) * two * (1 - two))
    chances = [_tail((mean - pairs) / spread)]
    kinds = run.translate(_KINDS)
    if change is not None:
        chances.append(_above(changes_of(kinds), n - 1, change))
    if digit is not None:
        chances.append(_above(kinds.count("0"), n, digit))
    x = -sum(math.log(max(p, 1e-40)) for p in chances)
    return max(math.exp(-x) * sum(x**k / math.factorial(k) for k in range(len(chances))), 1e-40)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, sorted."""
    out = []
    low = text.lower()
    if any(m in low for m in ASSIGN_MARKS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


class Candidate(NamedTuple):
    start: int
    end: int
    kind: tuple[str, int]  # class: encoding and length class
    random: int  # bins of the battery's p-value and of the text chance
    text: int


def candidates(text: str, base: list[tuple[int, int, int]] | None = None, of: dict[str, tuple[float, ...]] = ENGLISH) -> list[Candidate]:
    """Runs and their parts outside the base spans, by start; parts overlap the runs they are of."""
    out: list[Candidate] = []
    starts: list[int] = []
    ends: list[int] = []
    for m in RUN.finditer(text):
        if base is None:
            base = base_spans(text)
        if base and not starts:
            starts, ends = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
        spans = {m.span()}
        if SIGN.search(m[0]):
            first, last = m.span()
            if plain := PLAIN_START.match(text, first, last):
                first = plain.end()
            if plain := PLAIN_END.search(text, first, last):
                last = plain.start()
            spans = {(first, last)} if last - first >= LENGTHS[0] else set()
            spans.update(p.span() for pattern in PARTS for p in pattern.finditer(text, first, last))
        for start, end in sorted(spans):
            run = text[start:end]
            encoding = infer(run)
            if encoding in (None, "decimal") or (k := bisect_left(starts, end)) and ends[k - 1] > start:
                continue
            length = sum(len(run) >= x for x in LENGTHS) - 1
            out.append(Candidate(start, end, (encoding, length), _bin(random_chance(run, encoding), RANDOM_BINS), _bin(text_chance(run, encoding, of), BINS)))
    return out


def letter_counts(df: DataFrame, text_col: str = "text") -> tuple[tuple[int, ...], tuple[float, float]]:
    """How often each letter a to z occurs in the corpus, in either case, outside of runs; and the rates of changes and digits in its words.

    Words are of letters and digits of ASCII, and digits count where a word has letters too.
    """
    names = [*(f"c{i}" for i in range(26)), "pairs", "changes", "characters", "digits"]

    def make():
        def work(rows):
            texts = "\n".join(RUN.sub(" ", t) for t in rows[text_col] if t)
            low, kinds = texts.lower(), texts.encode("ascii", "replace").decode().translate(_KINDS)
            mixed = [w for w in _WITH_DIGIT.findall(kinds) if "a" in w or "A" in w]
            characters = sum(map(kinds.count, "aA")) + sum(w.count("0") for w in mixed)
            starts = len(_STARTS.findall(kinds))
            made = [*(low.count(chr(97 + i)) for i in range(26)), sum(map(kinds.count, "aA0")) - starts, changes_of(kinds), characters, sum(w.count("0") for w in mixed)]
            return {c: [n] for c, n in zip(names, made)}

        return work

    found = common.map_texts(df, [text_col], ", ".join(f"{c} long" for c in names), make).agg(*[F.sum(c).alias(c) for c in names]).first()
    n = [int(x or 0) for x in found]
    return tuple(n[:26]), (min(0.9, max(CHANGES, n[27] / max(1, n[26]))), min(0.9, max(DIGIT_SHARE, n[29] / max(1, n[28]))))


#: In a text of kinds: words with a digit, and starts of words.
_WITH_DIGIT, _STARTS = re.compile("[aA]*0[aA0]*"), re.compile("(?<![aA0])[aA0]")


def controlled(counts: Counter, rate: float) -> int | None:
    """Benjamini-Hochberg over a histogram of p-values: the smallest bin whose members and all beyond count as discoveries."""
    total, beyond, found = sum(counts.values()), 0, None
    for b in sorted(counts, reverse=True):
        beyond += counts[b]
        if 10 ** (-b / BINS_A_DECADE) * total / beyond <= rate:
            found = b
    return found


def fit_limits(df: DataFrame, text_col: str = "text", rate: float = 0.01) -> Limits:
    """Letters and limits over all rows. At most len(ENCODINGS) x len(LENGTHS) x RANDOM_BINS x BINS counts reach the driver."""
    letters, mix = letter_counts(df, text_col)
    of = moments(letters, mix)

    def make():
        def work(rows):
            count = Counter((*x.kind, x.random, x.text) for text in rows[text_col] if text for x in candidates(text, None, of))
            return {c: [k[i] for k in count] for i, c in enumerate(("encoding", "length", "random", "text"))} | {"n": list(count.values())}

        return work

    found = common.map_texts(df, [text_col], "encoding string, length int, random int, text int, n long", make)
    by_class: dict[tuple[str, int], Counter] = {}
    for r in found.groupBy("encoding", "length", "random", "text").agg(F.sum("n").alias("n")).collect():
        by_class.setdefault((r["encoding"], r["length"]), Counter())[r["random"], r["text"]] += r["n"]
    limits = {}
    for kind, counts in by_class.items():
        battery: Counter = Counter()
        for (random, _), n in counts.items():
            battery[random] += n
        not_random = controlled(battery, rate)
        not_random = RANDOM_BINS if not_random is None else not_random
        passed: Counter = Counter()
        for (random, level), n in counts.items():
            if random < not_random:
                passed[level] += n
        if (not_text := controlled(passed, rate)) is not None:
            limits[kind] = (not_random, not_text)
    return Limits(letters, limits, mix)


def all_spans(text: str, limits: Limits, of: dict[str, tuple[float, ...]] | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans, as (start, kind number, end)."""
    base = base_spans(text)
    found = []
    for x in candidates(text, base, moments(limits.letters, limits.mix) if of is None else of):
        not_random, not_text = limits.classes.get(x.kind, (0, 0))
        if x.random < not_random and x.text >= not_text:
            found.append(x)
    more: list[tuple[int, int, int]] = []
    for x in sorted(found, key=lambda x: (-x.text, x.start - x.end, x.start)) if len(found) > 1 else found:
        k = bisect_left(more, (x.start, 0, 0))
        if (k == 0 or more[k - 1][2] <= x.start) and (k == len(more) or x.end <= more[k][0]):
            more.insert(k, (x.start, 3, x.end))
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(df: DataFrame, limits: Limits | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of every row."""
    if limits is None:
        limits = fit_limits(df, text_col)

    def make():
        of = moments(limits.letters, limits.mix)

        def work(rows):
            out = {c: [] for c in ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")}
            for text in rows[text_col]:
                base, every = all_spans(text or "", limits, of)
                kinds = Counter(k for _, k, _ in every)
                for k, c in enumerate(("n_assign", "n_access", "n_hex", "n_random")):
                    out[c].append(kinds[k])
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(every))
            return {"doc_id": rows[id_col]} | out

        return work

    return common.map_texts(df, [id_col, text_col], "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string", make)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch covered by spans replaced by a mark of its first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, limits: Limits | None = None, text_col: str = "text") -> DataFrame:
    """The same columns and rows, with secrets masked in the text; a null text stays null."""
    if limits is None:
        limits = fit_limits(df, text_col)

    def make():
        of = moments(limits.letters, limits.mix)

        def work(rows):
            return rows | {text_col: [masked(t, all_spans(t, limits, of)[1]) if t else t for t in rows[text_col]]}

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return common.map_texts(df, df.columns, schema, make)
