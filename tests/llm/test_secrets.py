"""Random spans and their limits against a plain version; the three base kinds are in test_documents."""

import math
import random
import re
import time
from collections import defaultdict

import pytest

from roadglass.llm import secrets

ROWS = "doc_id long, text string"


def plain_battery(run, alphabet):
    """Fisher's p of the three tests, from their definitions."""
    at = [alphabet.index(c) for c in run]
    n, k = len(at), len(alphabet)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = sum((at.count(i) - n / k) ** 2 / (n / k) for i in range(k))
    p = [tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))]
    high = [2 * i >= k for i in at]
    differ = 2 * (k // 2) * (k - k // 2) / k**2
    p.append(2 * tail(abs(sum(high[i] != high[i + 1] for i in range(n - 1)) - (n - 1) * differ) / (math.sqrt((n - 1) * differ * (1 - differ)) or 1)))
    mean = sum(at) / n
    whole = sum((x - mean) ** 2 for x in at)
    serial = sum((at[i] - mean) * (at[i + 1] - mean) for i in range(n - 1)) / whole if whole else 1.0
    p.append(2 * tail(abs(serial + 1 / n) * math.sqrt(n)))
    x = -sum(math.log(max(q, 1e-300)) for q in p)
    return math.exp(-x) * (1 + x + x * x / 2)


def kind(c):
    return next((k for k, cs in (("lower", secrets.LOWER), ("upper", secrets.UPPER), ("digit", secrets.DIGITS)) if c in cs), None)


def changed(a, b):
    return None not in (kind(a), kind(b)) and kind(a) != kind(b) and (kind(a), kind(b)) != ("upper", "lower")


def plain_text_chance(run, alphabet, letters, mix=(1 / 8, 0.1)):
    english = sum(secrets.LETTER_SHARES)
    share = {chr(97 + i): letters[i] + secrets.LETTERS * secrets.LETTER_SHARES[i] / english for i in range(26)}
    own = {c: share[c] for c in {x.lower() for x in alphabet if x.isalpha()}}
    q = [v / sum(own.values()) for v in own.values()]
    two, three, n = sum(x * x for x in q), sum(x**3 for x in q), len(run)
    equal = sum(run[i] == run[j] for i in range(n) for j in range(n) if i != j)
    spread = math.sqrt(4 * n * (n - 1) * (n - 2) * (three - two**2) + 2 * n * (n - 1) * two * (1 - two))
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    p = [tail((n * (n - 1) * two - equal) / spread)]
    kinds = {kind(c) for c in alphabet} - {None}
    if len(kinds) > 1:
        differ = sum(changed(a, b) for a, b in zip(run, run[1:]))
        p.append(tail((differ - 0.5 - (n - 1) * mix[0]) / math.sqrt((n - 1) * mix[0] * (1 - mix[0]))))
    if "digit" in kinds:
        p.append(tail((sum(kind(c) == "digit" for c in run) - 0.5 - n * mix[1]) / math.sqrt(n * mix[1] * (1 - mix[1]))))
    x = -sum(math.log(max(v, 1e-40)) for v in p)
    return max(math.exp(-x) * (1, 1 + x, 1 + x + x * x / 2)[len(p) - 1], 1e-40)


def level(p, most):
    return min(most - 1, int(-math.log10(max(p, 1e-300)) * 4))


def plain_limits(found, letters, mix, rate):
    """Limits of each class from (class, run) of all candidates, by sorting p-values."""
    each = defaultdict(list)
    for kind, run in found:
        alphabet = secrets.ENCODINGS[kind[0]]
        each[kind].append((level(plain_battery(run, alphabet), secrets.RANDOM_BINS), level(plain_text_chance(run, alphabet, letters, mix), secrets.BINS)))

    def control(bins):
        kept = None
        for i, b in enumerate(sorted(bins, reverse=True), 1):
            if 10 ** (-b / 4) * len(bins) / sum(x >= b for x in bins) <= rate:
                kept = b
        return kept

    out = {}
    for kind, pairs in each.items():
        rejected = control([a for a, _ in pairs])
        rejected = secrets.RANDOM_BINS if rejected is None else rejected
        passed = [b for a, b in pairs if a < rejected]
        if passed and (least := control(passed)) is not None:
            out[kind] = (rejected, least)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(31)
    words = "the of and thing der und ung schoen les leçon casa nube internationalisation verheitlichkeit".split()
    rows = []
    for i in range(300):
        text = [rng.choice(words) for _ in range(40)]
        for _ in range(rng.choice((0, 1, 2))):
            kind = rng.choice(("base62", "base64", "base64url", "lower", "BASE36", "base36", "hex"))
            text.insert(rng.randrange(40), "".join(rng.choice(secrets.ENCODINGS[kind]) for _ in range(rng.choice((20, 22, 28, 40, 64, 90)))))
        for _ in range(rng.choice((0, 1, 2))):
            text.insert(rng.randrange(40), "".join(w.capitalize() if i % 2 else w for w in rng.choices(words, k=rng.randint(4, 9))).replace("ç", "c"))
        rows.append((i, " ".join(text)))
    return rows + [(300, None), (301, ""), rows[0], (None, rows[1][1])]


def test_limits_against_a_plain_version(spark, corpus):
    limits = secrets.fit_limits(spark.createDataFrame(corpus, ROWS).repartition(5))
    texts = [t for _, t in corpus if t]
    outside = " ".join(re.sub(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", " ", t).lower() for t in texts)
    assert limits.letters == tuple(outside.count(chr(97 + i)) for i in range(26))
    outside = " ".join(re.sub(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", " ", t) for t in texts)
    words = re.findall("[A-Za-z0-9]+", outside)
    differ = sum(changed(a, b) for w in words for a, b in zip(w, w[1:]))
    named = [w for w in words if not w.isdigit()]
    rates = differ / sum(len(w) - 1 for w in words), sum(map(str.isdigit, "".join(named))) / len("".join(named))
    assert limits.mix == pytest.approx((max(1 / 8, rates[0]), max(0.1, rates[1])))
    found = []
    for t in texts:
        base = secrets.base_spans(t)
        for x in secrets.candidates(t):
            assert not any(a < x.end and x.start < b for a, _, b in base)
            found.append((x.kind, t[x.start : x.end]))
    want = plain_limits(found, limits.letters, limits.mix, 0.01)
    assert limits.classes == want and len(want) >= 5


def test_spans_against_a_plain_version(spark, corpus):
    df = spark.createDataFrame(corpus, ROWS).repartition(5)
    limits = secrets.fit_limits(df)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["spans"], r["n_random"]) for r in secrets.scan(df, limits).collect())
    want, keys = [], 0
    for doc, text in corpus:
        base, chosen = secrets.base_spans(text or ""), []
        for x in secrets.candidates(text or ""):
            run, alphabet = text[x.start : x.end], secrets.ENCODINGS[x.kind[0]]
            bounds = limits.classes.get(x.kind)
            if bounds and level(plain_battery(run, alphabet), secrets.RANDOM_BINS) < bounds[0] and (b := level(plain_text_chance(run, alphabet, limits.letters, limits.mix), secrets.BINS)) >= bounds[1]:
                chosen.append((-b, x.start - x.end, x.start, x.end))
        kept = []
        for _, _, a, b in sorted(chosen):
            if all(b <= c or d <= a for c, d in kept):
                kept.append((a, b))
        spans = sorted([(a, k, b) for a, k, b in base] + [(a, 3, b) for a, b in kept])
        want.append((doc if doc is not None else -1, ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans), len(kept)))
        keys += len(kept)
    assert got == sorted(want) and keys > 100


NAMES = [
    "internationalisationFactoryBeanBuilder", "getElementsByTagNameFromDocument", "ThisIsAVeryLongClassNameIndeed", "MAXIMUM_NUMBER_OF_CONNECTIONS", "some_table_name_with_column_names", "https-documentation-installation-overview",
    "donaudampfschifffahrtsgesellschaft", "release-notes-for-version-2024-11-28", "chapter12section34paragraph56", "BackgroundTaskSchedulerService", "uncharacteristically-long-hyphenated-name", "AbstractSingletonProxyFactoryBean",
]


@pytest.mark.parametrize("encoding, length, least", [("base62", 20, 0.75), ("base62", 24, 0.9), ("base62", 32, 0.97), ("base64url", 24, 0.75), ("base36", 24, 0.8), ("base36", 32, 0.95), ("hex", 20, 0.9), ("HEX", 32, 0.95)])
def test_how_many_keys_are_found_by_length(spark, encoding, length, least):
    """Keys in prose with long names of programs: so many are found, and no name or word is."""
    rng = random.Random(length)
    words = "the of and thing der und ung schoen les casa nube with from that which report number".split()
    rows, keys = [], {}
    for i in range(300):
        text = rng.choices(words, k=40)
        text.insert(rng.randrange(40), rng.choice(NAMES))
        if i % 3 == 0:
            keys[i] = "".join(rng.choice(secrets.ENCODINGS[encoding]) for _ in range(length))
            text.insert(rng.randrange(40), keys[i])
        rows.append((i, " ".join(text)))
    red = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(rows, ROWS)).collect()}
    gone = [i for i, k in keys.items() if k not in red[i]]
    assert len(gone) >= least * len(keys), len(gone) / len(keys)
    for i, text in rows:
        assert red[i] == text or (i in keys and red[i].split("[")[0] in text and all(w in red[i] or w == keys[i] for w in text.split()))


@pytest.mark.parametrize("form", ["AWS_KEY={} end", "export SESSION={}", "id={}&x=1", "/a/{}/b", "AWS-{}/x_x", "GET /api/v1/{}?q", "key: {}", "token-{}-prod"])
def test_a_key_in_its_surroundings(spark, form):
    rng = random.Random(5)
    keys = ["".join(rng.choice(secrets.ENCODINGS["base62"]) for _ in range(40)) for _ in range(40)]
    rows = [(i, form.format(k)) for i, k in enumerate(keys)]
    red = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(rows, ROWS)).collect()}
    found = [red[i] for i in range(40) if keys[i] not in red[i]]
    assert len(found) >= 37 and set(found) <= {form.format("[random]"), form.format("[random]").replace("token-[random]-prod", "token-[random]-prod")}


def test_many_spans_in_one_text():
    text = " ".join(f"password=abcdef{i} Zk3vQ9xLr7TbN2mWc8Yh{i}pD" for i in range(16_000))
    began = time.time()
    base, every = secrets.all_spans(text, secrets.Limits((0,) * 26, {}))
    assert len(base) == 16_000 == len(every) and time.time() - began < 2


def test_very_long_runs_and_signs_in_linear_time():
    began = time.time()
    for text in ("a/" * 100_000, "-" * 200_000, "Aa1/" * 60_000, "ab1-" * 500_000, "Zk3v" * 200_000):
        secrets.candidates(text)
    assert time.time() - began < 5


def test_clashing_names_and_empty_tables(spark):
    rows = [(1, "password=secret12", "x", 3)] * 2 + [(2, None, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_hex int")
    got = secrets.scan(df).collect()
    assert [r["spans"] for r in got if r["doc_id"] == 1] == ["assign:0:17"] * 2 and all(r["n_hex"] == 0 for r in got)
    assert {(r["text"], r["spans"], r["n_hex"]) for r in secrets.redact(df).collect()} == {("[assign]", "x", 3), (None, None, 3)}
    assert secrets.scan(df.where("false")).count() == 0 == secrets.redact(df.where("false")).count()
