"""Profiles, ranks, distances and predictions against a plain version; many languages; cases of rows."""

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from roadglass.llm import language
from roadglass.llm.common import held_out

ROWS = "doc_id long, text string, lang string"


def plain_grams(text):
    """Frequencies of n-grams of one to three letters, with one space for each run of other characters."""
    clean = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            g = clean[i : i + n]
            if g.strip() and not (n == 3 and g[1] == " "):
                out[g] += 1
    return out


def plain_profile(texts, size):
    total = Counter()
    for t in texts:
        total.update(plain_grams(t))
    code = lambda g: sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def plain_predictions(rows, size):
    learned = {}
    for doc, text, lang in rows:
        if lang is not None and text is not None and (doc is None or zlib.crc32(str(doc).encode()) % 3 != 1):
            learned.setdefault(lang, []).append(text)
    profiles = {lang: plain_profile(texts, size) for lang, texts in learned.items()}
    profiles = {lang: p for lang, p in profiles.items() if p}
    out = []
    for doc, text, _ in rows:
        own = plain_profile([text or ""], size)
        if not own or not profiles:
            out.append((doc, "und", 0.0))
            continue
        best = min((sum(abs(p.index(g) - i) if g in p else size for i, g in enumerate(own)), lang) for lang, p in profiles.items())
        out.append((doc, best[1], 1 - best[0] / (size * len(own))))
    return out


def toy(rng):
    styles = {"en": ["the", "of", "and", "thing"], "de": ["der", "und", "ung", "schön"], "fr": ["été", "que", "les", "leçon"], "el": ["ΟΔΟΣ", "και", "το"]}
    rows = [(i, " ".join(rng.choice(styles[lang]) for _ in range(rng.randint(1, 12))) + rng.choice(("", ".", " 12 % x")), lang) for i in range(120) for lang in [rng.choice(list(styles))]]
    return rows + [(900, None, "en"), (901, "", "de"), (902, "123 --- 45", "fr"), (903, "the thing", None), (None, "que les", "fr"), rows[7], rows[7], (904, "x" * 300_000, "en"), (905, "ab ba", "zz")]


def test_against_a_plain_version(spark):
    rows = toy(random.Random(51))
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    for size in (400, 12):
        want = sorted((str(d), lang, round(s, 9)) for d, lang, s in plain_predictions(rows, size))
        for a_block in (1000, 2, 1):
            found = language.identify(df, language.fit_profiles(df, ~held_out(F.col("doc_id")), size=size, a_block=a_block), size=size).collect()
            assert sorted((str(r["doc_id"]), r["lang_pred"], round(r["score"], 9)) for r in found) == want
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)


def test_more_than_a_thousand_languages(spark):
    letters = lambda k: "".join(chr(0x4E00 + 3 * k + j) for j in (0, 1, 2)) + " " + chr(0x4E00 + 3 * k)
    rows = [(10_000 * j + k, letters(k), f"l{k:04d}") for k in range(1001) for j in range(1, 5)]
    df = spark.createDataFrame(rows, ROWS).repartition(8)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, language.fit_profiles(df, F.lit(True))).collect()}
    assert all(got[i] == lang for i, _, lang in rows) and len(set(got.values())) == 1001


def test_sample_is_bounded_and_repeats_itself(spark):
    rows = [(i, f"word{chr(97 + i % 26)} some", "en") for i in range(4000)]
    df = spark.createDataFrame(rows, ROWS)
    one, two = (list(language.fit_profiles(df.repartition(n), F.lit(True), rows_per_language=200)) for n in (2, 5))
    assert [p.tolist() for b in one for p in b.values()] == [p.tolist() for b in two for p in b.values()]


def test_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "the thing", "en", "q", 5, 1.5)] * 2, ROWS + ", lang_pred string, distance int, score double")
    got = language.identify(df, language.fit_profiles(df, F.lit(True))).collect()
    assert [tuple(r) for r in got] == [(1, got[0]["held_out"], "en", 1.0)] * 2
    assert language.identify(df.where("false"), language.fit_profiles(df, F.lit(True))).count() == 0
    assert {r["lang_pred"] for r in language.identify(df, language.fit_profiles(df.where("false"), F.lit(True))).collect()} == {"und"}
