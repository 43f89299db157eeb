"""Quality rules, on DataFrame functions alone.

Base counts look at one text: words, symbols, repeated lines, and words in
repeated windows of eight. The verdict looks across documents: lines are
normalised (lower case, digits as one 0, single spaces) and hashed with their
host; a line that more than ``limit`` different texts of a host have is removed,
and a document of which more than half the words go is rejected as depleted.
The verdicts count what goes; filter_documents returns the texts without it.
Exact copies of a text count once, so that copies alone deplete nothing. The
limit goes by the host: a twentieth of its different texts, but 5 at least and 30
at most; or it is a number for all hosts.

Windows are compared by 64-bit hashes built from hashes of two, then four words,
inside the row: nothing is exploded but lines. The removed lines join with a
salt of 16; a removed line gets a copy for each salt that its rows have, so
there are no more copies than rows they meet, whatever the limit.

Results by case: a null text is empty, has no words and fails the base rules; a
null host is a host of its own; rows that repeat an id, host and text get the
result of one; an empty table gives none; texts of any length are read whole;
``extra`` columns of any name are carried along but for names of results, which
are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import JAVA_SPACE, JAVA_WORD, SPACE_CHARS, words_of

RESULTS = frozenset(("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept", "removed"))
WINDOW = 8
SALTS = 16
#: The limit of a host: its different texts over SHARE, within these bounds.
SHARE, LEAST, MOST = 20, 5, 30


def base_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with words, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    out = df.withColumn("_words", words_of(F.col(text_col))).withColumn("_lines", full)
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_two": F.transform("_words", lambda x, i: F.xxhash64(x, F.get("_words", i + 1))),
        }
    ).drop("_words", "_lines")
    out = out.withColumn("_four", F.transform("_two", lambda x, i: F.xxhash64(x, F.get("_two", i + 2)))).drop("_two")
    out = out.withColumn("_eight", F.slice(F.transform("_four", lambda x, i: F.xxhash64(x, F.get("_four", i + 4))), 1, F.greatest(F.lit(0), F.col("n_words").cast("int") - (WINDOW - 1)))).drop("_four")
    repeats = F.size(F.array_distinct("_eight")) < F.size("_eight")
    out = out.withColumn("_at", F.when(repeats, F.sort_array(F.transform("_eight", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_eight")
    twice = F.filter("_at", lambda x, i: (x["h"] == F.get("_at", i - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get("_at", i + 1)["h"]).eqNullSafe(True))
    out = out.withColumn("_twice", F.when(F.col("_at").isNotNull(), F.sort_array(F.transform(twice, lambda x: x["i"])))).drop("_at")
    # each window adds the words that the one before it doesn't cover
    covered = F.aggregate(
        "_twice",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_twice")


def host_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row for each line with a word: (id, row, text_hash, host, line, pos, n); host and line are hashes."""
    lines = df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.col(host_col).alias("host"),
        F.xxhash64(host_col, text_col).alias("row"),
        F.xxhash64(text_col).alias("text_hash"),
        F.posexplode(F.split(text_col, "\n")).alias("pos", "raw"),
    )
    bare = F.btrim("raw", F.lit(SPACE_CHARS))
    norm = F.regexp_replace(F.regexp_replace(F.lower(bare), JAVA_SPACE, " "), "[0-9]+", "0")
    return lines.where(bare != "").select("id", "row", "text_hash", F.xxhash64("host").alias("host"), "pos", F.xxhash64("host", norm).alias("line"), F.regexp_count(bare, F.lit(JAVA_WORD)).alias("n"))


def removed_lines(df: DataFrame, limit: int | None = None, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, row, n_removed, removed) of the rows that have lines above the limit; ``removed`` are positions of lines."""
    lines = host_lines(df, id_col, text_col, host_col)
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    texts, salts = F.countDistinct("text_hash").alias("texts"), F.bit_or(F.call_function("shiftleft", F.lit(1), salt)).alias("salts")
    if limit is not None:
        common = lines.groupBy("line").agg(texts, salts).where(F.col("texts") > limit)
    else:
        common = lines.groupBy("line").agg(texts, salts, F.min("host").alias("host")).where(F.col("texts") > LEAST)
        hosts = df.where(F.col(text_col).isNotNull()).select(F.xxhash64(host_col).alias("host"), F.xxhash64(text_col).alias("text_hash"))
        hosts = hosts.groupBy("host").agg(F.countDistinct("text_hash").alias("all"))
        most = F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.floor(F.col("all") / SHARE)))
        # lines above the highest limit are removed whatever their host, so a large host's don't meet in one task
        own = F.when(F.col("texts") > MOST, F.xxhash64("line")).otherwise(F.col("host"))
        common = common.withColumn("host", own).join(hosts, "host", "left").where((F.col("texts") > MOST) | (F.col("texts") > most))
    used = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.get(F.lit([1 << k for k in range(SALTS)]), i).bitwiseAND(F.col("salts")) != 0)
    common = common.select("line", F.explode(used).alias("salt"))
    salted = lines.select("line", salt.alias("salt"), "id", "row", "pos", "n")
    hit = salted.join(common, ["line", "salt"])
    copies = F.count(F.lit(1)) / F.size(F.collect_set("pos"))
    return hit.groupBy("id", "row").agg((F.sum("n") / copies).cast("long").alias("n_removed"), F.collect_set("pos").alias("removed"))


def removed_words(df: DataFrame, limit: int = 30, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, row, n_removed) of the rows that have lines above the limit, which must be SALTS or more here; removed_lines takes any."""
    if limit < SALTS:
        raise ValueError(f"limit must be {SALTS} or more")
    return removed_lines(df, limit, id_col, text_col, host_col).drop("removed")


def verdicts(df: DataFrame, limit: int | None = None, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", extra: list[str] | None = None) -> DataFrame:
    """Base counts, base_failed, n_removed and kept of every row; ``extra`` columns are carried along."""
    return judged(df, limit, id_col, text_col, host_col, extra).drop("removed")


def judged(df: DataFrame, limit: int | None = None, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", extra: list[str] | None = None) -> DataFrame:
    """The verdicts, and the positions of the removed lines; null where none is."""
    extra = extra or []
    if clash := RESULTS.intersection(extra):
        raise ValueError(f"extra columns with names of results: {sorted(clash)}")
    carried = [F.col(f"`{c}`").alias(f"_extra{i}") for i, c in enumerate(extra)]
    counted = base_counts(df.select(F.col(id_col).alias("doc_id"), *carried, F.xxhash64(host_col, text_col).alias("_row"), F.col(text_col).alias("_text")), "_text")
    counted = counted.drop("_text")
    gone = removed_lines(df, limit, id_col, text_col, host_col)
    out = counted.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row")), "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    removed = F.coalesce(F.col("n_removed"), F.lit(0).cast("long"))
    # one predicate over both sides of the join: a filter on it stays above the join, where the counts
    # are columns; below, each use of a count would compute its arrays again
    kept = F.greatest(failed.cast("int"), (2 * removed > F.col("n_words")).cast("int")) == 0
    return out.select(
        "doc_id", *[F.col(f"_extra{i}").alias(c) for i, c in enumerate(extra)], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), removed.alias("n_removed"), kept.alias("kept"), "removed",
    )


def filter_documents(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The rows of documents that are kept, with the columns of documents; texts are without their removed lines."""
    ok = judged(df, limit, extra=["text", "lang", "source", "n_chars"]).where("kept")
    some = F.col("removed").isNotNull()
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    ok = ok.withColumn("text", F.when(some, left).otherwise(F.col("text")))
    return ok.select("doc_id", "text", "lang", "source", F.when(some, F.char_length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(8)) AS k) GROUP BY rid),
l AS (SELECT rid, source, text, unnest(ls) AS raw FROM w),
n AS (SELECT rid, source, text, len(list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
             regexp_replace(regexp_replace(lower(trim(raw, chr(32) || chr(9) || chr(11) || chr(12) || chr(13))), '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g') AS line FROM l),
h AS (SELECT source, least(30, greatest(5, count(DISTINCT text) // 20)) AS most FROM d WHERE text IS NOT NULL GROUP BY source),
c AS (SELECT n.source, line FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source GROUP BY n.source, line, most HAVING count(DISTINCT text) > most),
gone AS (SELECT rid, sum(words) AS n FROM n JOIN c ON n.line = c.line AND n.source IS NOT DISTINCT FROM c.source GROUP BY rid),
b AS (SELECT doc_id, rid, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines FROM w)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
       (n_words < 20 OR 100 * coalesce(rep.n, 0) > 30 * n_words) AS base_failed, coalesce(gone.n, 0)::BIGINT AS n_removed,
       (NOT (n_words < 20 OR 100 * coalesce(rep.n, 0) > 30 * n_words) AND 2 * coalesce(gone.n, 0) <= n_words) AS kept
FROM b LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)
"""
