"""Relational operators: lookups, rollups and order over linked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: the last by order. An aggregate, so partial results shrink before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, "_r.*")


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, "_r.*")


def required_join(left: DataFrame, right: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """Inner join where every left row must find a right row; a row without one stops the query with an error."""
    found = left.join(right.withColumn("_found", F.lit(True)), list(on), "left")
    missing = F.raise_error(F.concat(F.lit(f"{what} without a row for "), F.to_json(F.struct(*on))))
    return found.where(F.coalesce(F.col("_found"), missing.cast("boolean"))).drop("_found")


def grouped(rows: DataFrame, key: Sequence[str], order: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One row a key with its rows as an ordered array of structs."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("_v"))))
    return rows.groupBy(*key).agg(F.transform(listed, lambda x: x["_v"]).alias(name))


def sorted_set(value: str) -> Column:
    """Aggregate: distinct values in order, without nulls and empty strings."""
    return F.array_sort(F.collect_set(F.when(F.col(value) != "", F.col(value))))


def names_of(rows: DataFrame, tokens: str, names: DataFrame, token: str, name: str, key: Sequence[str]) -> DataFrame:
    """(key, names) with the known tokens of an array as names in its order; unknown ones are dropped."""
    each = rows.select(*key, F.posexplode_outer(tokens).alias("_at", token)).join(names, token, "left")
    listed = F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct("_at", F.col(name).alias("_v")))))
    return each.groupBy(*key).agg(F.transform(listed, lambda x: x["_v"]).alias("names"))


def with_any(rows: DataFrame, lists: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Rows whose arrays hold any wanted value between them."""
    union = F.array(*[]).cast("array<string>")
    for c in lists:
        union = F.array_union(union, F.coalesce(F.col(c), F.array().cast("array<string>")))
    return rows.where(F.arrays_overlap(union, F.array(*[F.lit(w) for w in wanted])))


def longest_prefix(rows: DataFrame, text: str, prefixes: DataFrame, prefix: str, separator: str = "_", key: Sequence[str] = ()) -> DataFrame:
    """Each row with the longest prefix that it continues after the separator; rows without one are dropped.

    A text has as many prefixes as separators, so both sides meet in an equi-join.
    """
    parts = F.split(text, F.lit(separator), -1)
    starts = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))
    each = rows.where(F.size(parts) > 1).withColumn(prefix, F.explode(starts)).join(prefixes, [*key, prefix])
    fields = [c for c in each.columns if c not in rows.columns or c == prefix]
    best = each.groupBy(*rows.columns).agg(F.max_by(F.struct(*fields), F.length(prefix)).alias("_b"))
    return best.select(*rows.columns, "_b.*")


def first_of(key: Sequence[str], base: DataFrame, value: str, *lookups: DataFrame) -> DataFrame:
    """Base rows with the value of the first lookup that has one."""
    out, names = base, []
    for i, lookup in enumerate(lookups):
        names.append(f"_v{i}")
        out = out.join(lookup.select(*key, F.col(value).alias(names[-1])), list(key), "left")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)


def replace_payload(rows: DataFrame, templates: DataFrame, key: Sequence[str], payload: str) -> DataFrame:
    """Rows with the template's payload where there is one, and a ``replaced`` flag."""
    found = rows.join(templates.select(*key, F.col(payload).alias("_new")), list(key), "left")
    return found.withColumns({"replaced": F.col("_new").isNotNull(), payload: F.coalesce("_new", payload)}).drop("_new")


def chain(rows: DataFrame, group: Sequence[str], token: str, following: str) -> DataFrame:
    """Adds ``position``, from 0, along the links of each group, by pointer doubling.

    A chain that branches, breaks or cycles leaves rows that its start doesn't
    reach; a group with any gets null positions, and callers fall back to another
    order. As many joins as the largest group's size has binary digits; fewer if
    no pointer is left before. Needs a checkpoint folder.
    """
    rounds = int(rows.groupBy(*group).count().agg(F.max("count")).first()[0] or 0).bit_length() + 1
    links = rows.select(*group, F.col(token).alias("_t"), F.col(following).alias("_next"))
    back = links.where(F.col("_next").isNotNull() & (F.col("_next") != "")).select(*group, F.col("_next").alias("_t"), F.col("_t").alias("_prev"))
    back = back.groupBy(*group, "_t").agg(F.min("_prev").alias("_up"), F.count(F.lit(1)).alias("_ways"))
    state = links.select(*group, "_t").join(back, [*group, "_t"], "left").select(*group, "_t", "_up", F.when(F.col("_up").isNull(), 0).otherwise(1).cast("long").alias("_d"), F.coalesce("_ways", F.lit(1)).alias("_ways"))
    for _ in range(rounds):
        up = state.select(*group, F.col("_t").alias("_up"), F.col("_up").alias("_up2"), F.col("_d").alias("_d2"))
        state = state.join(up, [*group, "_up"], "left").select(*group, "_t", F.col("_up2").alias("_up"), (F.col("_d") + F.coalesce("_d2", F.lit(0))).alias("_d"), "_ways").checkpoint()
        if not state.where(F.col("_up").isNotNull()).limit(1).count():
            break
    whole = Window.partitionBy(*group)
    good = (F.count_if((F.col("_d") == 0)).over(whole) == 1) & (F.max("_ways").over(whole) == 1) & (F.count("_up").over(whole) == 0) & (F.max("_d").over(whole) == F.count(F.lit(1)).over(whole) - 1)
    return rows.join(state.select(*group, F.col("_t").alias(token), F.when(good, F.col("_d")).alias("position")), [*group, token])


def frame_key(position: Column, n: Column) -> Column:
    """Zero-padded number, five digits or as many as the last needs."""
    width = F.greatest(F.lit(5), F.length((n - 1).cast("string")))
    text = position.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), width - F.length(text))), text)


def every_nth(items: Column, n: int, first: int = 0) -> Column:
    """Elements first, first + n, ... of an array; none of an empty one, null of null."""
    return F.filter(items, lambda x, i: (i >= first) & ((i - first) % n == 0))


def round_robin(rows: DataFrame, key: str, endpoints: int, block: int = 4096) -> DataFrame:
    """Adds ``endpoint``, (number in order of an integer key) mod ``endpoints``.

    Keys are numbered within blocks of ``block``; blocks start at the running
    total of the sizes in front of them, counted in the same way within blocks of
    blocks. So no task orders more than a block of either, but the last, which
    orders one row for ``block`` x ``block`` keys.
    """
    blocks = rows.withColumn("_b", F.floor(F.col(key) / block)).withColumn("_bb", F.floor(F.col("_b") / block))
    sizes = blocks.groupBy("_bb", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_in", F.coalesce(F.sum("_n").over(before(Window.partitionBy("_bb").orderBy("_b"))), F.lit(0)))
    tops = sizes.groupBy("_bb").agg(F.sum("_n").alias("_m"))
    tops = tops.select("_bb", F.coalesce(F.sum("_m").over(before(Window.orderBy("_bb"))), F.lit(0)).alias("_top"))
    starts = sizes.join(tops, "_bb").select("_b", (F.col("_top") + F.col("_in")).alias("_start"))
    number = F.col("_start") + F.row_number().over(Window.partitionBy("_b").orderBy(key)) - 1
    return blocks.join(starts, "_b").withColumn("endpoint", F.pmod(number, F.lit(endpoints)).cast("int")).drop("_b", "_bb", "_start")


def missing(required: DataFrame, present: DataFrame, key: Sequence[str]) -> DataFrame:
    return required.select(*key).distinct().join(present, list(key), "left_anti")
