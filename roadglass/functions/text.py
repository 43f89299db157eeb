"""Text functions: names of topics and files, tag chains, answers of language models, stamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name formats.
CAMERA_TOPIC = r"^/sensing/camera/(camera\d+)/image_raw/compressed$"
CAMERA_INFO = r"^(camera\d+)_info$"
CAMERA_LINK = r"^camera\d+/camera_link$"
CHANNEL = r"^(CAM_[A-Z0-9]+(?:_[A-Z0-9]+)*?)_(\d{5})_"


def topic_name(topic: Column) -> Column:
    return F.translate(F.btrim(topic, F.lit("/")), "/", "_")


def camera_of(topic: Column) -> Column:
    """The camera of an image topic, or null."""
    return F.nullif(F.regexp_extract(topic, CAMERA_TOPIC, 1), F.lit(""))


def stem(path: Column) -> Column:
    """Last part of a path without its extension."""
    return F.regexp_extract(F.rtrim(path, F.lit("/")), r"([^/]+?)(\.[^./]*)?$", 1)


def before_camera(name: Column) -> Column:
    """What stands before the first ``_CAM_``; null without one."""
    return F.when(F.instr(name, "_CAM_") > 0, F.substring_index(name, "_CAM_", 1))


def channel_of(rest: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(rest, CHANNEL, 1), F.lit("")), F.lit("UNKNOWN"))


def tags(chain: Column) -> Column:
    """Array of (kind, value) of an underscore-joined chain of augmentation tags.

    ``flicker`` stands alone; ``whole`` and the two parts after it, a colour and
    an angle, written ``degN`` or bare, are one tag; ``ph``, ``rcn``, ``rcw`` and
    ``lr`` carry two digits. Anything else is unknown, with its text, also an
    empty part. One fold, with a count of parts to skip.
    """
    parts = F.split(chain, "_")
    tag = "struct<kind:string,value:string>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("skip"), F.array().cast(f"array<{tag}>").alias("out"))

    def step(a: Column, p: Column) -> Column:
        colour, degrees = F.get(parts, a["at"] + 1), F.get(parts, a["at"] + 2)
        whole = (p == "whole") & degrees.isNotNull()
        found = (
            F.when(p == "flicker", F.struct(p.alias("kind"), F.lit(None).cast("string").alias("value")))
            .when(whole, F.struct(F.lit("whole").alias("kind"), F.concat(colour, F.lit(":"), F.regexp_replace(degrees, "^deg", "")).alias("value")))
            .when(p.rlike(r"^(ph|rcn|rcw|lr)\d{2}$"), F.struct(F.regexp_extract(p, r"^([a-z]+)", 1).alias("kind"), F.regexp_extract(p, r"(\d{2})$", 1).alias("value")))
            .otherwise(F.struct(F.lit("unknown").alias("kind"), p.alias("value")))
        )
        skipping = a["skip"] > 0
        return F.struct(
            (a["at"] + 1).alias("at"),
            F.when(skipping, a["skip"] - 1).when(whole, 2).otherwise(0).alias("skip"),
            F.when(skipping, a["out"]).otherwise(F.concat(a["out"], F.array(found))).alias("out"),
        )

    return F.aggregate(parts, start, step, lambda a: a["out"])


def describe_tag(kind: Column, value: Column) -> Column:
    return (
        F.when(kind == "flicker", F.lit("flickering light"))
        .when(kind == "whole", F.concat(F.lit("whole light recoloured, "), value, F.lit(" degrees")))
        .when(kind == "unknown", F.concat(F.lit("unknown tag "), value))
        .otherwise(F.concat(kind, F.lit(" level "), value))
    )


def strip_fences(text: Column) -> Column:
    """Without <think> blocks and code fences, trimmed."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, r"(?is)<think>.*?</think>", ""), r"(?m)^```(?:json)?\s*$", ""), F.lit(" \t\r\n"))


#: String literals, also one that the text cuts off, and braces outside of them.
JSON_MARK = re.compile(r'"(?:[^"\\]|\\.)*+(?:"|\\?\Z)|[{}]', re.DOTALL)


def _balanced(text: str | None) -> str | None:
    if text is None or (start := text.find("{")) < 0:
        return None
    depth = 0
    for mark in JSON_MARK.finditer(text, start):
        depth += {"{": 1, "}": -1}.get(mark[0], 0)
        if not depth:
            return text[start : mark.end()]
    return None


def first_object(text: Column) -> Column:
    """The first balanced {...}, strings and escapes honoured; null without one. Not regular, hence Python."""
    return F.udf(_balanced, "string", useArrow=True)(text)


def parse_answer(text: Column) -> Column:
    """VARIANT of a model's answer: as it is without fences, else its first object; null if neither parses."""
    clean = strip_fences(text)
    parsed = F.try_parse_json(clean)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.coalesce(F.when(is_object, parsed), F.try_parse_json(first_object(clean)))


def stamp(t_ns: Column) -> Column:
    """Seconds and nine digits of nanoseconds, by integer arithmetic (a double can't hold them)."""
    nanos = F.pmod(t_ns, F.lit(1_000_000_000))
    whole = F.call_function("div", t_ns - nanos, F.lit(1_000_000_000))
    return F.concat(whole.cast("string"), F.lpad(nanos.cast("string"), 9, "0"))


def unix_ns(seconds_: Column) -> Column:
    return (seconds_ * 1e9).cast("long")


def box_line(kind: str, category: Column, attributes: Column) -> Column:
    """"- 2D box: car (parked, wet)"; without attributes no brackets."""
    listed = F.array_join(attributes, ", ")
    return F.concat(F.lit(f"- {kind}: "), category, F.when(F.size(attributes) > 0, F.concat(F.lit(" ("), listed, F.lit(")"))).otherwise(""))


def prompt(lines: Column, guidance: Column, fallback: str) -> Column:
    """Question for a reviewer model: its guidance, or the fallback, then the annotation lines."""
    return F.concat(F.coalesce(guidance, F.lit(fallback)), F.lit("\n"), F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(F.lit("(no annotations)")))


def or_default(value: Column, default) -> Column:
    """The default for null, zero and the empty string alike."""
    empty = "" if isinstance(default, str) else 0
    return F.when(value.isNull() | (value == empty), F.lit(default)).otherwise(value)


def camera_ids(listed: Column) -> Column:
    """Array of the numbers of a comma-separated list; empty parts are skipped, anything else that is no number is an error."""
    parts = F.filter(F.transform(F.split(listed, ","), lambda x: F.btrim(x, F.lit(" \t\r\n"))), lambda x: x != "")
    return F.transform(parts, lambda x: x.cast("int"))


def resolution(size: Column) -> Column:
    """(width, height) of "1280x720"; null if it isn't written so or either is odd."""
    form = r"^([0-9]+)[xX]([0-9]+)$"
    w, h = (F.nullif(F.regexp_extract(size, form, i), F.lit("")).try_cast("int") for i in (1, 2))
    return F.when((w % 2 == 0) & (h % 2 == 0), F.struct(w.alias("width"), h.alias("height")))
