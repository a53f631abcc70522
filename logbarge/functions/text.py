"""Text functions: lengths, blanks, key-value splitting, logger names, label texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space (the no-break spaces do not),
# and the ones trimmed from both ends of keys and values (U+0000 to U+0020).
BLANK = r"\A[\t-\r\x1c-\x1f[\p{Z}&&[^\u00a0\u2007\u202f]]]*\z"
TRIMMED = r"\A[\x00-\x20]+|[\x00-\x20]+\z"

REGEX_PREFIX = "regex:"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utf8_len(c: Column | str) -> Column:
    """Length of a string in UTF-8 bytes."""
    return F.octet_length(_col(c))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only strings."""
    return F.coalesce(_col(c), F.lit("")).rlike(BLANK)


def trim_control(c: Column | str) -> Column:
    """Strip every character up to U+0020 from both ends, not only the space."""
    return F.regexp_replace(_col(c), TRIMMED, "")


def abbreviate(c: Column | str, target: int = -1) -> Column:
    """Shorten a dotted logger name.

    A negative target keeps the name, 0 keeps the class name only. Otherwise left segments
    are cut to one letter, from the left, until the name fits; the last segment is never cut.
    The first segment is cut whenever the name is at least ``target`` long.
    """
    c = _col(c)
    if target < 0:
        return c
    if target == 0:
        return F.substring_index(c, ".", -1)
    last = F.substring_index(c, ".", -1)
    left = F.split(F.substring(c, F.lit(1), F.length(c) - F.length(last) - 1), r"\.")
    left_len = F.length(c) - F.length(last) - 1
    budget = left_len - F.greatest(F.lit(target) - F.length(last) - 1, F.lit(0))
    start = F.struct(F.lit(-1).alias("cut"), F.lit("").alias("text"))

    def step(acc: Column, segment: Column) -> Column:
        short = acc["cut"] < budget
        return F.struct(
            F.when(
                short, F.greatest(acc["cut"], F.lit(0)) + F.greatest(F.length(segment) - 1, F.lit(0))
            )
            .otherwise(acc["cut"])
            .alias("cut"),
            F.concat(
                acc["text"], F.when(short, F.substring(segment, 1, 1)).otherwise(segment), F.lit(".")
            ).alias("text"),
        )

    shortened = F.concat(F.aggregate(left, start, step, lambda acc: acc["text"]), last)
    return F.when((F.length(c) < target) | ~F.contains(c, F.lit(".")), c).otherwise(shortened)


def extract_kv(c: Column | str, pair_sep: str = ",", kv_sep: str = "=") -> Column:
    """Split text into key-value pairs: struct<pairs: array<struct<key, value>>, error: string>.

    ``pair_sep`` is literal, or a regular expression after the ``regex:`` prefix. Blank pairs are
    skipped, both sides are trimmed, order is kept. A pair that does not have exactly two parts
    (trailing empty parts do not count) makes the whole text an error, as does the lack of any pair.
    """
    c = _col(c)
    pair_re = pair_sep[len(REGEX_PREFIX):] if pair_sep.startswith(REGEX_PREFIX) else re.escape(pair_sep)
    pairs = F.filter(F.split(c, pair_re), lambda p: ~is_blank(p))
    parts = F.transform(pairs, lambda p: F.split(p, re.escape(kv_sep), -1))

    def bad(p: Column) -> Column:
        value = F.get(p, F.lit(1))
        return value.isNull() | (value == "") | F.exists(
            F.slice(p, F.lit(3), F.size(p)), lambda x: x != ""
        )

    error = (
        F.when(c.isNull() | (F.size(pairs) == 0), F.lit("no pairs"))
        .when(F.exists(parts, bad), F.lit("bad pair"))
        .otherwise(F.lit(None).cast("string"))
    )
    rows = F.transform(
        parts,
        lambda p: F.struct(
            trim_control(p[0]).alias("key"), trim_control(F.get(p, F.lit(1))).alias("value")
        ),
    )
    return F.struct(F.when(error.isNull(), rows).alias("pairs"), error.alias("error"))


def stream_key(labels: Column | str) -> Column:
    """Canonical text of a label set: equal maps give equal keys whatever their entry order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_col(labels)))))


def selector(labels: Column | str) -> Column:
    """Label selector text ``{k="v",k2="v2"}``; the double quote is the only escaped character."""
    entries = F.transform(
        F.map_entries(_col(labels)),
        lambda e: F.concat(
            e["key"], F.lit('="'), F.replace(e["value"], F.lit('"'), F.lit('\\"')), F.lit('"')
        ),
    )
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def map_text(m: Column | str) -> Column:
    """Plain ``{k=v, k2=v2}`` text of a map, as used by the debugging format."""
    entries = F.transform(
        F.map_entries(_col(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
