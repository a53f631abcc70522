"""Map functions: bulk copies, markers, ordered merging, sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json import value_text
from .text import _col

MAP_TYPE = "map<string,string>"


def no_map() -> Column:
    """The empty string map."""
    return F.create_map().cast(MAP_TYPE)


def map_bytes(m: Column | str) -> Column:
    """UTF-8 bytes of all keys and values of a map."""
    m = _col(m)
    return F.octet_length(F.array_join(F.map_keys(m), "")) + F.octet_length(
        F.array_join(F.map_values(m), "")
    )


def allowed(key: Column, include: Iterable[str], exclude: Iterable[str]) -> Column | None:
    """Key test of bulk rules: exclusion first, then inclusion; an empty set means no test."""
    include, exclude = sorted(set(include)), sorted(set(exclude))
    tests = []
    if exclude:
        tests.append(~key.isin(exclude))
    if include:
        tests.append(key.isin(include))
    if not tests:
        return None
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def bulk(
    m: Column | str, prefix: str = "", include: Iterable[str] = (), exclude: Iterable[str] = ()
) -> Column:
    """Copy the entries of a string map, skipping null values, filtering and prefixing keys."""

    def keep(k: Column, v: Column) -> Column:
        test = allowed(k, include, exclude)
        return v.isNotNull() if test is None else v.isNotNull() & test

    kept = F.map_filter(F.coalesce(_col(m), no_map()), keep)
    return F.transform_keys(kept, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else kept


def bulk_kvp(
    kvp: Column | str, prefix: str = "", include: Iterable[str] = (), exclude: Iterable[str] = ()
) -> Column:
    """The same over a list of (key, variant) pairs; a repeated key keeps its last value."""
    pairs = F.transform(
        F.coalesce(_col(kvp), F.array().cast("array<struct<key:string,value:variant>>")),
        lambda e: F.struct(
            e["key"].alias("key"), e["value"].alias("value"), e["value"].cast("string").alias("text")
        ),
    )

    def keep(e: Column) -> Column:
        present = e["key"].isNotNull() & e["text"].isNotNull()
        test = allowed(e["key"], include, exclude)
        return present if test is None else present & test

    def named(e: Column) -> Column:
        key = F.concat(F.lit(prefix), e["key"]) if prefix else e["key"]
        return F.struct(key.alias("key"), value_text(e["value"], text=e["text"]).alias("value"))

    return F.map_from_entries(F.transform(F.filter(pairs, keep), named))


def marker_map(kind: str, markers: Column | str = "markers") -> Column:
    """Entries of the first marker of a kind; later ones of that kind are ignored."""
    first = F.get(F.filter(_col(markers), lambda m: m["kind"] == kind), F.lit(0))
    return F.coalesce(first["kv"], no_map())


def merge_maps(*maps: Column) -> Column:
    """Merge left to right: a later value replaces an earlier one at the earlier position.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (see ``logbarge.settings.configure``).
    """
    if not maps:
        return no_map()
    return maps[0] if len(maps) == 1 else F.map_concat(*maps)
