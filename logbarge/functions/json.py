"""JSON fragments: quoting, typed values, and the fields of a JSON layout.

A fragment is the text ``"name":value``; null stands for "write nothing".
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# Numbers with a fraction or exponent, outside of strings: $1 is what comes before, $2 the number.
FRACTION = (
    r'\G((?:"(?:[^"\\]|\\.)*+"|-?[0-9]++(?![.eE])|[^"0-9-])*+)'
    r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)"
)


def json_quote(c: Column | str) -> Column:
    """A JSON string literal; null gives ``null``. Non-ASCII text stays as it is."""
    return F.btrim(F.to_json(F.array(_col(c))), F.lit("[]"))


# The tokens of a JSON text without white space, as one group.
TOKEN = r'("(?:[^"\\]|\\.)*+"|-?[0-9][0-9.eE+-]*+|[\[\]{},:]|[a-z]++)'


def _walked(text: Column, write: Callable[[Column], Column]) -> Column:
    """Rewrite the tokens of a JSON text that are in no object; objects stay as they are.

    One pass over the tokens that counts open braces, so lists may be nested to any depth.
    """
    start = F.struct(F.lit(0).alias("open"), F.lit("").alias("out"))

    def step(acc: Column, token: Column) -> Column:
        begins, ends = (token == "{").cast("int"), (token == "}").cast("int")
        kept = F.when(acc["open"] + begins > 0, token).otherwise(write(token))
        return F.struct((acc["open"] + begins - ends).alias("open"), F.concat(acc["out"], kept).alias("out"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), start, step, lambda acc: acc["out"])


def _typed(text: Column) -> Column:
    """``json_value`` of a JSON text."""
    quoted = F.regexp_replace(text, FRACTION, '$1"$2"')
    fraction = text.rlike(r"\A(?=[\[0-9-]).*[0-9][.eE]")

    def write(token: Column) -> Column:
        wide = token.rlike(r"\A-?[0-9]{19,}\z") & token.try_cast("bigint").isNull()
        return F.when(token.rlike(r"\A-?[0-9]+[.eE]") | wide, F.concat(F.lit('"'), token, F.lit('"'))).otherwise(token)

    # lists that hold objects and numbers that may be too wide need the tokens
    hard = text.rlike(r"\A(?:\[.*\{|(?=[\[0-9-]).*[0-9]{19})")
    return F.when(text.isNull(), F.lit("null")).when(hard, _walked(text, write)).when(fraction, quoted).otherwise(text)


def json_value(v: Column | str) -> Column:
    """JSON text of a VARIANT: strings quoted, whole numbers of up to 64 bits and booleans plain, arrays
    element by element to any depth, objects verbatim, and every other scalar (wider numbers, decimals,
    doubles, dates) as a quoted string.
    """
    return _typed(F.to_json(_col(v)))


def value_text(v: Column, text: Column | None = None) -> Column:
    """Plain text of a VARIANT: scalars as they print, lists as ``[a, b]`` to any depth, objects as JSON.

    ``text`` is ``v`` cast to string, when the caller has it already.
    """
    text = v.cast("string") if text is None else text

    def write(token: Column) -> Column:
        plain = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
        return F.when(token == ",", ", ").when(token.startswith('"'), plain).otherwise(token)

    is_list = text.startswith("[") & F.schema_of_variant(v).startswith("ARRAY")
    return F.when(is_list, _walked(F.to_json(v), write)).otherwise(text)


def _named(name: Column | str, value: Column) -> Column:
    label = json_quote(F.lit(name)) if isinstance(name, str) else json_quote(name)
    return F.concat(label, F.lit(":"), value)


def field(name: str, c: Column | str, kind: str = "string") -> Column:
    """One scalar field; ``kind`` is ``string``, ``number`` or ``boolean``. Null is written as null."""
    c = _col(c)
    value = json_quote(c) if kind == "string" else F.coalesce(c.cast("string"), F.lit("null"))
    return _named(name, value)


def present_field(name: str, c: Column | str) -> Column:
    """A string field that is written only when the value exists."""
    c = _col(c)
    return F.when(c.isNotNull(), field(name, c))


def raw_field(name: str, c: Column | str, checked: bool = False) -> Column:
    """A field whose text is valid JSON already; ``checked`` drops it when it is not.

    A null raw text is refused, so it gives no field.
    """
    c = _col(c)
    ok = F.try_parse_json(c).isNotNull() if checked else c.isNotNull()
    return F.when(ok, _named(name, c))


def array_field(
    name: Column | str, arr: Column | str, fn: Callable[[Column], Column] = json_quote
) -> Column:
    """An array field with one writer per element, which may itself build nested objects."""
    return _named(
        name, F.concat(F.lit("["), F.array_join(F.transform(_col(arr), fn), ","), F.lit("]"))
    )


def json_object(*fragments: Column) -> Column:
    """``{..}`` from field fragments (or arrays of them), leaving out the null ones."""
    if not fragments:
        return F.lit("{}")
    return F.concat(F.lit("{"), F.concat_ws(",", *fragments), F.lit("}"))


def object_body(text: Column) -> Column:
    """The inside of a flat JSON object; null when it is empty."""
    return F.nullif(F.btrim(text, F.lit("{}")), F.lit(""))


def scalar_fields(fields: Sequence[tuple[str, Column]]) -> Column:
    """Several scalar fields in one pass: strings quoted, numbers plain, nulls written as null."""
    row = F.struct(*(c.alias(name) for name, c in fields))
    return object_body(F.to_json(row, {"ignoreNullFields": "false"}))


def map_fields(
    m: Column | str,
    prefix: str = "mdc_",
    no_prefix: bool = False,
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
) -> Column:
    """One string field per map entry, as one fragment."""
    from .maps import bulk

    return object_body(F.to_json(bulk(m, "" if no_prefix else prefix, include, exclude)))


def kvp_fields(
    kvp: Column | str,
    prefix: str = "kvp_",
    no_prefix: bool = False,
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
    serializer: Callable[[Column, Column], Column] | None = None,
) -> Column:
    """One typed field per pair, repeated keys included: array of fragments.

    ``serializer(name, value)`` may write the whole fragment itself.
    """
    from .maps import allowed

    lead = F.lit("" if no_prefix else prefix)
    # the JSON text is needed several times below, so it is computed once per pair
    pairs = F.transform(
        _col(kvp),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), F.to_json(e["value"]).alias("text")),
    )

    def keep(e: Column) -> Column:
        # a variant may hold a JSON null, which counts as no value
        present = e["key"].isNotNull() & (F.coalesce(e["text"], F.lit("null")) != "null")
        test = allowed(e["key"], include, exclude)
        return present if test is None else present & test

    def write(e: Column) -> Column:
        name = F.concat(lead, e["key"])
        if serializer is not None:
            return serializer(name, e["value"])
        return _named(name, _typed(e["text"]))

    return F.transform(F.filter(pairs, keep), write)
