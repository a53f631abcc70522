"""Message layouts: text patterns and JSON objects, both as one Column over EVENT rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions.text import abbreviate

# The conversion words that layouts may use.
WORDS = ("level", "thread", "logger", "msg", "n", "ex")
TOKEN = re.compile(r"%(-?\d+)?([A-Za-z]+)(?:\{([^}]*)\})?")


def trace_head(frames: int) -> Column:
    """The stack trace with at most ``frames`` call lines below each heading line."""
    run = r"((?:\tat [^\n]*(?:\n|\z)){%d})(?:\t(?:at|\.\.\.) [^\n]*(?:\n|\z))+" % frames
    return F.regexp_replace("stack_trace", run, "$1")


def _word(word: str, option: str | None) -> Column:
    none = F.lit("")
    if word in ("level", "thread"):
        return F.coalesce(word, none)
    if word == "logger":
        return F.coalesce(abbreviate("logger", -1 if option is None else int(option)), none)
    if word == "msg":
        return F.coalesce("message", none)
    if word == "n":
        return F.lit("\n")
    if word == "ex":
        if option is None or option == "full":
            return F.coalesce("stack_trace", F.lit(""))
        return F.coalesce(trace_head(1 if option == "short" else int(option)), F.lit(""))
    raise ValueError(f"unknown conversion word: %{word}; known: {', '.join(WORDS)}")


def _padded(c: Column, width: int) -> Column:
    """At least ``width`` characters, right-aligned; left-aligned when negative. Never cut."""
    pad = F.rpad if width < 0 else F.lpad
    return F.when(F.length(c) < abs(width), pad(c, abs(width), " ")).otherwise(c)


def format_text(pattern: str, whole_trace: bool = True) -> Column:
    """Render a pattern such as ``[%thread] %logger{20} - %msg%n``.

    Words: ``%level %thread %logger %logger{n} %msg %n %ex %ex{n}``, each with an optional minimum
    width (``%-5level``). A null is written as nothing, so no line is lost. A message pattern without ``%ex`` still gets the stack trace appended;
    ``whole_trace=False`` is the form for labels, which never do.
    """
    parts: list[Column] = []
    at, saw_trace = 0, False
    for m in TOKEN.finditer(pattern):
        if m.start() > at:
            parts.append(F.lit(pattern[at:m.start()]))
        saw_trace |= m[2] == "ex"
        c = _word(m[2], m[3])
        parts.append(_padded(c, int(m[1])) if m[1] else c)
        at = m.end()
    if at < len(pattern):
        parts.append(F.lit(pattern[at:]))
    if whole_trace and not saw_trace:
        parts.append(F.coalesce("stack_trace", F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


@dataclass(frozen=True)
class FieldSpec:
    """A scalar field of the JSON layout."""

    name: str
    enabled: bool = True


@dataclass(frozen=True)
class MapSpec:
    """A group of fields of the JSON layout, one per map entry or pair."""

    prefix: str
    enabled: bool = True
    no_prefix: bool = False
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    serializer: object = None


@dataclass(frozen=True)
class JsonLayout:
    """The standard fields in their fixed order, then custom fragments."""

    timestamp: FieldSpec = FieldSpec("timestamp_ms")
    logger: FieldSpec = FieldSpec("logger_name")
    level: FieldSpec = FieldSpec("level")
    thread: FieldSpec = FieldSpec("thread_name")
    message: FieldSpec = FieldSpec("message")
    stack_trace: FieldSpec = FieldSpec("stack_trace")
    mdc: MapSpec = MapSpec("mdc_")
    kvp: MapSpec = MapSpec("kvp_")
    logger_length: int = -1
    trace: Column | None = None
    custom: Sequence[Column] = field(default_factory=tuple)

    def without(self, *names: str) -> "JsonLayout":
        """A copy with the named fields disabled."""
        return replace(self, **{n: replace(getattr(self, n), enabled=False) for n in names})

    def only(self, *names: str) -> "JsonLayout":
        """A copy with every standard field but the named ones disabled."""
        every = ("timestamp", "logger", "level", "thread", "message", "stack_trace", "mdc", "kvp")
        return self.without(*(n for n in every if n not in names))


def format_json(layout: JsonLayout = JsonLayout()) -> Column:
    """Render EVENT rows as JSON objects; disabled and empty fields write nothing."""
    scalars = [
        (spec.name, c)
        for spec, c in (
            (layout.timestamp, F.col("ts_ms")),
            (layout.logger, abbreviate("logger", layout.logger_length)),
            (layout.level, F.col("level")),
            (layout.thread, F.col("thread")),
            (layout.message, F.col("message")),
        )
        if spec.enabled
    ]
    fragments: list[Column] = [J.scalar_fields(scalars)] if scalars else []
    if layout.stack_trace.enabled:
        trace = F.col("stack_trace") if layout.trace is None else layout.trace
        fragments.append(
            F.when(F.col("stack_trace").isNotNull(), J.field(layout.stack_trace.name, trace))
        )
    if layout.mdc.enabled:
        m = layout.mdc
        fragments.append(J.map_fields("mdc", m.prefix, m.no_prefix, m.include, m.exclude))
    if layout.kvp.enabled:
        k = layout.kvp
        fragments.append(
            J.kvp_fields("kvp", k.prefix, k.no_prefix, k.include, k.exclude, k.serializer)
        )
    fragments.extend(layout.custom)
    return J.json_object(*fragments)
