"""Column layouts of the tables that flow between the operators."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

KVP = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.VariantType())])
)

MARKERS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("kv", STRING_MAP)])
)

EVENT = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("nanos_in_ms", T.IntegerType()),
        T.StructField("level", T.StringType()),
        T.StructField("logger", T.StringType()),
        T.StructField("thread", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
        T.StructField("mdc", STRING_MAP),
        T.StructField("kvp", KVP),
        T.StructField("markers", MARKERS),
        T.StructField("app", T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("tenant", T.StringType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("nanos_in_ms", T.IntegerType()),
        T.StructField("labels", STRING_MAP),
        T.StructField("line", T.StringType()),
        T.StructField("metadata", STRING_MAP),
    ]
)

ATTEMPT_FIELDS = [
    T.StructField("batch_no", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("exception", T.StringType()),
    T.StructField("delay_ms", T.LongType()),
]
