"""Small event tables in the EVENT layout."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbarge.schemas import EVENT, RECORD

LINE = "%level/%thread %logger{20}: %msg; %ex{1}"

# A variant cannot be built on the Python side, and a dict loses its order on the way: both come as text.
MAP = "map<string,string>"


def _plain(schema, *texts):
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in texts else f for f in schema.fields])


def _text(v):
    return v if v is None or isinstance(v, str) else json.dumps(v)


_EVENT = _plain(EVENT, "kvp", "mdc")
_RECORD = _plain(RECORD, "labels", "metadata")


def events(spark, *rows):
    defaults = {"nanos_in_ms": 0, "level": "INFO", "logger": "shop.cart.Basket", "thread": "worker-1"}
    data = []
    for i, row in enumerate(rows):
        full = {**defaults, "seq": i, "ts_ms": 100 + i, "message": "m", **row}
        full["mdc"] = _text(full.get("mdc"))
        data.append(tuple(full.get(n) for n in _EVENT.names))
    df = spark.createDataFrame(data, _EVENT).withColumn("mdc", F.from_json("mdc", MAP))
    kvp = F.map_entries(F.parse_json("kvp").cast("map<string,variant>"))
    return df.withColumn("kvp", kvp).select(*EVENT.names)


def records(spark, *rows):
    data = []
    for i, row in enumerate(rows):
        full = {"seq": i, "ts_ms": 0, "nanos_in_ms": 0, "labels": {}, "line": "", "metadata": {}, **row}
        data.append(tuple(_text(full[n]) if n in ("labels", "metadata") else full[n] for n in RECORD.names))
    df = spark.createDataFrame(data, _RECORD)
    return df.withColumns({n: F.from_json(n, MAP) for n in ("labels", "metadata")})


def three_events(spark):
    return events(
        spark,
        {"ts_ms": 5000, "message": "basket opened"},
        {"ts_ms": 5020, "level": "WARN", "thread": "worker-9", "message": "stock is low"},
        {"ts_ms": 5300, "message": "basket paid"},
    )


def values(df, *columns):
    return [tuple(r) if len(columns) != 1 else r[0] for r in df.select(*columns).collect()]


def lit(spark, text):
    return spark.createDataFrame([(text,)], "s string")


def ordered(df, column):
    """Entries of the first row's map in their order, which a collected dict does not keep."""
    return list(json.loads(df.select(F.to_json(column)).first()[0]).items())
