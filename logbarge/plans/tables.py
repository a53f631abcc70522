"""The sample tables as events and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import json_quote
from ..operators.projection import project_records
from ..settings import configure
from ..sources import EventMapping
from ..sources.events import spread

SHOP_LABELS = "app=shop\nlevel=%level"
SHOP_METADATA = "thread=%thread\n*=%%kvp"
SHOP_LINE = "[%thread] %logger{20} - %msg%n"


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """A sample table; with ``key`` spread over the cores, since it is one file."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df if key is None else spread(df, key, spark.sparkContext.defaultParallelism)


def cents(value: str) -> Column:
    return F.round(F.col(value) * 100).cast("bigint")


def pairs_of(text: Column) -> Column:
    """A JSON object text as a list of (key, variant)."""
    return F.map_entries(F.try_parse_json(text).cast("map<string,variant>"))


def thread() -> Column:
    return F.concat(F.lit("user-"), (F.col("user_id") % 8).cast("string"))


def shop_mapping(**more: Column | str) -> EventMapping:
    columns: dict[str, Column | str] = {
        "level": "event_type",
        "logger": F.concat(F.lit("shop.events."), "event_type"),
        "thread": thread(),
        "message": F.concat("event_type", F.lit(" "), cents("value").cast("string")),
        "kvp": pairs_of(F.col("props")),
        "app": F.lit("shop"),
        **more,
    }
    keep = ("user_id", "event_type", "value")
    return EventMapping(seq="event_id", ts="ts", columns=columns, keep=keep)


def shop_events(spark: SparkSession, sf_dir: str, **more: Column | str) -> DataFrame:
    return shop_mapping(**more).select(table(spark, sf_dir, "events", "event_id"))


def shop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all events, with the thread as shard."""
    events = shop_events(spark, sf_dir).withColumn("shard", F.col("thread"))
    return project_records(events, SHOP_LABELS, SHOP_METADATA, SHOP_LINE, keep=["shard"])


def typed_pairs() -> Column:
    """A list of pairs with every value type, built from the event columns."""
    amount = F.concat(
        F.expr("cast(round(value * 100) as bigint) div 100").cast("string"), F.lit("."),
        F.lpad((cents("value") % 100).cast("string"), 2, "0"), F.lit("1"),
    )
    user = F.col("user_id").cast("string")
    even = (F.col("user_id") % 2 == 0).cast("string")
    name = json_quote("event_type")
    return pairs_of(
        F.concat(
            F.lit('{"amount":'), amount, F.lit(',"even":'), even,
            F.lit(',"list":['), user, F.lit(","), name, F.lit(","), amount, F.lit(",null,"), even,
            F.lit('],"name":'), name, F.lit(',"none":null,"nested":{"user":'), user, F.lit('},"user":'),
            user, F.lit("}"),
        )
    )


def deep_list() -> Column:
    """A JSON list nested six deep, built from the event columns."""
    user, name = F.col("user_id").cast("string"), json_quote("event_type")
    amount = F.concat(F.expr("cast(round(value * 100) as bigint) div 100").cast("string"), F.lit(".251"))
    return F.concat(
        F.lit("[[[[[["), amount, F.lit(',{"x":'), amount, F.lit("},"), name, F.lit(",99999999999999999999"), user,
        F.lit(",null]]]]],"), user, F.lit("]"),
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as log records: long lines in several languages."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.lit(0).cast("bigint").alias("ts_ms"),
        F.lit(0).alias("nanos_in_ms"),
        F.create_map(F.lit("lang"), "lang", F.lit("source"), "source").alias("labels"),
        F.col("text").alias("line"),
        F.create_map(F.lit("chars"), F.col("n_chars").cast("string")).alias("metadata"),
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as log records with the status as tenant."""
    ts_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        ts_ms.alias("ts_ms"),
        F.lit(0).alias("nanos_in_ms"),
        F.create_map(F.lit("priority"), "o_orderpriority").alias("labels"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" of "),
                 F.col("o_custkey").cast("string")).alias("line"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("tenant"),
    )


def turn_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as log records: long lines of several rows, labelled by role."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"),
        F.col("turn").alias("ts_ms"),
        F.lit(0).alias("nanos_in_ms"),
        F.create_map(F.lit("role"), "role").alias("labels"),
        F.col("text").alias("line"),
        F.create_map(F.lit("conv"), F.col("conv_id").cast("string")).alias("metadata"),
    )


def shop_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as send attempts: three to a batch, with statuses and exceptions by their columns."""
    kind = F.col("event_type")
    failed = F.element_at(
        F.array(*map(F.lit, ("ConnectException", "HttpConnectTimeoutException", "SSLException"))),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    status = (
        F.when(kind == "view", 204).when(kind == "click", 503).when(kind == "purchase", 429)
        .when(kind == "signup", 500)
    )
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 3").alias("batch_no"),
        (F.col("event_id") % 3).cast("int").alias("attempt"),
        status.cast("int").alias("status"),
        F.when(kind == "error", failed).alias("exception"),
    )
