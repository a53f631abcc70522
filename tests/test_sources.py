import pytest
from helpers import values
from pyspark.sql import functions as F

from logbarge.sources import EventMapping, read_events
from logbarge.sources.events import spread, with_record_time


def mapping():
    return EventMapping("id", "ts", {"level": "kind", "app": F.lit("shop"), "host": F.lit("h")}, keep=("id",))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_event_tables(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = spark.sql("select 5L as id, timestamp'2024-01-01 00:00:07.179575' as ts, 'INFO' as kind, 1 as other")
    df.write.format(fmt).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").save(path)
    schema = None if fmt in ("parquet", "orc") else "id bigint, ts timestamp, kind string, other int"
    got = read_events(spark, path, fmt, mapping(), schema)
    assert values(got, "seq", "ts_ms", "nanos_in_ms", "level", "app", "host", "tenant", "id") == [
        (5, 1704067207179, 575000, "INFO", "shop", "h", None, 5)
    ]


def test_only_used_columns_are_read(spark, sf):
    mapping = EventMapping("event_id", "ts", {"level": "event_type"})
    plan = read_events(spark, f"{sf}/events.parquet", mapping=mapping).filter("level = 'error'").select("seq")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in text


def test_unknown_event_column(spark):
    with pytest.raises(ValueError):
        EventMapping("id", columns={"nosuch": "id"}).select(spark.range(1))


def test_spread(spark):
    for given in (1, 9):
        assert spread(spark.range(0, 10, 1, given), "id", 5).rdd.getNumPartitions() == 5


def test_record_time_columns(spark):
    df = with_record_time(spark.sql("select timestamp'2024-01-01 00:00:00.000001' as t"), "t")
    assert values(df, "ts_ms", "nanos_in_ms") == [(1704067200000, 1000)]
