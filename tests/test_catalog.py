import duckdb
import pytest

import __spark_entry__ as entry
from logbarge.plans.ship import ShipOptions, encode, ship
from logbarge.plans.tables import SHOP_LABELS, SHOP_LINE, SHOP_METADATA, shop_events, shop_records

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, sf, name):
    df = entry.queries()[name](spark, sf)
    result = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["items"] for r in rows) == 1000 and rows[0].payload_json.startswith('{"streams":[{"stream":{"app":"shop"')


@pytest.mark.parametrize("protocol", ["json", "proto", "text"])
def test_ship(spark, sf, protocol):
    events = shop_events(spark, sf)
    options = ShipOptions(SHOP_LABELS, SHOP_METADATA, SHOP_LINE, max_items=100, max_bytes=9000, timeout_ms=10**7, protocol=protocol)
    direct = ship(events, options).payloads
    via_table = ship(events, options, stage=f"shaped-{protocol}").payloads
    assert sorted(map(str, direct.collect())) == sorted(map(str, via_table.collect()))
    assert sum(r["items"] for r in direct.collect()) == 1000


def test_ship_static(spark, sf):
    options = ShipOptions(SHOP_LABELS, SHOP_METADATA, SHOP_LINE, static_labels=True, max_items=300)
    rows = ship(shop_events(spark, sf), options).payloads.collect()
    assert [r.streams for r in rows] == [1] * 4
    with pytest.raises(ValueError):
        ship(shop_events(spark, sf), ShipOptions("*=%%mdc", static_labels=True))
    with pytest.raises(ValueError):
        encode(shop_records(spark, sf), ShipOptions("a=b", protocol="xml"))
