"""Every query with a SQL twin against it, on the smallest sample and on tables with odd rows."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from logbarge.llm.oracles import ORACLES
from logbarge.llm.queries import QUERIES

LLM_TABLES = ("documents", "embeddings", "pages", "labels")


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


def same(spark, folder, name):
    con = duckdb.connect()
    for t in LLM_TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    df = QUERIES[name](spark, folder)
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(map(plain, r)) for r in result.fetchall()), key=str)
    assert sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str) == want


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    docs = [
        (0, "Licensed under the MIT Licence", "en", "src0", 1), (1, None, "en", "src1", None), (2, "", None, "src2", 0),
        (3, "Copyright 2020 A\n\n(c) B\nLICENSED under CC BY 4.0!\n", "fr", None, 9), (3, "x", "fr", "src19", 1), (3, "x", "fr", "src19", 1),
        (None, "a b", "de", "nowhere", 3), (6, "c d", "de", "elsewhere", 3), (7, "e f", "de", None, 3), (4, "Sub license, licence; licenced\nAll rights reserved", "de", "src7", 3), (5, "word " * 9000, "en", "src0", 45000),
    ]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    table = pa.table({n: pa.array([d[k] for d in docs], t) for k, (n, t) in enumerate(zip(names, [pa.int64(), *[pa.string()] * 3, pa.int64()]))})
    # a column called like an internal one must do no harm
    pq.write_table(table, folder / "documents.parquet")
    vectors = [(0, [1.0, 0.5]), (50, [0.5, 1.0]), (51, [0.5, 1.0]), (52, None), (53, [float("nan"), 1.0]), (54, [None, 1.0]), (100, [3e5, -2.0]), (100, [0.25, 0.25]), (None, [1.0, 1.0]), (57, [1.0, 2.0, 3.0])]
    pq.write_table(pa.table({"vec_id": pa.array([v[0] for v in vectors], pa.int64()), "embedding": pa.array([v[1] for v in vectors], pa.list_(pa.float32())), "label": pa.array([0] * len(vectors), pa.int32())}), folder / "embeddings.parquet")
    urls = [
        "http://A.Example.NET/en/x", "https://example.net/en", "http://b.example.net", "http://net/a", "ftp://x.org/fr/?q=/fr/", "http://org/fr/#t",
        "http://m.example.com/de/1?x=://y", "http://example.com:80/de/", "no scheme", None, "", "http://", "http:///p", "x://h.co.uk?a", "http://notexample.net/en/", "http://É.org/fr/", "http://a\nb.net/c\nd", "http://one.org", "http://one.org", "http://two.one.org/",
    ]
    pq.write_table(pa.table({"page_id": pa.array([None, *range(1, len(urls))], pa.int64()), "url": pa.array(urls, pa.string()), "html": pa.array([""] * len(urls))}), folder / "pages.parquet")
    labels = [(1, 1, 0), (2, 0, 0), (17, 0, 1), (18, 0, 0), (18, 1, 0), (19, 1, 1), (None, 0, 1), (7, None, None), (8, None, 1), (4, 1, 0)]
    pq.write_table(pa.table({n: pa.array([x[k] for x in labels], t) for k, (n, t) in enumerate(zip(["doc_id", "quality", "toxic"], [pa.int64(), pa.int32(), pa.int32()]))}), folder / "labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def nothing(odd, tmp_path_factory):
    folder = tmp_path_factory.mktemp("nothing")
    for t in LLM_TABLES:
        pq.write_table(pq.read_table(f"{odd}/{t}.parquet").slice(0, 0), folder / f"{t}.parquet")
    return str(folder)


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sample(spark, sf, name):
    same(spark, sf, name)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_odd_rows(spark, odd, name):
    same(spark, odd, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_odd_rows_do_not_crash(spark, odd, name):
    n = QUERIES[name](spark, odd).count()
    assert n >= 9 or name == "op9_token_matrix"
