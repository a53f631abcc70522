import pytest
from helpers import LINE, events, lit, ordered, three_events, values
from pyspark.sql import functions as F

from logbarge.functions import abbreviate, bulk_kvp, extract_kv, is_blank, merge_maps, stream_key, utf8_len
from logbarge.operators.projection import (
    bulk_rule,
    check_static,
    project_records,
    read_pairs,
    read_rules,
    split_bad,
    static_labels,
)
from logbarge.operators.sizing import split_oversize
from logbarge.sources.events import record_time, wire_time


def test_labels_and_text(spark):
    rec = project_records(three_events(spark), "level=%level\napp=store", "off", LINE)
    rows = rec.orderBy("seq").collect()
    assert [r.labels for r in rows] == [
        {"level": "INFO", "app": "store"}, {"level": "WARN", "app": "store"}, {"level": "INFO", "app": "store"}
    ]
    assert rows[0].line == "INFO/worker-1 shop.cart.Basket: basket opened; "
    assert all(r.metadata == {} for r in rows)


@pytest.mark.parametrize("switch", ["off", "OFF", " ", "", None])
def test_metadata_switch(spark, switch):
    assert values(project_records(three_events(spark), "a=b", switch), "metadata") == [{}] * 3


def test_default_message_appends_trace(spark):
    df = events(spark, {"message": "boom", "stack_trace": "E: x\n\tat a\n\tat b\n"})
    rec = project_records(df, "a=b", None)
    assert values(rec, "line") == ["[worker-1] shop.cart.Basket - boom\nE: x\n\tat a\n\tat b\n"]
    rec = project_records(df, "a=b", None, "%msg %ex{1}")
    assert values(rec, "line") == ["boom E: x\n\tat a\n"]
    # labels never get the trace on top
    assert values(project_records(df, "a=%msg", None), "labels") == [{"a": "boom"}]


def test_duplicate_key_keeps_first_position(spark):
    rec = project_records(three_events(spark).limit(1), "a=1\nb=2\na=3", "off")
    assert ordered(rec, "labels") == [("a", "3"), ("b", "2")]


BULK = {"kvp": '{"qty":"3","sku":"b-17"}', "mdc": {"user": "ada", "tenant": "north"}, "thread": "worker-4"}


@pytest.mark.parametrize(
    "labels, metadata, event, want_labels, want_metadata",
    [
        ("lg=%logger\n*=%%mdc", "*=%%kvp\nth=%thread", BULK,
         {"lg": "shop.cart.Basket", "user": "ada", "tenant": "north"}, {"th": "worker-4", "qty": "3", "sku": "b-17"}),
        ("lg=%logger\n*=%%mdc", "*=%%kvp\nth=%thread", {"thread": "worker-4"}, {"lg": "shop.cart.Basket"}, {"th": "worker-4"}),
        ("item.*=%%kvp{qty}\nlg=%logger", "th=%thread\nctx.* ! = %%mdc {user, other}", BULK,
         {"lg": "shop.cart.Basket", "item.qty": "3"}, {"th": "worker-4", "ctx.tenant": "north"}),
    ],
)
def test_bulk_rules(spark, labels, metadata, event, want_labels, want_metadata):
    rec = project_records(events(spark, event), labels, metadata)
    assert ordered(rec, "labels") == list(want_labels.items())
    assert ordered(rec, "metadata") == list(want_metadata.items())


def test_null_values_are_skipped(spark):
    df = events(spark, {"mdc": {"a": None, "b": "1"}, "kvp": '{"x":null,"y":2}'})
    row = project_records(df, "*=%%mdc", "*=%%kvp").collect()[0]
    assert row.labels == {"b": "1"} and row.metadata == {"y": "2"}


def test_kvp_texts_and_repeated_keys(spark):
    pairs = F.concat(*(F.map_entries(F.parse_json(F.lit(t)).cast("map<string,variant>"))
                       for t in ('{"a":1,"b":["x",2,[null,true]]}', '{"a":0.5,"c":{"k":"v"}}')))
    got = spark.range(1).select(bulk_kvp(pairs).alias("m"))
    assert ordered(got, "m") == [("a", "0.5"), ("b", "[x, 2, [null, true]]"), ("c", '{"k":"v"}')]


def marker(kind, **kv):
    return {"kind": kind, "kv": kv}


@pytest.mark.parametrize(
    "markers, labels, metadata",
    [
        ([marker("label", region="eu")], {"l": "INFO", "region": "eu"}, {"t": "worker-1"}),
        ([marker("label", region="eu", zone="2")], {"l": "INFO", "region": "eu", "zone": "2"}, {"t": "worker-1"}),
        ([marker("metadata", order="77")], {"l": "INFO"}, {"t": "worker-1", "order": "77"}),
        ([marker("label", region="eu"), marker("metadata", order="77"), marker("label", late="x")],
         {"l": "INFO", "region": "eu"}, {"t": "worker-1", "order": "77"}),
        (None, {"l": "INFO"}, {"t": "worker-1"}),
    ],
)
def test_markers(spark, markers, labels, metadata):
    df = events(spark, {"markers": markers})
    row = project_records(df, "l=%level", "t=%thread", read_markers=True).collect()[0]
    assert row.labels == labels and row.metadata == metadata
    row = project_records(df, "l=%level", "t=%thread").collect()[0]
    assert row.labels == {"l": "INFO"} and row.metadata == {"t": "worker-1"}


def test_merge_keeps_position(spark):
    a, b = (F.from_json(F.lit(t), "map<string,string>") for t in ('{"a":"1","b":"2"}', '{"a":"9","c":"3"}'))
    got = spark.range(1).select(merge_maps(a, b).alias("m"))
    assert ordered(got, "m") == [("a", "9"), ("b", "2"), ("c", "3")]


def test_static_labels(spark):
    rec = project_records(three_events(spark), "l=%level", "off", "%msg", keep=["thread"])
    assert values(static_labels(rec), "labels") == [{"l": "INFO"}] * 3
    got = static_labels(rec, keys=["thread"]).orderBy("seq")
    assert values(got, "labels") == [{"l": "INFO"}, {"l": "WARN"}, {"l": "INFO"}]
    check_static("l=%level")
    for rules, markers in (("l=%level\n*=%%mdc", False), ("l=%level", True)):
        with pytest.raises(ValueError):
            check_static(rules, markers)


PAIR_CASES = [
    ("   ", ";", ":", None),
    ("colour:;size:xl", ";", ":", None),
    ("colour:red size:xl", ";", ":", None),
    (";;colour: red ; size :xl;;", ";", ":", [("colour", "red"), ("size", "xl")]),
    ("# palette\ncolour=red\n\n# end\n size\t=\txl", "regex:(?:\n|#[^\n]*)+", "=", [("colour", "red"), ("size", "xl")]),
    ("colour=red\rsize=xl\r\n\n", "regex:\n|\r", "=", [("colour", "red"), ("size", "xl")]),
    ("a*1+b*2", "+", "*", [("a", "1"), ("b", "2")]),
    ("a?1^b?2", "^", "?", [("a", "1"), ("b", "2")]),
    ("a= ", ",", "=", [("a", "")]),
    ("=v", ",", "=", [("", "v")]),
    ("a=b=", ",", "=", [("a", "b")]),
    ("a=b=c", ",", "=", None),
    ("a", ",", "=", None),
    ("==v", ",", "=", None),
    (" \n, ", ",", "=", None),
]


@pytest.mark.parametrize("text, pair_sep, kv_sep, want", PAIR_CASES)
def test_pairs_of_text(spark, text, pair_sep, kv_sep, want):
    got = lit(spark, text).select(extract_kv("s", pair_sep, kv_sep).alias("x")).collect()[0].x
    if want is None:
        assert got.pairs is None and got.error in ("no pairs", "bad pair")
        with pytest.raises(ValueError):
            read_pairs(text, pair_sep, kv_sep)
    else:
        assert got.error is None and [tuple(p) for p in got.pairs] == want
        assert read_pairs(text, pair_sep, kv_sep) == want


@pytest.mark.parametrize(
    "key, value, want",
    [
        ("*", "%%kvp", ("kvp", "", set(), set())),
        ("ctx.*", "%%mdc", ("mdc", "ctx.", set(), set())),
        ("ctx.*", "%%mdc{user}", ("mdc", "ctx.", {"user"}, set())),
        ("a*b*  ", "%%MDC{ user ,, tenant}", ("MDC", "a*b", {"user", "tenant"}, set())),
        ("ctx.*!", "%%mdc{user,tenant}", ("mdc", "ctx.", set(), {"user", "tenant"})),
        ("ctx.*  !", "%% kvp {}", ("kvp", "ctx.", set(), set())),
    ],
)
def test_rule_texts(key, value, want):
    r = bulk_rule(key, value)
    assert (r.func, r.prefix, r.include, r.exclude) == want


@pytest.mark.parametrize(
    "key, value",
    [("ctx.", "%%mdc"), ("ctx.*x", "%%mdc"), ("ctx.*!!", "%%mdc"), ("*", "mdc"), ("*", "%mdc"), ("*", "%%"),
     ("*", "%%mdc{a"), ("*", "%%mdc{a}b"), ("*", "%%mdc{a}{b}")],
)
def test_broken_rule_texts(key, value):
    with pytest.raises(ValueError):
        bulk_rule(key, value)


def test_rules_of_text():
    with pytest.raises(ValueError):
        read_rules("*=%%session")
    rules = read_rules("*=%%kvp{sku}\nhost=h1\nc*=%%mdc")
    assert [b.func for b in rules.bulks] == ["kvp", "mdc"] and dict(rules.named) == {"host": "h1"}


def test_nulls_lose_no_event(spark):
    """A null word is empty text; a null shard, time, order or line is a bad record with a reason."""
    df = events(spark, {"thread": None, "message": None}, {"ts_ms": None}, {"seq": None}, {"level": None, "logger": None})
    df = df.withColumn("shard", F.when(F.col("seq") != 3, "s"))
    rec = project_records(df, "t=%thread", {"x": F.lit(None)}, keep=["shard"])
    assert values(rec.where("seq = 0"), "line", "labels", "metadata") == [("[] shop.cart.Basket - \n", {"t": ""}, {"x": ""})]
    good, bad = split_bad(rec, ["shard"])
    assert values(good, "seq") == [0]
    assert sorted(values(bad, "reason")) == ["no order", "no shard", "no time"]
    lost = project_records(df, "a=b", None, F.lit(None).cast("string"), keep=["shard"])
    assert "no line" in values(split_bad(lost, ["shard"])[1], "reason")
    kept, refused = split_oversize(lost)
    assert (kept.count(), refused.count()) == (0, 4)


def test_static_labels_with_a_null_shard(spark):
    df = events(spark, {"level": "INFO"}, {"level": "WARN"}, {"level": "ERROR"}).withColumn("shard", F.when(F.col("seq") == 0, "s"))
    rec = project_records(df, "l=%level", "off", "%msg", keep=["shard"])
    assert sorted(values(static_labels(rec, keys=["shard"]), "seq")) == [0, 1, 2]
    assert values(static_labels(rec, keys=["shard"]).where("seq = 2"), "labels") == [{"l": "WARN"}]


def test_unknown_word_is_refused(spark):
    with pytest.raises(ValueError):
        project_records(three_events(spark), "a=%nosuch", "off")


@pytest.mark.parametrize(
    "name, n, want",
    [
        ("eu.shop.Basket", -1, "eu.shop.Basket"), ("eu.shop.Basket", 0, "Basket"), ("eu.shop.Basket", 1, "e.s.Basket"),
        ("eu.shop.Basket", 12, "e.s.Basket"), ("eu.shop.Basket", 13, "e.shop.Basket"), ("eu.shop.Basket", 14, "e.shop.Basket"),
        ("eu.shop.Basket", 15, "eu.shop.Basket"), ("Basket", 3, "Basket"), ("Basket", 0, "Basket"), ("a.b.C", 1, "a.b.C"),
    ],
)
def test_logger_names(spark, name, n, want):
    assert values(lit(spark, name).select(abbreviate("s", n).alias("x")), "x") == [want]


def test_blank_and_length(spark):
    blanks = [None, "", " ", "\t\r\n\x0b\x0c", "\x1c\x1f", "\u2003\u3000\u2028"]
    full = ["a", "\u00a0", "\u2007", "\u202f", "\x00", " \n x"]
    df = spark.createDataFrame([(s,) for s in blanks + full], "s string")
    assert values(df.select(is_blank("s").alias("b")), "b") == [True] * len(blanks) + [False] * len(full)
    # one character of every UTF-8 width, and every code point of the first plane
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000] + ["\U0001F3C1", "\U0010FFFF"]
    df = spark.createDataFrame([(c,) for c in chars], "s string")
    assert df.filter(utf8_len("s") != F.length(F.encode("s", "UTF-8"))).count() == 0
    assert values(df.agg(F.sum(utf8_len("s")).alias("n")), "n") == [sum(len(c.encode()) for c in chars)]


def test_stream_key_ignores_order(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},), ({"b": "2", "a": "1"},)], "m map<string,string>")
    assert df.select(stream_key("m").alias("k")).distinct().count() == 1


def test_record_time(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as ts, timestamp_ntz'1969-12-31 23:59:59.999001' as old")
    ms, nanos = record_time("ts")
    assert df.select(ms, nanos, wire_time(ms, nanos)).collect()[0][:] == (1704067207179, 575000, "1704067207179575000")
    assert df.select(*record_time("old")).collect()[0][:] == (-1, 1000)
