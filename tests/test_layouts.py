import json

import pytest
from helpers import events, lit, values
from pyspark.sql import functions as F

from logbarge.functions import array_field, field, json_object, json_quote, json_value, raw_field
from logbarge.operators.layouts import FieldSpec, JsonLayout, MapSpec, format_json

E1 = {"ts_ms": 5000, "logger": "eu.shop.Basket", "thread": "worker-1", "message": "paid\t12.50\r\nthanks \"Ada\"\n"}
PAIRS = {"kvp": '{"qty":"3","sku":"b-17"}'}
MDC = {"mdc": {"qty": "3", "sku": "b-17"}}
NONE = JsonLayout().only()


def render(spark, event, layout):
    return values(events(spark, event).select(format_json(layout).alias("d")), "d")[0]


def q(text):
    return text.replace("'", '"')


def test_standard_fields(spark):
    assert render(spark, E1, JsonLayout()) == q(
        r"{'timestamp_ms':5000,'logger_name':'eu.shop.Basket','level':'INFO','thread_name':'worker-1',"
        r"'message':'paid\t12.50\r\nthanks \'Ada\'\n'}"
    )
    assert render(spark, E1, NONE) == "{}"
    layout = JsonLayout(logger=FieldSpec("class"), logger_length=12).only("logger", "level")
    assert render(spark, E1, layout) == q("{'class':'e.s.Basket','level':'INFO'}")
    assert render(spark, {**E1, "thread": None}, JsonLayout().only("thread")) == q("{'thread_name':null}")


def test_custom_fields_come_last(spark):
    layout = JsonLayout(custom=(field("is_long", F.length("message") > 4, "boolean"),)).only("message")
    assert render(spark, {"message": "stock"}, layout) == q("{'message':'stock','is_long':true}")


def test_stack_trace(spark):
    layout = JsonLayout().only("stack_trace")
    assert render(spark, {"stack_trace": "E: x\n\tat y"}, layout) == q(r"{'stack_trace':'E: x\n\tat y'}")
    assert render(spark, {}, layout) == "{}"
    layout = JsonLayout(trace=F.lit("short")).only("stack_trace")
    assert render(spark, {"stack_trace": "E"}, layout) == q("{'stack_trace':'short'}")


@pytest.mark.parametrize(
    "spec, want",
    [
        (MapSpec("kvp_"), "{'kvp_qty':'3','kvp_sku':'b-17'}"),
        (MapSpec("item.", include=("qty", "none")), "{'item.qty':'3'}"),
        (MapSpec("kvp_", no_prefix=True, exclude=("qty",)), "{'sku':'b-17'}"),
        (MapSpec("kvp_", include=("sku", "qty"), exclude=("sku",)), "{'kvp_qty':'3'}"),
        (MapSpec("kvp_", include=("none",)), "{}"),
    ],
)
def test_groups(spark, spec, want):
    assert render(spark, PAIRS, JsonLayout(kvp=spec).only("kvp")) == q(want)
    mdc = want.replace("kvp_", "mdc_") if spec.prefix == "kvp_" else want
    spec = spec if spec.prefix != "kvp_" else MapSpec("mdc_", True, spec.no_prefix, spec.include, spec.exclude)
    assert render(spark, MDC, JsonLayout(mdc=spec).only("mdc")) == q(mdc)


def test_same_name_twice(spark):
    layout = JsonLayout(mdc=MapSpec("", no_prefix=True), kvp=MapSpec("", no_prefix=True)).only("mdc", "kvp")
    event = {"mdc": {"a": "1"}, "kvp": '{"a":2}'}
    assert render(spark, event, layout) == q("{'a':'1','a':2}")


def test_serializer(spark):
    def both(name, value):
        return F.concat(json_quote(F.concat(F.lit("both_"), name)), F.lit(":{"), json_quote(name), F.lit(":"), json_value(value), F.lit("}"))

    layout = JsonLayout(kvp=MapSpec("k_", serializer=both)).only("kvp")
    assert render(spark, PAIRS, layout) == q("{'both_k_qty':{'k_qty':'3'},'both_k_sku':{'k_sku':'b-17'}}")


def test_list_of_structs(spark):
    rows = F.from_json(F.lit('[{"s":"b-17","n":3},{"s":null,"n":1}]'), "array<struct<s:string,n:int>>")
    fragment = array_field("items", rows, lambda r: json_object(field("sku", r["s"]), field("qty", r["n"], "number")))
    assert values(spark.range(1).select(json_object(fragment).alias("d")), "d") == [
        q("{'items':[{'sku':'b-17','qty':3},{'sku':null,'qty':1}]}")
    ]


@pytest.mark.parametrize(
    "text, want",
    [
        ('"red"', '"red"'), ("48", "48"), ("-7", "-7"), ("true", "true"), ("null", "null"), ("12.5", '"12.5"'),
        ('{"none":null,"sizes":[4,4.5]}', '{"none":null,"sizes":[4,4.5]}'), ('["red","blue"]', '["red","blue"]'),
        ("[4,8]", "[4,8]"), ("[]", "[]"), ("[1,2.5,[3.25,4]]", '[1,"2.5",["3.25",4]]'),
        ('["1.5",1.5,"a,2.5,b",-0.25]', '["1.5","1.5","a,2.5,b","-0.25"]'), ('"1.5"', '"1.5"'),
        ('["q\\"1.5",1.5]', '["q\\"1.5","1.5"]'), ('[{"x":1.5},2.5,[{"y":[0.5]},0.5]]', '[{"x":1.5},"2.5",[{"y":[0.5]},"0.5"]]'),
        ('[[[[[[{"x":1.5},2.5]]]]],"}"]', '[[[[[[{"x":1.5},"2.5"]]]]],"}"]'), ("9223372036854775807", "9223372036854775807"),
        ("9223372036854775808", '"9223372036854775808"'), ("[-12345678901234567890123,7]", '["-12345678901234567890123",7]'),
        ('"12345678901234567890123"', '"12345678901234567890123"'),
    ],
)
def test_typed_values(spark, text, want):
    df = lit(spark, text).select(F.parse_json("s").alias("v"))
    assert values(df.select(json_value("v").alias("j")), "j") == [want]


def test_typed_values_not_from_json(spark):
    df = spark.sql("""select to_variant_object(named_struct('d', date'2024-01-02', 'f', 1.5D, 'l', 9L,
        'a', array(0.5D, 2D))) as v""").select(F.map_entries(F.col("v").cast("map<string,variant>")).alias("kvp"))
    from logbarge.functions import kvp_fields

    got = values(df.select(json_object(kvp_fields("kvp", no_prefix=True)).alias("j")), "j")[0]
    assert got == '{"a":["0.5","2.0"],"d":"2024-01-02","f":"1.5","l":9}'


def test_raw_fields(spark):
    df = lit(spark, '{"sizes":[4,8],"note":"žluť"}')
    assert values(df.select(json_object(raw_field("raw", "s")).alias("j")), "j") == [
        '{"raw":{"sizes":[4,8],"note":"žluť"}}'
    ]
    assert values(lit(spark, None).select(json_object(raw_field("raw", "s")).alias("j")), "j") == ["{}"]
    assert values(lit(spark, "{oops").select(json_object(raw_field("raw", "s", checked=True)).alias("j")), "j") == ["{}"]


def test_quoting(spark):
    text = 'naïve "quotes" \\ slash/\t[tab]\nžluť {🚚}'
    assert values(lit(spark, text).select(json_quote("s").alias("j")), "j") == [
        '"naïve \\"quotes\\" \\\\ slash/\\t[tab]\\nžluť {🚚}"'
    ]
    every = "".join(chr(c) for c in range(0, 256)) + "[] "
    got = values(lit(spark, every).select(json_quote("s").alias("j")), "j")[0]
    assert json.loads(got) == every
    assert "\\u001F" in got and "\x7f" in got and "é" in got and "/" in got
    assert values(lit(spark, None).select(json_quote("s").alias("j")), "j") == ["null"]
    assert values(lit(spark, "[]").select(json_quote("s").alias("j")), "j") == ['"[]"']
