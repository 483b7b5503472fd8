import math

import pytest
from pyspark.sql import functions as F, types as T

from deq.functions.names import (
    check_ident,
    check_type_name,
    duration_seconds,
    is_narrowing,
    normalize_type,
    parse_duration,
    replace_identifier,
    spark_type,
    sql_type_name,
    strip_identifier,
    truncate_precision,
)
from deq.functions.payload import validate_avro_fields, validate_json, validate_syntax
from deq.functions.text import json_value, number_text

DURATIONS = {
    "30d": 2_592_000,
    "7d": 604_800,
    "1h": 3600,
    "30m": 1800,
    "1h30m": 5400,
    "1.5h": 5400,
    "1500ms": 1,
    "-1.5s": -1,
    "-2d": -172_800,
    ".5m": 30,
    "999us": 0,
    "0": 0,
}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def mapped(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_durations(spark):
    assert {t: parse_duration(t) for t in DURATIONS} == DURATIONS
    assert mapped(column(spark, list(DURATIONS)), duration_seconds(F.col("v"))) == list(DURATIONS.values())


@pytest.mark.parametrize("text", ["", "d", "1", "1x", "h1", "1h 2m", "1d2h", "ten"])
def test_bad_durations(spark, text):
    with pytest.raises(ValueError):
        parse_duration(text)
    assert mapped(column(spark, [text]), duration_seconds(F.col("v"))) == [None]


def test_identifiers():
    assert check_ident("raw.users") == "raw.users"
    for bad in ("", "1a", "a-b", "a;b", "a b", "a\n"):
        with pytest.raises(ValueError):
            check_ident(bad)
    with pytest.raises(ValueError):
        check_ident("raw.users", strict=True)


def test_sanitized_names(spark):
    df = column(spark, ["cpu.load-1", "übung", "ok_1"])
    assert mapped(df, strip_identifier(F.col("v"))) == ["cpuload1", "bung", "ok_1"]
    assert mapped(df, replace_identifier(F.col("v"))) == ["cpu_load_1", "_bung", "ok_1"]


def test_type_names(spark):
    df = column(spark, ["VARCHAR", " int8 ", "varchar(255)", "numeric(10,2)", "text", "TimestampTZ"])
    assert mapped(df, normalize_type(F.col("v"))) == [
        "character varying",
        "bigint",
        "character varying",
        "numeric(10,2)",
        "text",
        "timestamp with time zone",
    ]
    assert spark_type("numeric(12,2)") == T.DecimalType(12, 2)
    assert spark_type("int[]") == T.ArrayType(T.IntegerType())
    assert spark_type("varchar(20)") == T.StringType()
    assert sql_type_name(spark_type("timestamptz")) == "timestamp with time zone"
    for bad in ("", "int; DROP", "varchar(x)", "no_such_type"):
        with pytest.raises(ValueError):
            spark_type(bad)
    with pytest.raises(ValueError):
        check_type_name("1int")


@pytest.mark.parametrize(
    ("a", "b", "narrow"),
    [
        ("varchar(100)", "varchar(255)", False),
        ("varchar(255)", "character varying(100)", True),
        ("INT", "bigint", False),
        ("bigint", "int4", True),
        ("int", "int4", False),
        ("float", "double precision", False),
        ("double precision", "numeric", False),
        ("text", "varchar(10)", True),
        ("int", "text", True),
    ],
)
def test_narrowing(spark, a, b, narrow):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(is_narrowing(F.col("a"), F.col("b"))).first()[0] is narrow


def test_precision(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:01.234567' AS ts")
    text = {p: str(df.select(truncate_precision(F.col("ts"), p).cast("timestamp_ntz")).first()[0]) for p in ("s", "ms", "us", "ns")}
    assert text == {
        "s": "2024-01-01 00:00:01",
        "ms": "2024-01-01 00:00:01.234000",
        "us": "2024-01-01 00:00:01.234567",
        "ns": "2024-01-01 00:00:01.234567",
    }


def test_number_text(spark):
    values = {
        1.0: "1",
        -0.5: "-0.5",
        14.56: "14.56",
        12345678.25: "12345678.25",
        0.0001: "0.0001",
        0.00001: "1e-05",
        -2.5e-7: "-2.5e-07",
        1e20: "100000000000000000000",
        1.5e21: "1.5e+21",
        0.0: "0",
        math.inf: "+Inf",
        -math.inf: "-Inf",
    }
    assert mapped(column(spark, list(values), "double"), number_text(F.col("v"))) == list(values.values())
    assert mapped(column(spark, [math.nan, None], "double"), number_text(F.col("v"))) == ["NaN", None]


def verdicts(df):
    return [(r["valid"], r["error"]) for r in df.orderBy("i").collect()]


PAYLOADS = ['{"k": 1}', '{"k": null, "x": 2}', '{"x": {"k": 1}}', "[1]", "3", "not json", "", None]


def test_required_names(spark):
    df = column(spark, PAYLOADS)
    lost, other, broken = (False, "missing required fields: k"), (False, "expected JSON object"), (False, "invalid JSON payload")
    schema = '{"type": "object", "required": ["k"]}'
    assert verdicts(validate_json(df, "v", schema)) == [(True, None), (True, None), lost, other, other, broken, broken, broken]
    two = validate_json(df.limit(1), "v", '{"required": ["k", "x", "y"]}')
    assert verdicts(two) == [(False, "missing required fields: x y")]


@pytest.mark.parametrize("schema", ["not a schema", "{}", '{"required": "k"}', "[]"])
def test_schemas_that_ask_for_nothing(spark, schema):
    assert [v for v, _ in verdicts(validate_json(column(spark, PAYLOADS), "v", schema))] == [True] * 5 + [False] * 3


def test_an_empty_required_list_still_asks_for_an_object(spark):
    assert [v for v, _ in verdicts(validate_json(column(spark, PAYLOADS), "v", '{"required": []}'))] == [True] * 3 + [False] * 5


def test_record_fields(spark):
    record = '{"type": "record", "fields": [{"name": "k"}, {"name": "x"}]}'
    found = verdicts(validate_avro_fields(column(spark, PAYLOADS), "v", record))
    assert found[:4] == [
        (False, "missing Avro fields: x"),
        (True, None),
        (False, "missing Avro fields: k"),
        (False, "expected JSON object"),
    ]


def test_syntax_only(spark):
    assert [v for v, _ in verdicts(validate_syntax(column(spark, PAYLOADS), "v"))] == [True] * 5 + [False] * 3


def test_small_numbers_keep_their_digits(spark):
    values = {0.00012345678901234567: "0.00012345678901234567", -0.00025: "-0.00025", 0.0012345678901234567: "0.0012345678901234567", 12345.5: "12345.5"}
    assert mapped(column(spark, list(values), "double"), number_text(F.col("v"))) == list(values.values())


def test_json_is_whole_and_may_repeat_names(spark):
    texts = {'{"k":1}': True, '{"k":1} xyz': False, '{"k":1,"k":2}': True, "1,2": False, "": False, " [1] ": True, "null": True, "1],[2": False}
    found = mapped(column(spark, list(texts), "string"), json_value(F.col("v")).isNotNull())
    assert dict(zip(texts, found)) == texts
