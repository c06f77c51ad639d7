import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_spans
from tidemark.functions.json_text import is_broken, put_fields, read_fields
from tidemark.functions.texts import document_id, split_codes, tab_line
from tidemark.functions.times import format_ms, parse_time, window_number


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"dt":"x","n":3}', ("x", "3", False)),
        ("{'dt':'x'}", ("x", None, False)),
        ('{dt:"x"}', ("x", None, False)),
        ('{"dt":null}', (None, None, False)),
        ('{"dt":{"a":1}}', ('{"a":1}', None, False)),
        ('{"dt":"x"', (None, None, True)),
        ("nonsense", (None, None, True)),
        ("null", (None, None, True)),
        ('{"dt":"x"}{"dt":"y"}', (None, None, True)),
        ('{"dt":"x"},{"dt":"y"}', (None, None, True)),
        ('{"dt":"x"},{}', (None, None, True)),
        ('{"dt":"x"} zzz', (None, None, True)),
        ('{"dt":"x"}]', (None, None, True)),
        ('{"dt":"x","dt":"y"}', ("y", None, False)),
        ("[1]", (None, None, True)),
        ("", (None, None, True)),
        (None, (None, None, True)),
    ],
)
def test_read_fields(values, text, expected):
    parsed = values(text).select(read_fields("value", "dt string, n string").alias("p"))
    row = parsed.select("p.dt", "p.n", is_broken("p").alias("broken")).first()
    assert (row["broken"], None if row["broken"] else row["dt"]) == (expected[2], expected[0])
    assert row["n"] == expected[1]


def put(values, text, **new):
    column = put_fields(F.col("value"), {name: F.lit(value).cast("string") for name, value in new.items()})
    return values(text).select(column).first()[0]


def test_put_fields_keeps_unknown_and_nested_fields(values):
    text = '{"s":"a \\"b\\" ü","n":1.5,"flag":true,"gone":null,"deep":{"l":[1,{"x":"y"}]},"area":"old","dt":5}'
    got = json.loads(put(values, text, area="A", dt="t"))
    assert got == {"s": 'a "b" ü', "n": 1.5, "flag": True, "deep": {"l": [1, {"x": "y"}]}, "area": "A", "dt": "t"}


@pytest.mark.parametrize("more", ["", ',"old":1', ',"gone":null', ',"n":1', ',"area":2'])
def test_put_fields_keeps_the_text_of_numbers(values, more):
    numbers = '"a":123456789012345678901234567890123456789012345,"b":0.30,"c":-1e400,"d":[1.50,"x 0.10, y: 2"]'
    got = put(values, "{" + numbers + more + "}", area="A")
    assert numbers in got and got.endswith('"area":"A"}') and json.loads(got)["area"] == "A"


def test_repeated_field_keeps_the_last(values):
    assert json.loads(put(values, '{"type":"a","type":"b"}', area="A")) == {"type": "b", "area": "A"}


def test_put_null_removes_the_field(values):
    assert json.loads(put(values, '{"a":1,"area":"old"}', area=None)) == {"a": 1}


def test_put_into_no_object(values):
    assert [put(values, text, area="A") for text in ("[1]", "7", '"x"', "{", "null")] == [None] * 5


@pytest.mark.parametrize(
    "text, ms",
    [
        ("2024-01-01 00:00:05", 1704067205000),
        ("1970-01-01 00:00:00", 0),
        ("1969-12-31 23:59:59", -1000),
        ("2024-13-01 00:00:00", None),
        ("2024-02-30 00:00:00", None),
        ("2024-01-01 00:00:05 and more", None),
        ("2019-8-2 3:3:1", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, ms):
    assert one(spark, F.unix_millis(parse_time(F.lit(text).cast("string")))) == ms


@pytest.mark.parametrize(
    "text, plain",
    [
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-1-2 3:4:5", "2024-01-02 03:04:05"),
        ("2024-13-01 00:00:00", "2025-01-01 00:00:00"),
        ("2024-00-10 00:00:00", "2023-12-10 00:00:00"),
        ("2024-02-30 00:00:00", "2024-03-01 00:00:00"),
        ("2023-02-29 00:00:00", "2023-03-01 00:00:00"),
        ("2024-03-00 00:00:00", "2024-02-29 00:00:00"),
        ("2024-01-32 24:60:60", "2024-02-02 01:01:00"),
        ("2024-01-01 00:00:86400", "2024-01-02 00:00:00"),
        ("  2024-\t01- 02  3: 4: 5", "2024-01-02 03:04:05"),
        ("2024-01-02 03:04:05.678 and more", "2024-01-02 03:04:05"),
        ("9999-12-31 23:59:59", "9999-12-31 23:59:59"),
        ("9999-12-31 23:59:60", None),
        ("0001-01-01 00:00:00", "0001-01-01 00:00:00"),
        ("0001-00-01 00:00:00", None),
        ("0000-13-01 00:00:00", "0001-01-01 00:00:00"),
        ("999999999-999999999-999999999 999999999:999999999:999999999", None),
        ("2024-01-01 00:00:9999999999", None),
        ("2024--1-02 03:04:05", None),
        ("2024-01-02T03:04:05", None),
        ("2024-01-02 03:04", None),
        ("x2024-01-02 03:04:05", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_lenient_time(spark, text, plain):
    assert one(spark, F.date_format(parse_time(F.lit(text).cast("string"), lenient=True), "yyyy-MM-dd HH:mm:ss")) == plain


def test_lenient_time_of_a_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for text in ("2024-07-01 12:00:00", "2024-03-10 02:30:00", "2024-11-03 01:30:00"):
            same = F.unix_millis(parse_time(F.lit(text), lenient=True)) == F.unix_millis(parse_time(F.lit(text)))
            assert one(spark, same)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_format_ms(spark):
    assert one(spark, format_ms(F.lit(1704067205999))) == "2024-01-01 00:00:05"


@pytest.mark.parametrize("ms, shift, number", [(0, 0, 0), (59999, 0, 0), (60000, 0, 1), (-1, 0, -1), (-60000, 0, -1), (70000, 10001, 0)])
def test_window_number(spark, ms, shift, number):
    assert one(spark, window_number(F.lit(ms).cast("long"), 60000, shift)) == number


@pytest.mark.parametrize(
    "codes, parts",
    [
        ("NL", ["NL"]),
        ("BQ,CW", ["BQ", "CW"]),
        (" BQ, CW", [" BQ", " CW"]),
        ("LU,MC,,", ["LU", "MC"]),
        (",NL", ["", "NL"]),
        ("a,,b", ["a", "", "b"]),
        ("", [""]),
        (",,", []),
    ],
)
def test_split_codes(spark, codes, parts):
    assert one(spark, split_codes(F.lit(codes))) == parts


def test_tab_line_prints_null(spark):
    assert one(spark, tab_line(F.lit(5), F.lit(None), F.lit("a"))) == "5\tnull\ta"


def test_document_id(spark):
    assert one(spark, document_id(F.lit("2024-01-01 00:01:00"), F.lit("login"), F.lit("NORTH"))) == "2024-01-01_00:01:00-login-NORTH"


@pytest.mark.parametrize(
    "text, members, elements",
    [
        ('{"a":1, "b" : [1,{"c":"}"}] }', ['"a":1', '"b" : [1,{"c":"}"}]', "}"], []),
        (" { } ", ["}"], []),
        ("}", [], []),
        ('{"a":1,}', ['"a":1'], []),
        ('{"a":1} x', ['"a":1'], []),
        ('[1, "]" ,[2]] ', [], ["1", '"]"', "[2]", "]"]),
        ("[ ]", [], ["]"]),
        ("]", [], []),
        ("[1,]", [], ["1"]),
    ],
)
def test_members_and_elements_end_with_what_closes_the_text(spark, text, members, elements):
    assert one(spark, json_spans.members(F.lit(text))) == members
    assert one(spark, json_spans.all_elements(F.lit(text))) == elements
