import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.json_text import read_flat
from tidemark.operators import clean
from tidemark.operators.areas import invert_areas
from tidemark.operators.joins import lookup_join
from tidemark.plans.clean import clean_messages

FIELDS = "type string, score double, level string"


@pytest.fixture
def dim(spark):
    return invert_areas(spark.createDataFrame([("NORTH", "NL"), ("EAST", "BQ,CW")], "area string, codes string"))


def envelope(country="NL", dt="2024-01-01 00:00:00", data=({"type": "tea", "score": 0.3, "level": "A"},), **more):
    return json.dumps({"dt": dt, "countryCode": country, "data": data and list(data), **more})


def texts(df):
    return sorted((json.loads(row["value"]) for row in df.collect()), key=str)


@pytest.mark.parametrize("fields", [FIELDS, None])
@pytest.mark.parametrize("default, expected", [(None, None), ("other", "other")])
def test_unmapped_country(values, dim, fields, default, expected):
    messages = values(envelope("NL"), envelope("CW"), envelope("XX"), envelope(None))
    records = texts(clean_messages(messages, dim, default, fields).json)
    areas = sorted(str(record.get("area")) for record in records)
    assert areas == sorted(["NORTH", "EAST", str(expected), str(expected)])
    assert all(("area" in record) == (record.get("area") is not None) for record in records)


@pytest.mark.parametrize("fields", [FIELDS, None])
def test_one_record_per_item(values, dim, fields):
    items = [{"type": "tea", "score": 0.3, "level": "A"}, {"type": "ink", "score": 0.1, "level": "B"}]
    records = texts(clean_messages(values(envelope(data=items)), dim, None, fields).json)
    added = {"area": "NORTH", "dt": "2024-01-01 00:00:00"}
    assert records == sorted(({**item, **added} for item in items), key=str)


def test_columns(values, dim):
    rows = clean_messages(values(envelope()), dim, None, FIELDS).columns
    assert rows.columns == ["type", "score", "level", "area", "dt"]
    assert tuple(rows.first()) == ("tea", 0.3, "A", "NORTH", "2024-01-01 00:00:00")


@pytest.mark.parametrize("fields", [FIELDS + ", area string", None])
def test_area_of_the_item_is_overwritten(values, dim, fields):
    messages = values(envelope(data=[{"type": "tea", "area": "old"}]), envelope("XX", data=[{"type": "ink", "area": "old"}]))
    records = texts(clean_messages(messages, dim, None, fields).json)
    assert {record["type"]: record.get("area") for record in records} == {"tea": "NORTH", "ink": None}


def test_open_items_keep_everything(values, dim):
    item = {"type": "tea", "more": {"a": [1, 2, {"b": None}]}, "flag": False, "text": 'say "hi"', "gone": None}
    (record,) = texts(clean_messages(values(envelope(data=[item])), dim).json)
    assert record == {
        "type": "tea",
        "more": {"a": [1, 2, {"b": None}]},
        "flag": False,
        "text": 'say "hi"',
        "area": "NORTH",
        "dt": "2024-01-01 00:00:00",
    }


@pytest.mark.parametrize("fields", [FIELDS, None])
def test_empty_data_and_missing_time(values, dim, fields):
    cleaned = clean_messages(values(envelope(data=()), envelope(dt=None)), dim, None, fields)
    (record,) = texts(cleaned.json)
    assert "dt" not in record
    assert cleaned.bad.collect() == []


@pytest.mark.parametrize("fields", [FIELDS, None])
def test_bad_input_goes_to_bad(values, dim, fields):
    good = {"type": "tea", "score": 0.3, "level": "A"}
    messages = values("{", envelope(data=None), '{"countryCode":"NL"}', envelope(data=[good, None]))
    cleaned = clean_messages(messages, dim, None, fields)
    assert len(texts(cleaned.json)) == 1
    assert sorted(row["reason"] for row in cleaned.bad.collect()) == ["bad_item", "malformed_json", "no_data", "no_data"]


def test_wrong_type_rejects_one_item_only(values, dim):
    good = {"type": "tea", "score": 0.3, "level": "A"}
    cleaned = clean_messages(values(envelope(data=[good, {"type": "ink", "score": "high"}])), dim, None, FIELDS)
    assert [record["type"] for record in texts(cleaned.json)] == ["tea"]
    assert [tuple(row) for row in cleaned.bad.collect()] == [('{"type":"ink","score":"high"}', "bad_item")]


@pytest.mark.parametrize("fields", [FIELDS, None])
@pytest.mark.parametrize("after", ["{}", " zzz", "]", ",{}"])
def test_no_text_is_lost(values, dim, fields, after):
    cleaned = clean_messages(values(envelope() + after, envelope()), dim, None, fields)
    assert len(texts(cleaned.json)) == 1
    assert [tuple(row) for row in cleaned.bad.collect()] == [(envelope() + after, "malformed_json")]


@pytest.mark.parametrize("fields", [FIELDS, None])
def test_repeated_field_of_an_item(values, dim, fields):
    text = '{"dt":"t","countryCode":"NL","data":[{"type":"a","type":"b"}]}'
    assert texts(clean_messages(values(text), dim, None, fields).json) == [{"type": "b", "area": "NORTH", "dt": "t"}]


def test_open_item_that_is_no_object(values, dim):
    cleaned = clean_messages(values(envelope(data=[5, "x", {"type": "tea"}])), dim)
    assert len(texts(cleaned.json)) == 1
    assert sorted((row["value"], row["reason"]) for row in cleaned.bad.collect()) == [("5", "bad_item"), ("x", "bad_item")]


def test_large_dimension_is_not_broadcast(spark, values, dim):
    messages = values(*[envelope("NL") for _ in range(40)], *[envelope(c) for c in ("CW", "XX", "BQ")])
    envelopes = clean.parse_envelopes(messages, FIELDS)
    beyond = clean.enrich(envelopes, dim, None, max_broadcast=0)
    assert sorted(map(str, beyond.collect())) == sorted(map(str, clean.enrich(envelopes, dim, None).select(*beyond.columns).collect()))


def test_hot_key_is_spread_and_cold_keys_are_not_repeated(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 10 > 0, -1).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(-1, 5_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = lookup_join(rows, table, "k", max_broadcast=0, rows_per_salt=200)
        parts = joined.where("k = -1").groupBy(F.spark_partition_id()).count().count()
        assert parts > 8
        assert joined.count() == 10_000 and joined.where("k >= 0 and k < 5000 and v = 2 * k").count() == 500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def written(df):
    return [row["value"] for row in df.collect()]


def test_open_items_pass_through_as_they_are_written(values, dim):
    """Signs of the private use area, numbers that no type holds, spaces, escapes and long texts."""
    items = [
        '{"a":"x\ue000y\ue001","n":0.30,"e":1.5e400}',
        '{ "n" : -0.0 , "s" : "\\" 1.50, {\\" " }',
        '{"s":"' + "ab\\n" * 20_000 + '","n":1.10}',
        '{"d":' + "[" * 90 + "1.50" + "]" * 90 + "}",
        '{"q":"it\'s [1.0}","\\u0061rea":"kept?"}',
    ]
    text = '{"dt":"2024-01-01 00:00:00","countryCode":"NL","data":[' + " , ".join(items) + "]}"
    got = written(clean_messages(values(text), dim).json)
    put = ['"area":"NORTH","dt":"2024-01-01 00:00:00"'] * 5
    whole = [f"{items[0][:-1]},{put[0]}}}", f"{items[1][:-1]},{put[0]}}}", f"{items[2][:-1]},{put[0]}}}", f"{items[3][:-1]},{put[0]}}}"]
    assert sorted(got) == sorted([*whole, '{"q":"it\'s [1.0}",' + put[0] + "}"])


def test_an_open_field_is_cut_out_where_it_stands(values, dim):
    text = '{"dt":"2024-01-01 00:00:00","countryCode":"NL","data":[{"dt" : 0.30, "a":{"area":1.0,"x":null} ,"gone": null,"a":[2.50, null],"area":[{}]}]}'
    got = written(clean_messages(values(text), dim).json)
    assert got == ['{"a":[2.50, null],"area":"NORTH","dt":"2024-01-01 00:00:00"}']


def test_open_items_of_lenient_or_deep_texts(values, dim):
    """Single quotes and bare names are written anew, but for their numbers; so are very deep items."""
    deep = "[" * 150 + "1.5" + "]" * 150
    for data in ("[{'a':0.30,b:\"x\ue000\"}]", '[{"a":0.30,"b":"x\ue000"}, ' + deep + "]"):
        text = '{"dt":"2024-01-01 00:00:00",countryCode:"NL","data":' + data + "}"
        got = written(clean_messages(values(text), dim).json)
        assert got == ['{"a":0.30,"b":"x\ue000","area":"NORTH","dt":"2024-01-01 00:00:00"}']


def test_members_and_elements_of_odd_envelopes(values, dim):
    head = '{"dt":"2024-01-01 00:00:00","countryCode":"NL"'
    for text, records, reasons in [
        (head + ',"data":[]}', 0, []),
        (head + ',"data":[ ] , "data" : [ {} ] }', 1, []),
        (head + ',"data":{}}', 0, ["no_data"]),
        (head + ',"data":"[{}]"}', 0, ["no_data"]),
        (head + "}", 0, ["no_data"]),
        (head + ',"d\\u0061ta":[{"a":1.50}]}', 1, []),
        (head + ',"data":[null,[1],{"a":1}]}', 1, ["bad_item", "bad_item"]),
        (head + ',"data":[{"a":1}]}}', 0, ["malformed_json"]),
        (head + ',"data":[{"a":1]}', 0, ["malformed_json"]),
    ]:
        cleaned = clean_messages(values(text), dim)
        assert (cleaned.json.count(), sorted(r["reason"] for r in cleaned.bad.collect())) == (records, reasons), text


@pytest.mark.parametrize("fields", [FIELDS, None])
def test_outcomes_in_one_pass(values, dim, fields):
    good = {"type": "tea", "score": 0.3, "level": "A"}
    messages = values("{", envelope(data=None), envelope(data=[good, None]), envelope(data=()), envelope("XX"), envelope() + "]")
    cleaned = clean_messages(messages, dim, None, fields)
    found = sorted(r["outcome"] for r in cleaned.outcomes.collect())
    assert found == sorted(["record"] * cleaned.json.count() + [r["reason"] for r in cleaned.bad.collect()])
    assert found == ["bad_item", "malformed_json", "malformed_json", "no_data", "record", "record"]


ODD_ITEMS = [
    '{"type":"a","score":0.30,"level":"L"}',
    '{"type":1.50,"score":1,"level":null,"more":[{"a":1}]}',
    "{}",
    '{"type":1e400,"score":1e400,"level":{"a":1e400}}',
    '{"type":"\\"x","score":"NaN","level":"\\u0061"}',
    '{"type":"a","type":"b","score":"high"}',
    '{"score":"high","score":0.5}',
    '"{\\"type\\":\\"a\\"}"',
    '[{"type":"a"}]',
    "null",
    "5",
    "{type:'a',score:-0.0}",
]
ODD_ENDS = ["", "\n", " zzz", "]", "{}", ",{}", ",{}]", ',{}],"tidemark_texts":[{"dt":"x","data":[{}]}', ',"q":[{}', ',{}],"q":[{}']


def test_items_are_the_same_read_at_once_or_one_by_one(values, dim, monkeypatch):
    def text(data):
        return '{"dt":"t","countryCode":"NL","data":' + data + "}"

    texts = [text(f"[{item}]") for item in ODD_ITEMS] + [text(f"[{ODD_ITEMS[0]},{item}]") for item in ODD_ITEMS]
    texts += [text(data) for data in ("null", "[]", "{}", "5", '"[{}]"', "[{]", '[],"data":[{}]', '[{}],"data":null', '[{}],"dt":1e400')]
    texts += [text("[{}]") + end for end in ODD_ENDS] + ["", "[]", "{}", '{"countryCode":"NL","data":[{}]}']

    def found():
        cleaned = clean_messages(values(*texts), dim, "other", FIELDS)
        tables = (cleaned.columns, cleaned.json, cleaned.bad, cleaned.outcomes)
        return [sorted(map(repr, map(tuple, table.collect()))) for table in tables]

    at_once = found()
    flat = values(*texts).where(read_flat("value", "dt string, countryCode string", "data", FIELDS).isNotNull()).count()
    assert 8 < flat < len(texts) - 20
    monkeypatch.setattr(clean, "read_flat", lambda text, fields, name, of: F.lit(None).cast(f"struct<{fields}, {name} array<struct<{of}>>>"))
    assert found() == at_once


def test_fields_of_types_that_depend_on_the_text_are_read_one_by_one(values):
    text = envelope(data=[{"n": 1}])
    for kind, at_once in (("bigint", 1), ("decimal(38,20)", 0), ("float", 0)):
        assert values(text).where(read_flat("value", "dt string", "data", f"n {kind}").isNotNull()).count() == at_once
