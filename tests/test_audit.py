import pytest
from pyspark.sql import functions as F

from tidemark.operators.audit import bad_rows, good_rows, late_lines, parse_audit

GOOD = '{"dt":"2024-01-01 10:11:22","type":"login","username":"u1","area":"NORTH"}'
EPOCH = '{"dt":"1970-01-01 00:00:00","type":"login","area":"NORTH"}'
BEFORE = '{"dt":"1969-12-31 23:59:59","type":"login","area":"NORTH"}'
DEFECTS = {
    '{"dt":"bad","type":"login","area":"NORTH"}': "bad_time",
    '{"type":"login","area":"NORTH"}': "bad_time",
    '{"dt":"2024-13-01 00:00:00","type":"login","area":"NORTH"}': "bad_time",
    '{"dt":"2024-01-01 10:11:22","area":"NORTH"}': "no_type",
    '{"dt":"2024-01-01 10:11:22","type":"login","area":null}': "no_area",
    '{"dt":"2024-01-01 10:11:22"': "malformed_json",
    "[1]": "malformed_json",
    EPOCH: "excluded_time",
}


def test_good_row(values):
    rows = good_rows(parse_audit(values(GOOD)))
    assert rows.columns == ["event_time", "type", "area"]
    assert tuple(rows.select(F.unix_millis("event_time"), "type", "area").first()) == (1704103882000, "login", "NORTH")


def test_every_defect_has_its_reason(values):
    parsed = parse_audit(values(GOOD, *DEFECTS))
    assert {row["value"]: row["reason"] for row in bad_rows(parsed).collect()} == DEFECTS
    assert good_rows(parsed).count() == 1


@pytest.mark.parametrize("times, kept", [("positive", [1704103882000]), ("nonzero", [-1000, 1704103882000])])
def test_times(values, times, kept):
    rows = good_rows(parse_audit(values(GOOD, EPOCH, BEFORE), times))
    assert sorted(row[0] for row in rows.select(F.unix_millis("event_time")).collect()) == kept


def test_unknown_times(values):
    with pytest.raises(ValueError):
        parse_audit(values(GOOD), "all")


def test_other_columns_pass_through(values):
    parsed = parse_audit(values(GOOD).withColumn("arrival", F.lit(7)))
    assert good_rows(parsed).first()["arrival"] == 7


def test_late_line(values):
    assert late_lines(good_rows(parse_audit(values(GOOD)))).first()["value"] == "1704103882000\tlogin\tNORTH"
