import os

import pytest
from model import as_table, play, random_rows, time_text
from pyspark.sql import functions as F

from tidemark.operators.lateness import classify_lateness, final_counts, latest_docs, refire_changelog
from tidemark.plans.report import Report, report_messages
from tidemark.settings import Timing
from tidemark.workspace import scratch

SMALL = Timing(window_ms=1000, delay_ms=200, lateness_ms=600)
BASE = 1_704_067_200_000

GOLDEN = ["00:00:05", "00:00:50", "00:01:15", "00:00:59", "00:01:41", "00:00:58", "00:01:01", "00:02:10"]
GOLDEN_CLASSES = ["ontime", "ontime", "ontime", "refire", "ontime", "late", "ontime", "ontime"]


@pytest.fixture
def golden(spark):
    texts = [
        (f'{{"dt":"2024-01-01 {time}","type":"login","username":"u","area":"NORTH"}}', n) for n, time in enumerate(GOLDEN)
    ]
    return spark.createDataFrame(texts, "value string, arrival bigint").withColumn("event_id", F.col("arrival"))


def test_golden(golden):
    report = report_messages(golden)
    classes = {row["event_id"]: row["lateness"] for row in report.classified.collect()}
    assert [classes[n] for n in range(8)] == GOLDEN_CLASSES
    assert {(row["time"], row["count"], row["fired"]) for row in report.counts.collect()} == {
        ("2024-01-01 00:01:00", 3, True),
        ("2024-01-01 00:02:00", 3, True),
        ("2024-01-01 00:03:00", 1, False),
    }
    assert [row["value"] for row in report.late.collect()] == ["1704067258000\tlogin\tNORTH"]
    changes = report.changelog.orderBy("emitted_at").collect()
    assert [(row["time"][11:], row["count"], row["emitted_at"]) for row in changes] == [
        ("00:01:00", 2, 2),
        ("00:01:00", 3, 3),
        ("00:02:00", 3, 7),
    ]
    upserted = {row["doc_id"]: row["document"] for row in report.upserted.collect()}
    assert upserted == {
        "2024-01-01_00:01:00-login-NORTH": '{"time":"2024-01-01 00:01:00","type":"login","area":"NORTH","count":3}',
        "2024-01-01_00:02:00-login-NORTH": '{"time":"2024-01-01 00:02:00","type":"login","area":"NORTH","count":3}',
    }


CASES = {
    "in order of arrival": dict(seed=1),
    "equal arrivals": dict(seed=2, ties=True),
    "one window wide": dict(seed=3, span_ms=3_000),
    "far apart": dict(seed=4, span_ms=400_000),
}


@pytest.mark.parametrize("case", CASES)
def test_against_the_row_by_row_account(spark, case):
    rows = random_rows(low=BASE, **CASES[case])
    classes, counts, emissions = play(rows, SMALL)
    classified = classify_lateness(as_table(spark, rows), SMALL)
    assert {row["event_id"]: row["lateness"] for row in classified.collect()} == classes
    if case == "in order of arrival":
        assert set(classes.values()) == {"ontime", "refire", "late"}

    ends = {key[:3] for key in emissions}
    # Windows a second wide have texts of their own, so texts compare as well as moments.
    expected = {(time_text(end), kind, area, n, (end, kind, area) in ends) for (end, kind, area), n in counts.items()}
    assert {tuple(row) for row in final_counts(classified).collect()} == expected

    changes = refire_changelog(classified)
    assert sorted(map(tuple, changes.collect())) == [(time_text(end), *rest) for end, *rest in emissions]
    upserted = Report(classified, None).upserted.select("time", "type", "area", "count")
    assert sorted(map(tuple, upserted.collect())) == sorted(map(tuple, latest_docs(changes).collect()))


@pytest.mark.parametrize("sources, ties", [(1, False), (3, False), (3, True), (5, False)])
def test_each_source_has_its_watermark(spark, sources, ties):
    """Source 2 runs 4 s behind the others."""
    source_of = lambda number: number % sources
    rows = [(n, a, ms - 4000 * (source_of(n) == 2), k, area) for n, a, ms, k, area in random_rows(7, low=BASE, ties=ties)]
    classes, counts, emissions = play(rows, SMALL, source_of=source_of, sources=sources)
    table = as_table(spark, rows).withColumn("source", F.col("event_id") % sources)
    classified = classify_lateness(table, SMALL, source="source", sources=sources)
    assert {row["event_id"]: row["lateness"] for row in classified.collect()} == classes
    assert len(set(classes.values())) > 1
    ends = {key[:3] for key in emissions}
    expected = {(time_text(end), kind, area, n, (end, kind, area) in ends) for (end, kind, area), n in counts.items()}
    assert {tuple(row) for row in final_counts(classified).collect()} == expected
    assert sorted(map(tuple, refire_changelog(classified).collect())) == [(time_text(end), *rest) for end, *rest in emissions]


def test_a_source_without_rows_holds_back(spark):
    rows = random_rows(8, low=BASE)
    classified = classify_lateness(as_table(spark, rows).withColumn("source", F.lit(1)), SMALL, source="source", sources=2)
    assert {row["lateness"] for row in classified.collect()} == {"ontime"}
    assert refire_changelog(classified).collect() == []


@pytest.mark.parametrize("wrong", [None, 2, -1])
def test_a_source_that_is_none_ends_the_job(spark, wrong):
    rows = as_table(spark, random_rows(9, n=5, low=BASE)).withColumn("source", F.lit(wrong).cast("int"))
    with pytest.raises(Exception, match="not a source below 2"):
        classify_lateness(rows, SMALL, source="source", sources=2).collect()


def test_rows_before_the_epoch(spark):
    """The watermark starts 10 s before the epoch, so rows older than that are late at once."""
    rows = [(0, 0, -100_000, "a", "A"), (1, 1, -5_000, "a", "A"), (2, 2, 30_000, "a", "A"), (3, 3, -61_000, "a", "A")]
    classified = classify_lateness(as_table(spark, rows))
    assert {row["event_id"]: row["lateness"] for row in classified.collect()} == play(rows, Timing())[0]


def test_all_at_once(spark):
    rows = as_table(spark, [(n, 0, BASE + ms, "a", "A") for n, ms in enumerate((0, 999, 1000, 1799, 1800, 5000))])
    seen = BASE + 1799 + 1000
    classified = classify_lateness(rows, SMALL, arrival=None, seen_ms=seen)
    got = [row["lateness"] for row in classified.orderBy("event_id").collect()]
    # Window ends at 1 s and 2 s have closed (seen >= end + 799); the one at 2 s only just, at 2.799 s.
    assert got == ["late", "late", "late", "late", "late", "ontime"]
    earlier = classify_lateness(rows, SMALL, arrival=None, seen_ms=seen - 1)
    assert [row["lateness"] for row in earlier.orderBy("event_id").collect()] == ["late"] * 2 + ["refire"] * 3 + ["ontime"]


def test_arrival_may_be_a_struct(spark):
    rows = random_rows(5, n=200, low=BASE)
    table = as_table(spark, rows).withColumn("arrival", F.struct((F.col("arrival") / 10).cast("long"), "event_id"))
    classified = classify_lateness(table, SMALL)
    assert {row["event_id"]: row["lateness"] for row in classified.collect()} == play(rows, SMALL)[0]


def test_many_windows_are_not_broadcast(spark):
    rows = random_rows(6, low=BASE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        classified = classify_lateness(as_table(spark, rows), SMALL, max_broadcast=0)
        plan = classified._jdf.queryExecution().executedPlan().toString()
        got = {row["event_id"]: row["lateness"] for row in classified.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_salt" in plan
    assert got == play(rows, SMALL)[0]


def test_finished_batch_report_leaves_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.workspace.shared_folder", lambda spark: str(tmp_path))
    texts = spark.createDataFrame([('{"dt":"2024-01-01 00:00:01","type":"a","area":"b"}', 1)], "value string, arrival bigint")
    with scratch(spark):
        assert report_messages(texts).counts.count() == 1
    assert os.listdir(tmp_path / "tidemark") == []


def test_no_rows(spark):
    classified = classify_lateness(as_table(spark, []))
    assert classified.collect() == []
    assert refire_changelog(classified).collect() == []
