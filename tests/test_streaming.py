import json
import os
import random

import pytest
from model import play, random_rows, time_text
from pyspark.sql import functions as F

from tidemark.jobs import clean as clean_job
from tidemark.jobs import report as report_job
from tidemark.settings import Timing
from tidemark.sinks.writers import all_of, console_sink, documents, folder_sink, read_folder, read_upserted, upsert_sink
from tidemark.sources.areas import AreaSnapshots
from tidemark.sources.messages import kafka_messages, read_messages
from tidemark.streaming.clean import run_clean
from tidemark.streaming.replay import NOW, replay
from tidemark.streaming.report import ReportStep, run_report_builtin, run_report_exact

TEN = Timing(window_ms=10_000, delay_ms=2_000, lateness_ms=6_000)
BASE = 1_704_067_200_000
DOCS = "time string, type string, area string, count bigint, doc_id string, document string"


@pytest.fixture(scope="module")
def rows():
    made = random_rows(11, n=250, span_ms=90_000, low=BASE)
    rng = random.Random(1)
    held_back = [(n, a, ms - rng.choice([0, 0, 0, 9_000, 25_000]), kind, area) for n, a, ms, kind, area in made]
    return [(n, a, ms // 1000 * 1000, kind, area) for n, a, ms, kind, area in held_back]


def messages(spark, rows):
    texts = [
        (json.dumps({"dt": time_text(ms), "type": kind, "username": "u", "area": area}), arrival, number)
        for number, arrival, ms, kind, area in rows
    ]
    return spark.createDataFrame(texts, "value string, arrival bigint, n bigint")


def cuts(total, seed):
    rng = random.Random(seed)
    inner = sorted(rng.sample(range(1, total), 3))
    return list(zip([0, *inner], [*inner, total]))


def part_of(borders):
    """The batch of a message, by its number ``n``."""
    return sum((F.col("n") >= low).cast("int") for low, _ in borders[1:]) + F.lit(0)


def by_batch(rows, timing, borders):
    """Final counts, late lines, and per batch the documents it emits: the last count of each window."""
    classes, counts, emissions = play(rows, timing)
    docs = {}
    for end, kind, area, count, arrival in emissions:
        batch = next(n for n, (_, stop) in enumerate(borders) if arrival < stop)
        docs[batch, time_text(end), kind, area] = count
    # On-time rows that came after the firing arrival are none; but a window that fires in a batch
    # shows that batch's full count, which the last emission has.
    late = sorted(f"{row[2]}\t{row[3]}\t{row[4]}" for row in rows if classes[row[0]] == "late")
    return {(*key, count) for key, count in docs.items()}, late


def run_steps(spark, folder, rows, borders, **settings):
    late_sink = folder_sink(f"{folder}/late", "text", few_files=True)
    step = ReportStep(f"{folder}/state", folder_sink(f"{folder}/docs"), late_sink, folder_sink(f"{folder}/bad"), TEN, **settings)
    table = messages(spark, rows).persist()
    for batch_id, (start, stop) in enumerate(borders):
        step(table.where((F.col("n") >= start) & (F.col("n") < stop)), batch_id)
    table.unpersist()
    return step


def emitted(spark, folder):
    log = read_folder(spark, f"{folder}/docs", DOCS)
    return {(row["batch_id"], row["time"], row["type"], row["area"], row["count"]) for row in log.collect()}


def late(spark, folder):
    return sorted(row["value"] for row in read_folder(spark, f"{folder}/late", "value string", "text").collect())


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_whatever_the_cuts(spark, tmp_path, rows, seed):
    borders = cuts(len(rows), seed)
    run_steps(spark, tmp_path, rows, borders)
    docs, late_lines = by_batch(rows, TEN, borders)
    assert len(late_lines) > 5 and any(count > 1 for *_, count in docs)
    assert emitted(spark, tmp_path) == docs
    assert late(spark, tmp_path) == late_lines


@pytest.mark.parametrize("seed", [0, 1, 5])
def test_each_refire_whatever_the_cuts(spark, tmp_path, rows, seed):
    """The documents of all batches together are the row-by-row account's emissions, one by one."""
    run_steps(spark, tmp_path, rows, cuts(len(rows), seed), each_refire=True)
    _, _, emissions = play(rows, TEN)
    expected = sorted((time_text(end), kind, area, count) for end, kind, area, count, _ in emissions)
    log = read_folder(spark, f"{tmp_path}/docs", DOCS).select("time", "type", "area", "count").collect()
    assert sorted(map(tuple, log)) == expected
    assert len(expected) > len({row[:3] for row in expected}) + 5


def test_each_refire_of_a_replayed_batch(spark, tmp_path, rows):
    borders = cuts(len(rows), 2)
    step = run_steps(spark, tmp_path, rows, borders, each_refire=True)
    before = emitted(spark, tmp_path)
    start, stop = borders[2]
    step(messages(spark, rows[start:stop]), 2)
    assert emitted(spark, tmp_path) == before
    with pytest.raises(ValueError):
        ReportStep("s", None, None, None, label="max_event", each_refire=True)


def test_replayed_batch_changes_nothing(spark, tmp_path, rows):
    borders = cuts(len(rows), 2)
    step = run_steps(spark, tmp_path, rows, borders)
    before = emitted(spark, tmp_path), late(spark, tmp_path)
    state = sorted(map(str, spark.read.parquet(f"{tmp_path}/state/3").collect()))
    start, stop = borders[3]
    step(messages(spark, rows[start:stop]), 3)
    assert (emitted(spark, tmp_path), late(spark, tmp_path)) == before
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/state/3").collect())) == state


def test_without_arrival_a_batch_comes_at_once(spark, tmp_path, rows):
    borders = cuts(len(rows), 3)
    run_steps(spark, tmp_path, rows, borders, arrival=None)
    batch_of = {n: batch for batch, (start, stop) in enumerate(borders) for n in range(start, stop)}
    together = [(n, batch_of[n], ms, kind, area) for n, _, ms, kind, area in rows]
    docs, late_lines = by_batch(together, TEN, [(n, n + 1) for n in range(len(borders))])
    assert emitted(spark, tmp_path) == docs
    assert late(spark, tmp_path) == late_lines


@pytest.mark.parametrize("label", ["max_event", "last_event"])
def test_label_of_an_event(spark, tmp_path, rows, label):
    borders = [(0, 130), (130, len(rows))]
    run_steps(spark, tmp_path, rows, borders, label=label)
    classes, _, _ = play(rows, TEN)
    docs, _ = by_batch(rows, TEN, borders)
    expected = set()
    for batch, time, kind, area, count in docs:
        counted = [
            (arrival, ms)
            for number, arrival, ms, kind_, area_ in rows
            if classes[number] != "late"
            and (kind_, area_) == (kind, area)
            and time_text((ms // 10_000 + 1) * 10_000) == time
            and arrival < borders[batch][1]
        ]
        assert len(counted) == count
        ms = max(counted)[1] if label == "last_event" else max(ms for _, ms in counted)
        expected.add((batch, time_text(ms), kind, area, count))
    assert emitted(spark, tmp_path) == expected


def test_empty_and_bad_batches(spark, tmp_path, rows):
    step = run_steps(spark, tmp_path, rows, [(0, 0), (0, 120)])
    step(spark.createDataFrame([("{", 200)], "value string, arrival bigint"), 2)
    step(messages(spark, rows[120:]), 3)
    docs, late_lines = by_batch(rows, TEN, [(0, 0), (0, 120), (120, 120), (120, len(rows))])
    assert emitted(spark, tmp_path) == docs
    assert late(spark, tmp_path) == late_lines
    bad = read_folder(spark, f"{tmp_path}/bad", "value string, reason string").collect()
    assert [(row["value"], row["reason"], row["batch_id"]) for row in bad] == [("{", "malformed_json", 2)]


def test_batch_that_failed_half_way_is_run_again(spark, tmp_path, rows):
    borders = cuts(len(rows), 6)
    docs = folder_sink(f"{tmp_path}/docs")
    failures = {1, 2}

    def failing(df, batch_id):
        docs(df, batch_id)
        if batch_id in failures:
            failures.remove(batch_id)
            raise OSError("store not reachable")

    step = ReportStep(f"{tmp_path}/state", failing, folder_sink(f"{tmp_path}/late", "text"), folder_sink(f"{tmp_path}/bad"), TEN)

    def start():
        incoming = read_messages(spark, "parquet", True, "value string, arrival bigint", path=f"{tmp_path}/in")
        query = run_report_exact(incoming, step, f"{tmp_path}/checkpoint", NOW)
        try:
            query.awaitTermination()
        except Exception:
            query = run_report_exact(incoming, step, f"{tmp_path}/checkpoint", NOW)
        return query

    replay(messages(spark, rows), part_of(borders), len(borders), f"{tmp_path}/in", start)
    assert not failures
    expected, late_lines = by_batch(rows, TEN, borders)
    assert emitted(spark, tmp_path) == expected
    assert late(spark, tmp_path) == late_lines


@pytest.mark.parametrize("kind, arrival", [(1, 1_500_000), (0, None)])
def test_kafka_records(spark, kind, arrival):
    """Only a time set by the broker says when a record came."""
    moment = "timestamp'1970-01-01 00:00:01.5' AS timestamp"
    records = spark.sql(f"SELECT CAST('{{}}' AS binary) AS value, {moment}, {kind} AS timestampType, 3 AS offset")
    assert tuple(kafka_messages(records).first()) == ("{}", arrival)


def test_batch_without_arrivals_comes_at_once(spark, tmp_path, rows):
    """Records of a producer's clock: the same as with no arrival column at all."""
    borders = cuts(len(rows), 3)
    step = ReportStep(f"{tmp_path}/state", folder_sink(f"{tmp_path}/docs"), folder_sink(f"{tmp_path}/late", "text"), folder_sink(f"{tmp_path}/bad"), TEN)
    table = messages(spark, rows).withColumn("arrival", F.lit(None).cast("long"))
    for batch_id, (start, stop) in enumerate(borders):
        step(table.where((F.col("n") >= start) & (F.col("n") < stop)), batch_id)
    batch_of = {n: batch for batch, (start, stop) in enumerate(borders) for n in range(start, stop)}
    together = [(n, batch_of[n], ms, kind, area) for n, _, ms, kind, area in rows]
    docs, late_lines = by_batch(together, TEN, [(n, n + 1) for n in range(len(borders))])
    assert (emitted(spark, tmp_path), late(spark, tmp_path)) == (docs, late_lines)


def test_upsert_sink_holds_the_last_of_each_id(spark, tmp_path, rows):
    borders = cuts(len(rows), 4)
    sink = upsert_sink(f"{tmp_path}/now")
    step = ReportStep(f"{tmp_path}/state", sink, folder_sink(f"{tmp_path}/late", "text"), folder_sink(f"{tmp_path}/bad"), TEN)
    for batch_id, (start, stop) in enumerate(borders):
        step(messages(spark, rows[start:stop]), batch_id)
    step(messages(spark, rows[start:stop]), batch_id)  # run again
    last = {}
    for batch, time, kind, area, count in sorted(by_batch(rows, TEN, borders)[0]):
        last[time, kind, area] = count
    held = read_upserted(spark, f"{tmp_path}/now", DOCS).collect()
    assert len(held) == len(last) and {(r["time"], r["type"], r["area"]): r["count"] for r in held} == last
    assert len(os.listdir(tmp_path / "now/index")) <= 2


def test_lost_state_is_an_error(spark, tmp_path, rows):
    sinks = [folder_sink(f"{tmp_path}/{name}") for name in ("docs", "late", "bad")]
    step = ReportStep(f"{tmp_path}/state", *sinks, TEN)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        step(messages(spark, rows[:5]), 3)


def test_old_state_and_scratch_tables_go(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr("tidemark.workspace.shared_folder", lambda spark: str(tmp_path / "shared"))
    run_steps(spark, tmp_path, rows, cuts(len(rows), 4), keep=2)
    assert sorted(name for name in os.listdir(tmp_path / "state")) == ["2", "3"]
    assert os.listdir(tmp_path / "shared/tidemark") == []


def test_no_window_is_forgotten_without_delay_and_lateness(spark, tmp_path):
    """The newest row closes its own window here; the next batch must still know its time."""
    timing = Timing(window_ms=1000, delay_ms=0, lateness_ms=0)
    made = [(0, 0, BASE + 999, "a", "A"), (1, 1, BASE + 10, "a", "A")]
    table = spark.createDataFrame([("x", r[1]) for r in made], "value string, arrival bigint")
    docs, late_sink = folder_sink(f"{tmp_path}/docs"), folder_sink(f"{tmp_path}/late", "text")
    step = ReportStep(f"{tmp_path}/state", docs, late_sink, folder_sink(f"{tmp_path}/bad"), timing)
    second = F.when(F.col("arrival") == 0, "1").otherwise("0")
    text = F.concat(F.lit('{"dt":"2024-01-01 00:00:0'), second, F.lit('","type":"a","area":"A"}'))
    table = table.withColumn("value", text)
    step(table.where("arrival = 0"), 0)
    step(table.where("arrival = 1"), 1)
    assert late(spark, tmp_path) == [f"{BASE}\ta\tA"]


def test_stream_resumes_from_checkpoint(spark, tmp_path, rows):
    borders = cuts(len(rows), 5)
    late_sink, bad = folder_sink(f"{tmp_path}/late", "text"), folder_sink(f"{tmp_path}/bad")
    step = ReportStep(f"{tmp_path}/state", folder_sink(f"{tmp_path}/docs"), late_sink, bad, TEN)

    def start():
        incoming = read_messages(spark, "parquet", True, "value string, arrival bigint", path=f"{tmp_path}/in")
        return run_report_exact(incoming, step, f"{tmp_path}/checkpoint", NOW)

    replay(messages(spark, rows).repartition(3), part_of(borders), len(borders), f"{tmp_path}/in", start)
    docs, late_lines = by_batch(rows, TEN, borders)
    assert emitted(spark, tmp_path) == docs
    assert late(spark, tmp_path) == late_lines
    upserted = documents(read_folder(spark, f"{tmp_path}/docs", DOCS), "upsert").collect()
    assert len({row["doc_id"] for row in upserted}) == len(upserted)
    last = {}
    for batch, time, kind, area, count in sorted(docs):
        last[time, kind, area] = count
    assert {(row["time"], row["type"], row["area"]): row["count"] for row in upserted} == last


def test_builtin_watermark(spark, tmp_path, rows):
    in_order = sorted(rows, key=lambda row: row[2])
    in_order = [(n, n, *row[2:]) for n, row in enumerate(in_order)]

    def start():
        incoming = read_messages(spark, "parquet", True, "value string, arrival bigint", path=f"{tmp_path}/in")
        docs, bad = folder_sink(f"{tmp_path}/docs"), folder_sink(f"{tmp_path}/bad")
        return run_report_builtin(incoming, docs, bad, f"{tmp_path}/checkpoint", TEN, trigger=NOW)

    sent = messages(spark, in_order).union(spark.createDataFrame([("{", 120, 120)], "value string, arrival bigint, n bigint"))
    replay(sent, (F.col("n") >= 100).cast("int"), 2, f"{tmp_path}/in", start)
    bad = read_folder(spark, f"{tmp_path}/bad", "value string, reason string").collect()
    assert [(row["value"], row["reason"]) for row in bad] == [("{", "malformed_json")]
    got = documents(read_folder(spark, f"{tmp_path}/docs", DOCS), "upsert").collect()
    _, counts, _ = play(in_order, TEN)
    assert {(row["time"], row["type"], row["area"]): row["count"] for row in got} == {
        (time_text(end), kind, area): count for (end, kind, area), count in counts.items()
    }


def test_clean_batch_that_is_run_again_meets_the_same_areas(spark, tmp_path):
    """The sink fails after the area table was read; the table changes, and a new job runs the batch again."""
    source = {"rows": [("OLD", "NL")]}
    sink, fails = folder_sink(f"{tmp_path}/out", "text"), [False, True]

    def failing(df, batch_id):
        sink(df, batch_id)
        if fails[batch_id]:
            fails[batch_id] = False
            raise OSError("no space left")

    def run():
        areas = AreaSnapshots(lambda: spark.createDataFrame(source["rows"], "area string, codes string"), max_age=0)
        incoming = read_messages(spark, "parquet", True, "value string", path=f"{tmp_path}/in")
        query = run_clean(incoming, areas, failing, f"{tmp_path}/checkpoint", folder_sink(f"{tmp_path}/bad"), trigger=NOW)
        query.awaitTermination()

    def send(n):
        text = json.dumps({"dt": str(n), "countryCode": "NL", "data": [{"type": "x"}]})
        spark.createDataFrame([(text,)], "value string").write.mode("append").parquet(f"{tmp_path}/in")

    def found():
        records = [json.loads(row["value"]) for row in read_folder(spark, f"{tmp_path}/out", "value string", "text").collect()]
        return sorted((r["dt"], r["area"]) for r in records)

    send(0)
    run()
    source["rows"] = [("SECOND", "NL")]
    send(1)
    with pytest.raises(Exception, match="no space left"):
        run()
    before = found()
    source["rows"] = [("THIRD", "NL")]
    run()
    assert found() == before == [("0", "OLD"), ("1", "SECOND")]


def test_clean_stream_takes_the_table_of_each_batch(spark, tmp_path):
    versions = iter([[("OLD", "NL,CW")], [], [("NEW", "NL")]])
    areas = AreaSnapshots(lambda: spark.createDataFrame(next(versions), "area string, codes string"), max_age=0)
    sink = all_of(folder_sink(f"{tmp_path}/out", "text"), console_sink())

    def start():
        incoming = read_messages(spark, "parquet", True, "value string", path=f"{tmp_path}/in")
        return run_clean(incoming, areas, sink, f"{tmp_path}/checkpoint", folder_sink(f"{tmp_path}/bad"), "other", trigger=NOW)

    sent = [(json.dumps({"dt": str(n), "countryCode": code, "data": [{"type": code}]}), n) for n in range(3) for code in ("NL", "CW")]
    table = spark.createDataFrame([*sent, ("{", 1)], "value string, n int")
    replay(table, F.col("n"), 3, f"{tmp_path}/in", start)
    records = [json.loads(row["value"]) for row in read_folder(spark, f"{tmp_path}/out", "value string", "text").collect()]
    assert sorted((r["dt"], r["type"], r["area"]) for r in records) == [
        ("0", "CW", "OLD"),
        ("0", "NL", "OLD"),
        ("1", "CW", "OLD"),
        ("1", "NL", "OLD"),
        ("2", "CW", "other"),
        ("2", "NL", "NEW"),
    ]
    bad = read_folder(spark, f"{tmp_path}/bad", "value string, reason string").collect()
    assert [(row["value"], row["batch_id"]) for row in bad] == [("{", 1)]


def test_jobs_on_folders(spark, tmp_path):
    spark.createDataFrame([("NORTH", "NL")], "area string, codes string").write.parquet(f"{tmp_path}/areas")
    envelope = {"dt": "2024-01-01 00:00:00", "countryCode": "NL", "data": [{"type": "tea"}, {"type": "ink"}]}
    os.mkdir(tmp_path / "envelopes")
    (tmp_path / "envelopes/a.txt").write_text(json.dumps(envelope) + "\n")
    clean_job.main(
        f"--input {tmp_path}/envelopes --output {tmp_path}/clean --areas {tmp_path}/areas --folder {tmp_path}/c --once".split()
    )
    cleaned = read_folder(spark, f"{tmp_path}/clean", "value string", "text").collect()
    assert sorted(json.loads(row["value"])["type"] for row in cleaned) == ["ink", "tea"]

    os.mkdir(tmp_path / "audit")
    audit = [{"dt": time_text(BASE + s * 1000), "type": "login", "area": "NORTH"} for s in (5, 50, 75)]
    (tmp_path / "audit/a.txt").write_text("\n".join(map(json.dumps, audit)))
    for flags, folder in (("--print", "r"), ("--builtin --times nonzero --option maxFilesPerTrigger=5", "b")):
        report_job.main(f"--input {tmp_path}/audit --late {tmp_path}/late --folder {tmp_path}/{folder} --once {flags}".split())
        docs = read_folder(spark, f"{tmp_path}/{folder}/auditindex", DOCS).collect()
        assert ("2024-01-01 00:01:00", 2) in {(row["time"], row["count"]) for row in docs}
