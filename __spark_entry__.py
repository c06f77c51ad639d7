
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import ORACLES
from tidemark.functions.json_text import put_fields, read_fields
from tidemark.functions.times import format_ms, parse_time
from tidemark.operators.areas import invert_areas
from tidemark.operators.audit import bad_rows, good_rows, parse_audit
from tidemark.operators.clean import parse_envelopes
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.operators.versions import invert_versions
from tidemark.operators.windows import report_docs, sorted_event_times, window_counts
from tidemark.plans.clean import Cleaned, clean_messages, clean_messages_as_of
from tidemark.plans.report import Report, report_messages
from tidemark.plans.tables import (
    DAY,
    DAY_DELAY_MS,
    ITEM_FIELDS,
    MINUTE,
    MINUTE_DELAY_MS,
    area_hash,
    area_log,
    arrivals,
    audit_messages,
    order_messages,
    table,
)
from tidemark.settings import OTHER_AREA, Timing
from tidemark.sinks.delivery import with_ids_sink
from tidemark.sinks.writers import documents, folder_sink, read_folder, read_upserted, upsert_sink
from tidemark.sources.areas import AreaSnapshots
from tidemark.sources.messages import keys_on_disk, read_messages
from tidemark.streaming.clean import run_clean
from tidemark.streaming.replay import NOW, replay
from tidemark.streaming.report import ReportStep, run_report_builtin, run_report_exact
from tidemark.workspace import new_folder, setting, use_utc, written

# Training-data operators and the corpus pipeline are a part that may be left out.
try:
    import corpus_pipeline
    from tidemark.llm.queries import ORACLES as LLM_ORACLES
    from tidemark.llm.queries import QUERIES as LLM_QUERIES
except ImportError as missing:
    # Said aloud, so that a part that should be there isn't missed in silence.
    print(f"training-data queries are left out: {missing}", file=sys.stderr)
    HAS_LLM = False
else:
    HAS_LLM = True

Query = Callable[[SparkSession, str], DataFrame]

REPORT_FIELDS = "time string, type string, area string, count bigint, doc_id string, document string"
STREAM_PARTS = 4
DATE_PARTS = 3
SOURCES = 3


def entry(spark: SparkSession) -> DataFrame:
    return queries()["report_window_counts"](spark, "/root/testdata/sf0.001")


# Report, without lateness.


def _rows(spark: SparkSession, sf_dir: str, delay_ms: int = 0) -> DataFrame:
    """Parsed audit rows that the report counts."""
    return good_rows(parse_audit(audit_messages(use_utc(spark), sf_dir, delay_ms)))


def _counts(timing: Timing, delay_ms: int = 0, label: str = "window_end") -> Query:
    return lambda spark, sf_dir: window_counts(_rows(spark, sf_dir, delay_ms), timing, label)


def _docs(timing: Timing) -> Query:
    return lambda spark, sf_dir: report_docs(window_counts(_rows(spark, sf_dir), timing))


def _sorted_times(timing: Timing) -> Query:
    return lambda spark, sf_dir: sorted_event_times(_rows(spark, sf_dir), timing)


# Report, with lateness.


def _report(
    take: Callable[[Report], DataFrame], timing: Timing, delay_ms: int, label: str = "window_end", sources: int = 0, **more: int
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = audit_messages(use_utc(spark), sf_dir, delay_ms, sources=sources)
        by_source = {"source": "source", "sources": sources} if sources else {}
        return take(report_messages(messages, timing, label=label, **by_source, **more))

    return query


def _classes(report: Report) -> DataFrame:
    return report.classified.select("event_id", format_ms("window_end_ms").alias("time"), "lateness")


def _upserted(report: Report) -> DataFrame:
    return report.upserted.select("doc_id", "time", "type", "area", "count")


def _changelog(report: Report) -> DataFrame:
    return report.changelog.select("doc_id", "time", "type", "area", "count", "emitted_at")


# Parsing and filters.


def _audit_parsed(times: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parsed = parse_audit(audit_messages(use_utc(spark), sf_dir, damaged=True), times)
        return good_rows(parsed).select("event_id", F.unix_millis("event_time").alias("event_ms"), "type", "area")

    return query


def _audit_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_audit(audit_messages(use_utc(spark), sf_dir, loose=True), lenient=True)
    return parsed.select("event_id", F.unix_millis("event_time").alias("event_ms"), "type", "area", "reason")


def _audit_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_rows(parse_audit(audit_messages(use_utc(spark), sf_dir, damaged=True)))


def _json_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", read_fields("props", "k string")["k"].alias("k"))


def _json_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    put = put_fields(F.col("props"), {"area": F.col("event_type")})
    return table(spark, sf_dir, "events").select("event_id", put.alias("props"))


def _time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit_messages(use_utc(spark), sf_dir).select("event_id", F.get_json_object("value", "$.dt").alias("dt"))
    rows = rows.withColumn("event_ms", F.unix_millis(parse_time("dt")))
    return rows.withColumn("printed", format_ms("event_ms"))


# Clean.


def _area_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AreaSnapshots(lambda: area_hash(spark, sf_dir)).current()


def _area_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invert_areas(area_hash(spark, sf_dir))


def _cleaned(
    spark: SparkSession, sf_dir: str, default_area: str | None = None, is_open: bool = False, damaged: bool = False, shuffled: bool = False
) -> Cleaned:
    """``shuffled``: as if the area table were too large to broadcast."""
    messages = order_messages(use_utc(spark), sf_dir, extra=is_open, damaged=damaged)
    beyond = {"max_broadcast": 0} if shuffled else {}
    return clean_messages(messages, _area_dim(spark, sf_dir), default_area, None if is_open else ITEM_FIELDS, **beyond)


def _clean_bad(is_open: bool) -> Query:
    """How many records and bad rows of each reason the damaged envelopes give."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = _cleaned(spark, sf_dir, is_open=is_open, damaged=True)
        return cleaned.outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))

    return query


def _json_columns(records: DataFrame, fields: str) -> DataFrame:
    """JSON records back as columns, to compare values rather than text."""
    return records.select(F.from_json("value", fields).alias("r")).select("r.*")


CLEAN_FIELDS = f"{ITEM_FIELDS}, area string, dt string"
OPEN_FIELDS = f"{CLEAN_FIELDS}, line int, supplier bigint, bulk boolean, detail struct<part: bigint, flags: array<string>>"


def _open_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _cleaned(spark, sf_dir, is_open=True).json
    # Parsing a field as text changes its numbers, so it is cut out of the record.
    raw = F.regexp_extract("value", r'"raw":(\[.*?\])', 1)
    columns = records.select(F.from_json("value", OPEN_FIELDS).alias("r"), raw.alias("raw")).select("r.*", "raw")
    flags = F.array_join("detail.flags", "")
    return columns.withColumns({"part": F.col("detail.part"), "flags": flags}).drop("detail")


def _envelope_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = parse_envelopes(order_messages(use_utc(spark), sf_dir), ITEM_FIELDS)
    return envelopes.select("dt", "countryCode", F.size("data").alias("items"))


def _dim_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts of the orders meet, in turn, the area table, an empty refresh and a changed table."""
    use_utc(spark)
    versions = iter([area_hash(spark, sf_dir), area_hash(spark, sf_dir).limit(0), area_hash(spark, sf_dir, shift=1)])
    areas = AreaSnapshots(lambda: next(versions), max_age=0)
    messages = written(order_messages(spark, sf_dir), "messages")
    parts = [messages.where(_date_part() == n) for n in range(DATE_PARTS)]
    cleaned = [clean_messages(part, areas.current(), None, ITEM_FIELDS).columns for part in parts]
    return reduce(DataFrame.union, cleaned)


def _date_part() -> Column:
    """The part of an order: before 1996, before 1999, or else, a missing date among them."""
    first, second = (F.col("ordered_on") < F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1996, 1999))
    return F.when(first, 0).when(second, 1).otherwise(2)


def _as_of(max_broadcast: int = BROADCAST_BYTES) -> Query:
    """All orders in one pass, each with the area table of its day."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = order_messages(use_utc(spark), sf_dir)
        messages = messages.withColumn("arrival", F.unix_micros(F.col("ordered_on").cast("timestamp")))
        versions = invert_versions(area_log(spark, sf_dir))
        return clean_messages_as_of(messages, versions, "arrival", None, ITEM_FIELDS, max_broadcast).columns

    return query


# Streams. Each writes the messages to a folder in parts, and the job takes one part per micro-batch.


def _stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(use_utc(spark), "stream-clean")
    areas = AreaSnapshots(lambda: area_hash(spark, sf_dir))

    def start():
        messages = read_messages(spark, "parquet", True, "value string, ordered_on timestamp_ntz", path=f"{folder}/in")
        return run_clean(
            messages,
            areas,
            folder_sink(f"{folder}/out", "text"),
            f"{folder}/checkpoint",
            folder_sink(f"{folder}/bad"),
            item_fields=ITEM_FIELDS,
            trigger=NOW,
        )

    replay(order_messages(spark, sf_dir), _date_part(), DATE_PARTS, f"{folder}/in", start)
    return _json_columns(read_folder(spark, f"{folder}/out", "value string", "text"), CLEAN_FIELDS)


def _delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of three batches, the second of which is sent twice, as a stream reads them from the log."""
    folder = new_folder(use_utc(spark), "delivery")

    def append(df: DataFrame, batch_id: int) -> None:
        df.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(f"{folder}/log")

    send = with_ids_sink(append)
    messages = written(order_messages(spark, sf_dir), "messages")
    areas = _area_dim(spark, sf_dir)
    for batch_id in (0, 1, 1, 2):
        send(clean_messages(messages.where(_date_part() == batch_id), areas, None, ITEM_FIELDS).json, batch_id)
    log = read_messages(spark, "parquet", True, "key string, value string, timestamp timestamp", "1 hour", path=f"{folder}/log")
    once = log.writeStream.foreachBatch(folder_sink(f"{folder}/out"))
    with setting(spark, "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism), keys_on_disk(spark):
        query = once.option("checkpointLocation", f"{folder}/checkpoint").trigger(**NOW).start()
    query.awaitTermination()
    return _json_columns(read_folder(spark, f"{folder}/out", "value string"), CLEAN_FIELDS)


def _arrival_part(messages: DataFrame) -> Column:
    """Equal spans of arrival time."""
    low, high = messages.agg(F.min("arrival"), F.max("arrival")).first()
    return F.call_function("div", (F.col("arrival") - low) * STREAM_PARTS, F.lit(high - low + 1))


def _run_exact(spark: SparkSession, sf_dir: str, upsert: bool = False, each_refire: bool = False) -> str:
    """Run the exact report over the delayed events; the folder that holds its output."""
    folder = new_folder(use_utc(spark), "stream-report")
    docs = upsert_sink(f"{folder}/docs") if upsert else folder_sink(f"{folder}/docs")
    step = ReportStep(f"{folder}/state", docs, folder_sink(f"{folder}/late", "text"), folder_sink(f"{folder}/bad"), timing=DAY, each_refire=each_refire)

    def start():
        messages = read_messages(spark, "parquet", True, "value string, arrival bigint", path=f"{folder}/in")
        return run_report_exact(messages, step, f"{folder}/checkpoint", NOW)

    messages = audit_messages(spark, sf_dir, DAY_DELAY_MS).drop("event_id")
    replay(messages, _arrival_part(arrivals(spark, sf_dir, DAY_DELAY_MS)), STREAM_PARTS, f"{folder}/in", start)
    return folder


def _stream_docs(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = read_folder(spark, f"{_run_exact(spark, sf_dir)}/docs", REPORT_FIELDS)
        columns = ["doc_id", "time", "type", "area", "count"]
        return documents(log, mode).select(*columns, *(["batch_id"] if mode == "append" else []))

    return query


def _stream_refires(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_folder(spark, f"{_run_exact(spark, sf_dir, each_refire=True)}/docs", REPORT_FIELDS)
    return log.select("doc_id", "time", "type", "area", "count")


def _stream_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = read_upserted(spark, f"{_run_exact(spark, sf_dir, upsert=True)}/docs", REPORT_FIELDS)
    return held.select("doc_id", "time", "type", "area", "count")


def _stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_folder(spark, f"{_run_exact(spark, sf_dir)}/late", "value string", "text").select("value")


def _stream_builtin(timing: Timing, delay_ms: int = 0) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(use_utc(spark), "stream-builtin")

        def start():
            messages = read_messages(spark, "parquet", True, "value string, arrival bigint", path=f"{folder}/in")
            return run_report_builtin(
                messages,
                folder_sink(f"{folder}/docs"),
                folder_sink(f"{folder}/bad"),
                f"{folder}/checkpoint",
                timing,
                state_partitions=spark.sparkContext.defaultParallelism,
                trigger=NOW,
            )

        messages = audit_messages(spark, sf_dir, delay_ms).drop("event_id")
        replay(messages, _arrival_part(arrivals(spark, sf_dir, delay_ms)), STREAM_PARTS, f"{folder}/in", start)
        log = read_folder(spark, f"{folder}/docs", REPORT_FIELDS)
        return documents(log, "upsert").select("time", "type", "area", "count")

    return query


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "area_dim_inverted": _area_inverted,
        "audit_bad_rows": _audit_bad,
        "audit_rows_lenient": _audit_lenient,
        "audit_rows_nonzero": _audit_parsed("nonzero"),
        "audit_rows_positive": _audit_parsed("positive"),
        "clean_bad_rows": _clean_bad(is_open=False),
        "clean_bad_rows_open": _clean_bad(is_open=True),
        "clean_envelope_sizes": _envelope_sizes,
        "clean_items_null": lambda spark, sf_dir: _cleaned(spark, sf_dir).columns,
        "clean_items_other": lambda spark, sf_dir: _cleaned(spark, sf_dir, OTHER_AREA).columns,
        "clean_items_other_shuffled": lambda spark, sf_dir: _cleaned(spark, sf_dir, OTHER_AREA, shuffled=True).columns,
        "clean_json_roundtrip": lambda spark, sf_dir: _json_columns(_cleaned(spark, sf_dir).json, CLEAN_FIELDS),
        "clean_open_schema": _open_schema,
        "dim_as_of": _as_of(),
        "dim_as_of_shuffled": _as_of(max_broadcast=0),
        "dim_replacement": _dim_replacement,
        "json_get": _json_get,
        "json_put": _json_put,
        "stream_clean": _stream_clean,
        "stream_delivered_once": _delivered_once,
        "stream_report_builtin": _stream_builtin(MINUTE),
        "lateness_classes_shuffled_1d": _report(_classes, DAY, DAY_DELAY_MS, max_broadcast=0),
        "stream_report_builtin_1d": _stream_builtin(DAY),
        "stream_report_builtin_late_1d": _stream_builtin(DAY, DAY_DELAY_MS),
        "stream_report_emissions": _stream_docs("append"),
        "stream_report_exact": _stream_docs("upsert"),
        "stream_report_late": _stream_late,
        "stream_report_refires": _stream_refires,
        "stream_report_upsert_sink": _stream_upserted,
        "time_text": _time_text,
    }
    for suffix, timing, delay_ms in (("", MINUTE, MINUTE_DELAY_MS), ("_1d", DAY, DAY_DELAY_MS)):
        found |= {
            f"late_rows_tsv{suffix}": _report(lambda report: report.late, timing, delay_ms),
            f"lateness_classes{suffix}": _report(_classes, timing, delay_ms),
            f"lateness_classes_by_source{suffix}": _report(_classes, timing, delay_ms, sources=SOURCES),
            f"report_docs{suffix}": _docs(timing),
            f"report_docs_upsert{suffix}": _report(_upserted, timing, delay_ms),
            f"report_docs_upsert_by_source{suffix}": _report(_upserted, timing, delay_ms, sources=SOURCES),
            f"report_final_counts{suffix}": _report(lambda report: report.counts, timing, delay_ms),
            f"report_final_counts_last_event{suffix}": _report(lambda report: report.counts, timing, delay_ms, "last_event"),
            f"report_last_event_label{suffix}": _counts(timing, delay_ms, "last_event"),
            f"report_max_event_label{suffix}": _counts(timing, delay_ms, "max_event"),
            f"report_refire_changelog{suffix}": _report(_changelog, timing, delay_ms),
            f"report_window_counts{suffix}": _counts(timing),
            f"window_event_times_sorted{suffix}": _sorted_times(timing),
        }
    if HAS_LLM:
        found |= LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if HAS_LLM:
        found |= LLM_ORACLES
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
