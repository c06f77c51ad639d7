"""The report job on a stream of audit texts: exact lateness, or Spark's own watermark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import format_ms
from tidemark.operators.audit import bad_rows, good_rows, late_lines, parse_audit, slim
from tidemark.operators.lateness import KEY, classify_lateness, window_turns
from tidemark.operators.scans import running_total
from tidemark.operators.windows import LABEL_TIME, label_time, report_docs, window_counts
from tidemark.settings import Timing
from tidemark.sinks.writers import Sink
from tidemark.workspace import drop_folder, scratch, setting, written

EACH_MINUTE = {"processingTime": "60 seconds"}
STATE = "window_end_ms bigint, type string, area string, count bigint, newest_ms bigint, last_ms bigint"


@dataclass(frozen=True)
class ReportStep:
    """One micro-batch of the exact report, from the state the batch before left in ``state``.

    The state holds, for each window still open, its count and its newest event time. A batch reads
    the state of its predecessor and writes its own under its id, so running it again with the same
    rows leaves the same state and the same output. The last ``keep`` batches of state are kept.

    With an ``arrival`` column, rows of one batch meet the watermark of the rows before them. As long as
    arrivals do not go back from batch to batch, the result does not depend on where batches are cut.
    With None, or in a batch with a row whose arrival is null, they all meet the watermark the earlier
    batches left. ``label`` chooses the time printed, as in ``window_counts``.

    Several refires of a window within a batch come out as one document, the last. With ``each_refire``
    every one is a document, as in the batch report's changelog: one for the firing, and one for each
    arrival that corrects it, with the count so far. Their documents are named by window end only.
    ``lenient`` is as in ``parse_audit``.
    """

    state: str
    docs: Sink
    late: Sink
    bad: Sink
    timing: Timing = Timing()
    arrival: str | None = "arrival"
    times: str = "positive"
    label: str = "window_end"
    keep: int = 100
    each_refire: bool = False
    lenient: bool = False

    def __post_init__(self) -> None:
        if self.each_refire and self.label != "window_end":
            raise ValueError("each refire is named by its window's end")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            # The batch is used several times; parts lost with an executor are read again.
            parsed = slim(parse_audit(batch, self.times, self.lenient)).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self._run(parsed, batch_id)
            finally:
                parsed.unpersist()

    def _run(self, parsed: DataFrame, batch_id: int) -> None:
        rows = good_rows(parsed)
        held = self._held(parsed.sparkSession, batch_id - 1)
        seen = held.agg(F.max("newest_ms")).first()[0] or 0 if batch_id > 0 else 0
        arrival = self.arrival
        if arrival is not None and rows.where(F.col(arrival).isNull()).limit(1).count():
            arrival = None
        if arrival is None:
            turns, newest = None, rows.agg(F.max(F.unix_millis("event_time"))).first()[0]
        else:
            turns = written(window_turns(rows, self.timing, arrival), "turns")
            newest = turns.agg(F.max("newest_ms")).first()[0]
        now = max(seen, newest or 0)

        tagged = classify_lateness(rows, self.timing, arrival, seen, turns)
        self.late(late_lines(tagged.where("lateness = 'late'")), batch_id)
        self.bad(bad_rows(parsed), batch_id)
        counts = written(self._counts(tagged, held, arrival), "counts")
        if self.each_refire and arrival is not None:
            self.docs(self._each_emitted(tagged, held, arrival, seen, now), batch_id)
        else:
            self.docs(self._emitted(counts, seen, now), batch_id)
        # The newest row of all stays, open or not: the next batch takes `seen` from it.
        closes_at = F.col("window_end_ms") + self.timing.close_after_ms
        still_open = counts.where((closes_at > now) | (F.col("newest_ms") == now))
        still_open.drop("added").write.mode("overwrite").parquet(f"{self.state}/{batch_id}")
        if batch_id >= self.keep:
            drop_folder(parsed.sparkSession, f"{self.state}/{batch_id - self.keep}")

    def _held(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(f"{self.state}/{batch_id}")

    def _counts(self, tagged: DataFrame, held: DataFrame, arrival: str | None) -> DataFrame:
        """Full counts of the open windows, and how many rows of this batch they include."""
        fresh = tagged.where("lateness <> 'late'").groupBy(*KEY)
        newest = F.max(F.unix_millis("event_time")).alias("newest_ms")
        fresh = fresh.agg(F.count("*").alias("added"), newest, *label_time(self.label, arrival))
        last = F.unix_millis(LABEL_TIME) if self.label == "last_event" else F.col("newest_ms")
        fresh = fresh.withColumns({"count": F.col("added"), "last_ms": last}).drop(LABEL_TIME)
        both = fresh.unionByName(held.withColumn("added", F.lit(0).cast("long")))
        sums = [F.sum(name).alias(name) for name in ("count", "added")]
        # A window has at most two rows here; the one with rows of this batch holds its last arrival.
        last = F.max_by("last_ms", "added").alias("last_ms")
        return both.groupBy(*KEY).agg(*sums, F.max("newest_ms").alias("newest_ms"), last)

    def _each_emitted(self, tagged: DataFrame, held: DataFrame, arrival: str, seen: int, now: int) -> DataFrame:
        """One document for every firing and every arrival that corrects a fired window.

        What was counted before a window fired, by this batch or in the state, comes first and has no
        arrival here; the corrections follow in the order of theirs, on top of it.
        """
        refired = F.when(F.col("lateness") == "refire", F.col(arrival)).alias("refired_at")
        fresh = tagged.where("lateness <> 'late'").select(*KEY, refired, F.lit(1).cast("long").alias("count"))
        before = held.select(*KEY, F.lit(None).cast(tagged.schema[arrival].dataType).alias("refired_at"), "count")
        fires_at = F.col("window_end_ms") + self.timing.fire_after_ms
        totals = running_total(fresh.unionByName(before).where(fires_at <= now), KEY, "refired_at", "count")
        # A window that had fired earlier has shown the count it had then.
        emitted = totals.where(F.col("refired_at").isNotNull() | (fires_at > seen))
        return report_docs(emitted.select(format_ms("window_end_ms").alias("time"), "type", "area", "count"))

    def _emitted(self, counts: DataFrame, seen: int, now: int) -> DataFrame:
        fires_at = F.col("window_end_ms") + self.timing.fire_after_ms
        emitted = counts.where((fires_at <= now) & ((F.col("added") > 0) | (fires_at > seen)))
        printed = {"window_end": "window_end_ms", "max_event": "newest_ms", "last_event": "last_ms"}[self.label]
        time = format_ms(printed)
        return report_docs(emitted.select(time.alias("time"), "type", "area", "count"))


def run_report_exact(messages: DataFrame, step: ReportStep, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the exact report. ``messages`` has ``value`` and, if the step names one, its arrival."""
    return (
        messages.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EACH_MINUTE))
        .start()
    )


def run_report_builtin(
    messages: DataFrame,
    docs: Sink,
    bad: Sink,
    checkpoint: str,
    timing: Timing = Timing(),
    label: str = "window_end",
    times: str = "positive",
    state_partitions: int | None = None,
    trigger: dict | None = None,
    lenient: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the report on Spark's watermark in update mode, and a second query for the bad rows.

    Simpler and with state in Spark's own store, but rows count as late up to one batch later than in
    the exact report, windows emit before they end, and rows dropped as late are only counted. The two
    queries, with checkpoints of their own, each read the messages.

    ``state_partitions`` (by default the session's shuffle partitions) stays as it was when the stream
    first ran; the cores of the cluster are a fair number, as each costs a few files per batch.
    """
    parsed = parse_audit(messages, times, lenient)
    rows = good_rows(parsed)
    rows = rows.withWatermark("event_time", f"{timing.delay_ms + timing.lateness_ms} milliseconds")
    counted = window_counts(rows, timing, label, "arrival" if "arrival" in messages.columns else None)

    def step(batch: DataFrame, batch_id: int) -> None:
        docs(report_docs(batch), batch_id)

    def started(rows: DataFrame, mode: str, write: Sink, folder: str) -> StreamingQuery:
        writer = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", folder)
        return writer.trigger(**(trigger or EACH_MINUTE)).start()

    with setting(messages.sparkSession, "spark.sql.shuffle.partitions", state_partitions):
        report = started(counted, "update", step, checkpoint)
    return report, started(bad_rows(parsed), "append", bad, f"{checkpoint}-bad")
