"""Counts per tumbling window, type and area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.texts import document_id
from tidemark.functions.times import format_time
from tidemark.settings import Timing

LABELS = ("window_end", "max_event", "last_event")
LABEL_TIME = "label_time"


def label_time(label: str, arrival: str | None = "arrival") -> list[Column]:
    """The aggregate ``label_time`` that a label other than ``window_end`` prints; see ``window_counts``."""
    if label not in LABELS:
        raise ValueError(f"label must be one of {LABELS}, not {label!r}")
    if label == "window_end":
        return []
    if label == "max_event" or arrival is None:
        return [F.max("event_time").alias(LABEL_TIME)]
    return [F.max(F.struct(arrival, "event_time"))["event_time"].alias(LABEL_TIME)]


def window_counts(
    rows: DataFrame, timing: Timing = Timing(), label: str = "window_end", arrival: str | None = "arrival"
) -> DataFrame:
    """``(time, type, area, count)`` per window. Works on batch data and on watermarked streams.

    ``label`` chooses the time printed: the window's end, its latest event time, or the event time of
    the row that arrived last by ``arrival`` (the later event time where two arrived together).
    """
    window = F.window("event_time", f"{timing.window_ms} milliseconds")
    counted = rows.groupBy(window.alias("window"), "type", "area").agg(
        F.count("*").alias("count"), *label_time(label, arrival)
    )
    time = "window.end" if label == "window_end" else LABEL_TIME
    return counted.select(format_time(time).alias("time"), "type", "area", "count")


def sorted_event_times(rows: DataFrame, timing: Timing = Timing()) -> DataFrame:
    """The sorted event times of each window, one row per distinct time.

    ``copies`` rows share the time and the first of them is number ``position`` of its window.
    Copies are folded before the sort, so a window holds at most one row per distinct time.
    """
    window = F.window("event_time", f"{timing.window_ms} milliseconds")
    times = rows.groupBy(window.alias("window"), "type", "area", "event_time").agg(F.count("*").alias("copies"))
    before = Window.partitionBy("window", "type", "area").orderBy("event_time")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    position = F.coalesce(F.sum("copies").over(before), F.lit(0)) + 1
    return times.select(
        format_time("window.end").alias("time"),
        "type",
        "area",
        format_time("event_time").alias("event_time"),
        "copies",
        position.alias("position"),
    )


def report_docs(counts: DataFrame) -> DataFrame:
    """Add ``doc_id``, and ``document``, the JSON text of the four report fields."""
    fields = ["time", "type", "area", "count"]
    return counts.withColumns(
        {
            "doc_id": document_id(F.col("time"), F.col("type"), F.col("area")),
            "document": F.to_json(F.struct(*fields)),
        }
    )
