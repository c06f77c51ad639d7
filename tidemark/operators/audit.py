"""Audit-log text to ``(event_time, type, area)``, and the text of a late row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_text import is_broken, read_fields
from tidemark.functions.once import with_once
from tidemark.functions.texts import tab_line
from tidemark.functions.times import parse_time


def parse_audit(messages: DataFrame, times: str = "positive", lenient: bool = False) -> DataFrame:
    """Add ``event_time``, ``type``, ``area`` and ``reason`` to rows with a ``value`` text.

    ``reason`` is null for rows the report counts. ``times`` says which moments it takes:
    ``positive`` (after the epoch) or ``nonzero`` (any but the epoch itself). With ``lenient``, times may
    be written as ``parse_time`` says.
    """
    if times not in ("positive", "nonzero"):
        raise ValueError(f"times must be 'positive' or 'nonzero', not {times!r}")
    parsed = with_once(messages, "_p", read_fields("value", "dt string, type string, area string"))
    parsed = with_once(parsed, "event_time", parse_time("_p.dt", lenient))
    ms = F.unix_millis("event_time")
    reason = (
        F.when(is_broken("_p"), "malformed_json")
        .when(F.col("event_time").isNull(), "bad_time")
        .when(ms <= 0 if times == "positive" else ms == 0, "excluded_time")
        .when(F.col("_p.type").isNull(), "no_type")
        .when(F.col("_p.area").isNull(), "no_area")
    )
    return parsed.select(*messages.columns, "event_time", "_p.type", "_p.area", reason.alias("reason"))


def slim(parsed: DataFrame) -> DataFrame:
    """``parsed`` without the texts of good rows, for keeping."""
    return parsed.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("value", "reason")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def late_lines(rows: DataFrame) -> DataFrame:
    """``value`` = epoch ms, type and area joined by tabs."""
    return rows.select(tab_line(F.unix_millis("event_time"), F.col("type"), F.col("area")).alias("value"))
