"""Watermark, allowed lateness and re-firing, as joins and aggregations.

The watermark trails the largest event time that arrived before a row by ``delay_ms``. It passes a
given moment when the first event time beyond that moment arrives, so a window's whole story is two
arrivals: the one that fired it and the one that closed it. Both come from one aggregation over the
rows and a scan over the windows; the rows themselves are neither sorted nor shuffled.

Each source that is read in parallel may have a watermark of its own. The job's is then the least of
them, which passes a moment when the last of the sources does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import format_ms, format_time, window_number
from tidemark.operators.joins import BROADCAST_BYTES, lookup_join
from tidemark.operators.scans import minimum_from_here_up, running_total
from tidemark.operators.windows import LABEL_TIME, label_time
from tidemark.settings import Timing
from tidemark.workspace import written

KEY = ["window_end_ms", "type", "area"]


def window_end_ms(timing: Timing) -> Column:
    """End of the row's window, in epoch ms."""
    return (window_number(F.unix_millis("event_time"), timing.window_ms) + 1) * timing.window_ms


def window_turns(
    rows: DataFrame, timing: Timing = Timing(), arrival: str = "arrival", source: str | None = None, sources: int = 1
) -> DataFrame:
    """``(window_end_ms, fire_at, close_at, newest_ms)`` for each window that has rows.

    ``fire_at`` and ``close_at`` are the first arrivals with an event time late enough to fire or
    close the window, null if none came; ``newest_ms`` is the largest event time in it.

    With a column ``source`` of numbers below ``sources``, the first such arrival of every source is
    awaited: one without rows holds all windows back. Any other number, or none, ends the job. Each
    source adds two columns to the scan of the windows.
    """
    if source is None:
        number, sources = F.lit(0), 1
    else:
        wrong = F.raise_error(F.concat(F.lit(f"not a source below {sources}: "), F.coalesce(F.col(source).cast("string"), F.lit("null"))))
        number = F.when(F.col(source).between(0, sources - 1), F.col(source).cast("int")).otherwise(wrong)
    fires, closes = ([f"{turn}_{n}" for n in range(sources)] for turn in ("fire_at", "close_at"))
    ms = F.unix_millis("event_time")
    # Numbers count windows from the epoch. A row lies in window `own`, and fires (closes) all windows
    # up to `fires` (`closes`). Three numbers per row take few distinct values per window width.
    first = rows.groupBy(
        (window_number(ms, timing.window_ms) + 1).alias("own"),
        window_number(ms, timing.window_ms, timing.fire_after_ms).alias("fires"),
        window_number(ms, timing.window_ms, timing.close_after_ms).alias("closes"),
        number.alias("source"),
    ).agg(F.min(arrival).alias("first"), F.max(ms).alias("newest"))
    at, newest = F.col("first"), F.col("newest")
    never = F.lit(None).cast(rows.schema[arrival].dataType)
    nothing = F.lit(None).cast("long")

    def point(number: str, fire_at: Column, close_at: Column, newest_ms: Column) -> Column:
        columns = {"number": F.col(number), "newest_ms": newest_ms}
        for n in range(sources):
            own = F.col("source") == n
            columns |= {fires[n]: F.when(own, fire_at), closes[n]: F.when(own, close_at)}
        return F.struct(*[column.alias(name) for name, column in columns.items()])

    def last(names: list[str]) -> Column:
        """The last of the sources' arrivals, if all have one."""
        return F.when(reduce(Column.__and__, [F.col(n).isNotNull() for n in names]), F.array_max(F.array(*names)))

    points = F.array(
        point("own", never, never, newest), point("fires", at, never, nothing), point("closes", never, at, nothing)
    )
    turns = minimum_from_here_up(
        first.select(F.inline(points)), "number", [*fires, *closes], [F.max("newest_ms").alias("newest_ms")]
    )
    return turns.where("newest_ms is not null").select(
        (F.col("number") * timing.window_ms).alias("window_end_ms"), last(fires).alias("fire_at"), last(closes).alias("close_at"), "newest_ms"
    )


def classify_lateness(
    rows: DataFrame,
    timing: Timing = Timing(),
    arrival: str | None = "arrival",
    seen_ms: int = 0,
    turns: DataFrame | None = None,
    max_broadcast: int = BROADCAST_BYTES,
    source: str | None = None,
    sources: int = 1,
) -> DataFrame:
    """Add ``window_end_ms``, ``fire_at`` and ``lateness`` (``ontime``, ``refire`` or ``late``).

    ``arrival`` orders the rows: a row meets the watermark of the rows that arrived before it, and
    rows with equal arrivals came together. With ``arrival=None`` all rows came together.
    ``seen_ms`` is the largest event time that had arrived before any of these rows.

    ``turns`` are the ``window_turns`` of the rows; they are worked out here if not given, so that
    ``rows`` are read twice, now and when the result is used. ``source`` and ``sources`` are as there: a row
    meets the least of the sources' watermarks.
    """
    rows = rows.withColumn("window_end_ms", window_end_ms(timing))
    late = F.lit(seen_ms) >= F.col("window_end_ms") + timing.close_after_ms
    refire = F.lit(seen_ms) >= F.col("window_end_ms") + timing.fire_after_ms
    if arrival is None:
        tagged = rows.withColumn("fire_at", F.lit(None).cast("long"))
    else:
        if turns is None:
            turns = written(window_turns(rows, timing, arrival, source, sources), "turns")
        tagged = lookup_join(rows, turns.drop("newest_ms"), "window_end_ms", max_broadcast)
        late |= F.coalesce(F.col("close_at") < F.col(arrival), F.lit(False))
        refire |= F.coalesce(F.col("fire_at") < F.col(arrival), F.lit(False))
    return tagged.withColumn("lateness", F.when(late, "late").when(refire, "refire").otherwise("ontime")).drop("close_at")


def final_counts(classified: DataFrame, label: str = "window_end", arrival: str = "arrival") -> DataFrame:
    """Rows per window, type and area that were not late; ``fired`` tells whether it was ever emitted.

    ``label`` chooses the time printed, as in ``window_counts``.
    """
    counted = classified.where("lateness <> 'late'").groupBy(*KEY).agg(
        F.count("*").alias("count"), F.max(F.col("fire_at").isNotNull()).alias("fired"), *label_time(label, arrival)
    )
    time = format_ms("window_end_ms") if label == "window_end" else format_time(LABEL_TIME)
    return counted.select(time.alias("time"), "type", "area", "count", "fired")


def refire_changelog(classified: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Every emission of every fired window: ``(time, type, area, count, emitted_at)``.

    The first carries the count of the on-time rows; each refire adds one with the new full count.
    """
    counted = classified.where("lateness <> 'late' and fire_at is not null")
    # On-time rows have no arrival here: they fold into one row per window, ahead of its refires.
    counted = counted.select(
        *KEY, "fire_at", F.when(F.col("lateness") == "refire", F.col(arrival)).alias("refired_at"), F.lit(1).alias("count")
    )
    totals = running_total(counted, [*KEY, "fire_at"], "refired_at", "count")
    return totals.select(
        format_ms("window_end_ms").alias("time"),
        "type",
        "area",
        "count",
        F.coalesce("refired_at", "fire_at").alias("emitted_at"),
    )


def latest_docs(emissions: DataFrame, order: str = "emitted_at") -> DataFrame:
    """What a store keyed by document id holds after all ``emissions``: the last one of each id."""
    return emissions.groupBy("time", "type", "area").agg(F.max_by("count", order).alias("count"))
