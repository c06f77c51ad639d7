"""Row-by-row account of the report, to check the set-based operators against."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import UTC, datetime
from itertools import groupby

from tidemark.settings import Timing


def play(rows, timing: Timing, seen=0, source_of=lambda number: 0, sources=1):
    """``rows`` are ``(id, arrival, ms, type, area)``. Returns classes by id, final counts, emissions.

    Rows of equal arrival meet the same watermark, the least of the sources'. Emissions are
    ``(end, type, area, count, arrival)``.
    """
    newest = [seen] * sources
    classes, counts, emissions, fired = {}, defaultdict(int), [], set()
    for arrival, together in groupby(sorted(rows, key=lambda row: row[1]), key=lambda row: row[1]):
        together = list(together)
        watermark = min(newest) - timing.delay_ms
        corrected = set()
        for number, _, ms, kind, area in together:
            end = (ms // timing.window_ms + 1) * timing.window_ms
            if end - 1 + timing.lateness_ms <= watermark:
                classes[number] = "late"
                continue
            refire = end - 1 <= watermark
            classes[number] = "refire" if refire else "ontime"
            counts[end, kind, area] += 1
            if refire:
                corrected.add((end, kind, area))
        for key in corrected:
            emissions.append((*key, counts[key], arrival))
            fired.add(key)
        for number, _, ms, *_ in together:
            newest[source_of(number)] = max(newest[source_of(number)], ms)
        for key in counts:
            if key not in fired and key[0] - 1 <= min(newest) - timing.delay_ms:
                fired.add(key)
                emissions.append((*key, counts[key], arrival))
    return classes, dict(counts), sorted(emissions)


def random_rows(seed, n=400, span_ms=20_000, keys=3, ties=False, low=0):
    """Rows around the epoch plus ``low``, mostly in order, one key holding most of them."""
    rng = random.Random(seed)
    rows = []
    for number in range(n):
        ms = low + number * span_ms // n + rng.randint(-1500, 300) * (rng.random() < 0.4)
        arrival = number // 7 if ties else number
        kind = "hot" if rng.random() < 0.6 else f"k{rng.randrange(keys)}"
        rows.append((number, arrival, ms, kind, "A"))
    return rows


def as_table(spark, rows):
    df = spark.createDataFrame(rows, "event_id bigint, arrival bigint, ms bigint, type string, area string")
    return df.selectExpr("event_id", "arrival", "timestamp_millis(ms) AS event_time", "type", "area")



def time_text(ms):
    return datetime.fromtimestamp(ms // 1000, UTC).strftime("%Y-%m-%d %H:%M:%S")
