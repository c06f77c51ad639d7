from collections import Counter

import pytest
from model import as_table, random_rows, time_text

from tidemark.operators.windows import report_docs, sorted_event_times, window_counts
from tidemark.settings import Timing

BASE = 1_704_067_200_000
TEN = Timing(window_ms=10_000)


@pytest.fixture(scope="module")
def rows():
    # Whole seconds, as the audit texts have.
    made = random_rows(7, span_ms=60_000, low=BASE)
    return [(n, arrival, ms // 1000 * 1000, kind, area) for n, arrival, ms, kind, area in made]


def grouped(rows):
    groups = {}
    for row in sorted(rows, key=lambda row: row[1]):
        groups.setdefault(((row[2] // 10_000 + 1) * 10_000, row[3], row[4]), []).append(row[2])
    return groups


@pytest.mark.parametrize(
    "label, time",
    [
        ("window_end", lambda end, times: end),
        ("max_event", lambda end, times: max(times)),
        ("last_event", lambda end, times: times[-1]),
    ],
)
def test_counts_and_labels(spark, rows, label, time):
    got = window_counts(as_table(spark, rows), TEN, label).collect()
    expected = [(time_text(time(key[0], times)), *key[1:], len(times)) for key, times in grouped(rows).items()]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_window_borders(spark):
    rows = [(0, 0, BASE, "a", "A"), (1, 1, BASE + 59_999, "a", "A"), (2, 2, BASE + 60_000, "a", "A")]
    got = {row["time"][11:]: row["count"] for row in window_counts(as_table(spark, rows)).collect()}
    assert got == {"00:01:00": 2, "00:02:00": 1}


def test_unknown_label(spark):
    with pytest.raises(ValueError):
        window_counts(as_table(spark, []), label="first")


def test_sorted_event_times(spark, rows):
    got = sorted_event_times(as_table(spark, rows), TEN).collect()
    expected = []
    for (end, kind, area), times in grouped(rows).items():
        for ms, copies in Counter(times).items():
            expected.append((time_text(end), kind, area, time_text(ms), copies, sorted(times).index(ms) + 1))
    assert sorted(map(tuple, got)) == sorted(expected)


def test_documents(spark):
    docs = report_docs(window_counts(as_table(spark, [(0, 0, BASE, "login", "NORTH")])))
    row = docs.first()
    assert row["doc_id"] == "2024-01-01_00:01:00-login-NORTH"
    assert row["document"] == '{"time":"2024-01-01 00:01:00","type":"login","area":"NORTH","count":1}'
