"""The report pipeline over bounded input."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tidemark.operators.audit import bad_rows, good_rows, late_lines, parse_audit, slim
from tidemark.operators.joins import BROADCAST_BYTES
from tidemark.operators.lateness import classify_lateness, final_counts, refire_changelog
from tidemark.operators.windows import report_docs
from tidemark.settings import Timing
from tidemark.workspace import written


class Report(NamedTuple):
    classified: DataFrame
    bad: DataFrame
    label: str = "window_end"

    @property
    def counts(self) -> DataFrame:
        return final_counts(self.classified, self.label)

    @property
    def changelog(self) -> DataFrame:
        """Every emission, as the appending document store sees them, named by window end."""
        return report_docs(refire_changelog(self.classified))

    @property
    def upserted(self) -> DataFrame:
        """The documents left in a store keyed by document id: the last of each in the changelog.

        That is the final count of each fired window, so the changelog need not be worked out.
        """
        return report_docs(self.counts.where("fired").drop("fired"))

    @property
    def late(self) -> DataFrame:
        return late_lines(self.classified.where("lateness = 'late'"))


def report_messages(
    messages: DataFrame,
    timing: Timing = Timing(),
    times: str = "positive",
    label: str = "window_end",
    max_broadcast: int = BROADCAST_BYTES,
    source: str | None = None,
    sources: int = 1,
    lenient: bool = False,
) -> Report:
    """Audit texts ``value`` with their ``arrival`` to counts, documents, late lines and bad rows.

    The texts are read and parsed once, here; all outputs start from the parsed table in the shared
    folder, which is a fraction of the texts' size. With a column ``source`` of numbers below ``sources``,
    each source has a watermark of its own, and rows meet the least. ``lenient`` is as in ``parse_audit``.
    """
    parsed = written(slim(parse_audit(messages, times, lenient)), "parsed")
    classified = classify_lateness(good_rows(parsed), timing, max_broadcast=max_broadcast, source=source, sources=sources)
    return Report(classified, bad_rows(parsed), label)
