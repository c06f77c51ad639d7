"""Defaults of the two jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Topic and index names, time text format, label for unmapped countries, refresh period.
ENVELOPE_TOPIC = "allData"
CLEAN_TOPIC = "allDataClean"
AUDIT_TOPIC = "auditLog"
LATE_TOPIC = "lateLog"
REPORT_INDEX = "auditindex"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
OTHER_AREA = "other"
AREA_REFRESH_SECONDS = 60


@dataclass(frozen=True)
class Timing:
    """Event-time rules of the report, in milliseconds.

    ``window_ms``: width of the tumbling windows; ``delay_ms``: how far the watermark trails the
    largest event time seen; ``lateness_ms``: how long a fired window still takes corrections.
    """

    window_ms: int = 60_000
    delay_ms: int = 10_000
    lateness_ms: int = 30_000

    @property
    def fire_after_ms(self) -> int:
        """A window ending at E has fired once an event time >= E + this has been seen."""
        return self.delay_ms - 1

    @property
    def close_after_ms(self) -> int:
        """A window ending at E takes no more rows once an event time >= E + this has been seen."""
        return self.lateness_ms + self.delay_ms - 1
