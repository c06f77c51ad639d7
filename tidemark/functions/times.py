"""Time text to time and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.settings import TIME_FORMAT


#: Six numbers; blanks may stand before each, and anything after the last.
ROLLING = r"^([ \t]*\d{1,9}-[ \t]*\d{1,9}-[ \t]*\d{1,9} [ \t]*\d{1,9}:[ \t]*\d{1,9}:[ \t]*\d{1,9})(?!\d)"
DAY_SECONDS = 86_400
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799  # of the years 1 and 9999


def parse_time(text: Column | str, lenient: bool = False) -> Column:
    """Timestamp from ``yyyy-MM-dd HH:mm:ss`` in the session zone; anything else gives null.

    A ``lenient`` time needs no leading zeros and may be followed by any text; numbers beyond their
    range roll over, so month 13 is January of the next year, day 0 the last of the month before and
    minute 75 a quarter past the next hour. Signs, numbers of ten digits or more and times outside the years 1 to
    9999 still give null.
    """
    if not lenient:
        return F.try_to_timestamp(text, F.lit(TIME_FORMAT))
    numbers = F.regexp_extract_all(F.regexp_extract(text, ROLLING, 1), F.lit(r"\d+"), F.lit(0))
    # An array of one, so that the numbers are found once.
    return F.get(F.transform(F.array(F.transform(numbers, lambda n: n.cast("long"))), _rolled), 0)


def _rolled(numbers: Column) -> Column:
    """The moment of the numbers year, month, day, hour, minute, second; null if there are none."""
    year, month, day, hour, minute, second = (F.get(numbers, n) for n in range(6))
    months = year * 12 + month - 1
    rolled_year = F.call_function("div", months, F.lit(12).cast("long")).cast("int")
    first = F.when(months.between(12, 12 * 10_000 - 1), F.make_date(rolled_year, (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1)))
    seconds = (F.unix_date(first).cast("long") + day - 1) * DAY_SECONDS + hour * 3600 + minute * 60 + second
    moment = F.timestamp_seconds(F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds))
    return F.to_utc_timestamp(moment, F.current_timezone())


def format_time(moment: Column | str) -> Column:
    return F.date_format(moment, TIME_FORMAT)


def format_ms(ms: Column | str) -> Column:
    return format_time(F.timestamp_millis(ms))


def window_number(ms: Column, width_ms: int, shift_ms: int = 0) -> Column:
    """How many whole windows lie between the epoch and ``ms - shift_ms``, rounding down."""
    # DIV on longs stays exact where a division through doubles would not.
    moved = ms - F.lit(shift_ms).cast("long")
    width = F.lit(width_ms).cast("long")
    return F.call_function("div", moved - F.pmod(moved, width), width)
