"""Text splitting and joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_codes(codes: Column | str) -> Column:
    """Comma-separated parts, untrimmed; empty parts at the end are dropped, others kept."""
    # An empty text still has one (empty) part, a text of commas only has none.
    parts = F.split(F.regexp_replace(codes, ",+$", ""), ",")
    return F.when(F.regexp_like(codes, F.lit("^,+$")), F.array().cast("array<string>")).otherwise(parts)


def tab_line(*parts: Column) -> Column:
    """Parts joined by tabs; a null part prints as ``null``."""
    return F.concat_ws("\t", *[F.coalesce(part.cast("string"), F.lit("null")) for part in parts])


def document_id(time: Column, kind: Column, area: Column) -> Column:
    return F.concat_ws("-", F.replace(time, F.lit(" "), F.lit("_")), kind, area)
