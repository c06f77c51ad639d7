"""Costly expressions, evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with ``column`` added as ``name``, computed once per row whatever is done with it later.

    The optimizer merges a plain projection into the filters above it, which then parse the same text
    again for each field they test. It does not reach through an explode.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
