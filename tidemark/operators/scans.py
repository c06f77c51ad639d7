"""Running minimum and running total without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import written

BLOCK = 4096


def minimum_from_here_up(
    df: DataFrame, position: str, values: list[str], kept: list[Column], block: int = BLOCK
) -> DataFrame:
    """One row per ``position`` with the minimum of each of ``values`` over all rows at it or above.

    ``kept`` are aggregates over the rows at the position itself. Positions are whole numbers; they
    are scanned in blocks of ``block``, and the block minima are scanned once more. The second scan
    has no partitioning; it sees one row per block, and for minute windows even a century has only
    some 13,000 blocks.
    """
    # One shuffle by block serves the grouping, the scan inside the blocks and the block minima.
    blocked = df.withColumn("_block", F.floor(F.col(position) / block)).repartition("_block")
    points = blocked.groupBy("_block", position).agg(*[F.min(v).alias(v) for v in values], *kept)
    downwards = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = (
        points.groupBy("_block")
        .agg(*[F.min(v).alias(v) for v in values])
        .select("_block", *[F.min(v).over(downwards).alias(f"_above_{v}") for v in values])
    )
    inside = Window.partitionBy("_block").orderBy(F.col(position).desc())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = points.withColumns({v: F.min(v).over(inside) for v in values}).join(above, "_block")
    return scanned.withColumns({v: F.least(v, f"_above_{v}") for v in values}).drop(
        "_block", *[f"_above_{v}" for v in values]
    )


def running_total(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """One row per ``group`` and ``order`` with the total of ``value`` up to and including it.

    A null ``order`` comes first. Equal orders are summed before any shuffle. The rest is spread by
    ranges of (group, order), so a group of any size covers as many tasks as it needs; each range is
    totalled on its own and the totals of the ranges before it are added. The ranges are pinned by
    writing them to the shared folder.
    """
    summed = df.groupBy(*group, order).agg(F.sum(value).alias(value))
    ranged = written(
        summed.repartitionByRange(*group, F.col(order).asc_nulls_first()).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    # One row per group and range it touches: never more rows in a group than there are ranges.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*group, "_range")
        .agg(F.sum(value).alias("_sum"))
        .select(*group, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*group, "_range").orderBy(F.col(order).asc_nulls_first())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn(value, F.sum(value).over(inside))
        .join(offsets, [*group, "_range"])
        .select(*group, order, (F.col(value) + F.col("_offset")).alias(value))
    )
