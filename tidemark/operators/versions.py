"""Lookup in a table as it was when a row arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.texts import split_codes
from tidemark.operators.joins import BROADCAST_BYTES, ROWS_PER_SALT, lookup_join
from tidemark.workspace import written


def invert_versions(log: DataFrame) -> DataFrame:
    """``(version, area, codes)`` rows to one ``(version, country_code, area)`` row per version and code.

    A version is the moment from which its rows count. A code listed under several areas of a version
    goes to the alphabetically last one.
    """
    codes = log.select("version", "area", F.explode(split_codes("codes")).alias("country_code"))
    return codes.where("version is not null").groupBy("version", "country_code").agg(F.max("area").alias("area"))


def version_blocks(versions: DataFrame) -> tuple[DataFrame, int, int, int] | None:
    """The moments of a table's versions by blocks of time, and the first and last moment and the width of a block.

    Each row, ``(block, moments)``, has the ascending moments of the versions that begin in its block and,
    first, the one in force when the block begins. There are about as many blocks as versions, so a block
    has two moments or so where versions come regularly. None without versions.
    """
    moments = versions.select(F.col("version").cast("long").alias("version")).distinct()
    first, last, n = moments.agg(F.min("version"), F.max("version"), F.count(F.lit(1))).first()
    if not n:
        return None
    width = max(1, -(-(last - first + 1) // n))
    block = F.call_function("div", F.col("version") - first, F.lit(width))
    own = moments.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list("version")).alias("own"), F.max("version").alias("newest"))
    every = moments.sparkSession.range((last - first) // width + 1).select(F.col("id").alias("block"))
    # One row for each block: no more than there are versions.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    held = every.join(own, "block", "left").select("block", "own", F.max("newest").over(before).alias("before"))
    both = F.concat(F.array_compact(F.array("before")), F.coalesce("own", F.array().cast("array<bigint>")))
    return held.select("block", both.alias("moments")), first, last, width


def as_of_lookup(
    rows: DataFrame,
    versions: DataFrame,
    on: str,
    arrival: str,
    max_broadcast: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left join of ``rows`` to the version of a table that was in force when each row arrived.

    ``versions`` has ``version`` (from when it counts, in the units of ``arrival``), ``on`` and other
    columns, unique by version and ``on``; a moment without any row is no version, so the one before
    stays in force. A row that came before the first version, or whose arrival is null, finds nothing.

    Two lookups, both by equal keys and each measured: from the block of time that a row came in to the
    version in force, and from version and key to the row of the table. Up to ``max_broadcast`` bytes the
    tables are broadcast and ``rows`` are not shuffled; beyond that hot keys are spread.
    """
    versions = written(versions, "versions")
    blocks = version_blocks(versions)
    added = [c for c in versions.columns if c not in ("version", on)]
    if blocks is None:
        return rows.withColumns({c: F.lit(None).cast(versions.schema[c].dataType) for c in added})
    table, first, last, width = blocks
    at = F.col(arrival).cast("long")
    # A row that came after the last version began is in its block.
    block: Column = F.when(at >= first, F.call_function("div", F.least(at, F.lit(last)) - first, F.lit(width)))
    table = written(table.select(F.col("block").alias("_block"), F.col("moments").alias("_moments")), "blocks")
    found = lookup_join(rows.withColumn("_block", block), table, "_block", max_broadcast, rows_per_salt)
    in_force = F.array_max(F.filter("_moments", lambda moment: moment <= at))
    keyed = found.withColumn("_key", F.struct(in_force.alias("version"), F.col(on).alias("on"))).drop("_block", "_moments")
    own = versions.select(F.struct(F.col("version").cast("long").alias("version"), F.col(on).alias("on")).alias("_key"), *added)
    return lookup_join(keyed, written(own, "versions"), "_key", max_broadcast, rows_per_salt).drop("_key")
