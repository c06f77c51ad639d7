"""Lookup join against a table that is usually, but not certainly, small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
#: Rows of one key beyond which its rows are spread, so many to a part.
ROWS_PER_SALT = 1_000_000


def lookup_join(
    rows: DataFrame, table: DataFrame, on: str, max_broadcast: int = BROADCAST_BYTES, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Left join of ``rows`` to ``table``, whose ``on`` values are unique.

    A table of up to ``max_broadcast`` bytes, counted as JSON text, is broadcast and ``rows`` are not
    shuffled. Beyond that the rows of each key are counted, combined before the shuffle, and only the
    keys with more than ``rows_per_salt`` rows are spread: over as many parts as their share needs, with
    their one table row repeated as often. All other keys join as they are.

    The table is measured here, so pass one that is cheap to read (a written table or a file).
    ``rows`` are read twice then, and should come from a scan: the salt follows the row order of its task.
    """
    if max_broadcast > 0 and _bytes(table) <= max_broadcast:
        return rows.join(F.broadcast(table), on, "left")
    counted = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_salt)
    hot = counted.select(on, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts"))
    # There are at most (all rows) / rows_per_salt hot keys.
    hot = F.broadcast(hot)
    salt: Column = F.when(F.col("_salts").isNotNull(), (F.monotonically_increasing_id() % F.col("_salts")).cast("int")).otherwise(0)
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    salted = rows.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    repeated = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")
    return salted.join(repeated, [on, "_salt"], "left").drop("_salt")


def _bytes(table: DataFrame) -> int:
    return table.agg(F.sum(F.length(F.to_json(F.struct("*"))).cast("long"))).first()[0] or 0
