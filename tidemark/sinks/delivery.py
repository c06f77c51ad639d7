"""Records with ids, so that a batch that was sent twice can be read once (``sources.messages.read_once``).

A topic takes a replayed batch a second time. Each record carries an id that depends on its batch and its
value alone, not on the order or the tasks of the sending, so the second sending has the same ids as the
first and the reader drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.writers import Sink

#: Equal records of a batch are numbered in runs of so many.
RUN = 1 << 16


def with_ids(records: DataFrame, batch_id: int) -> DataFrame:
    """``key``, ``value``: each ``value`` of a batch with its id.

    The id is the batch, a digest of the value, and a number that tells equal values of the batch apart. Equal
    values are counted before the shuffle and numbered from their count, in runs, so a value that is most of
    a batch passes through no task whole. A null value stays null and has an id, too.

    Runs are small where records are many, so they are dealt to the session's number of partitions as it
    stands: put together by their size, they would leave few tasks to write all records.
    """
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = records.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    last = F.call_function("div", F.col("n") - 1, F.lit(RUN).cast("long"))
    runs = counts.select("value", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("run"))
    runs = runs.repartition(parts, "value", "run")
    end = F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1
    digest = F.when(F.col("value").isNull(), "null").otherwise(F.sha2(F.col("value").cast("binary"), 256))
    # Worked out once for a run, below its explode.
    stems = runs.select("value", F.concat_ws("-", F.lit(str(batch_id)), digest, F.lit("")).alias("stem"), "run", end.alias("end"))
    numbered = stems.select("value", "stem", F.explode(F.sequence(F.col("run") * RUN, "end")).alias("number"))
    return numbered.select(F.concat("stem", F.col("number").cast("string")).alias("key"), "value")


def with_ids_sink(sink: Sink) -> Sink:
    """``sink`` given ``key`` and ``value``; as a ``kafka_sink`` it sends the id as the record's key."""

    def write(df: DataFrame, batch_id: int) -> None:
        sink(with_ids(df, batch_id), batch_id)

    return write
