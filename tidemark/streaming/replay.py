"""Feed a bounded table to a streaming job, part by part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.workspace import drop_folder, has_folder

Started = StreamingQuery | tuple[StreamingQuery, ...]
NOW = {"availableNow": True}


def replay(messages: DataFrame, part: Column, parts: int, incoming: str, start: Callable[[], Started]) -> None:
    """Feed the messages whose ``part`` is 0, 1, ... below ``parts`` (null: the last) to a job that reads ``incoming``.

    They are written once, by part. For each part in turn its files are put into ``incoming``, then the
    job runs until it has caught up. ``start`` starts the job's query, or queries, which resume from
    their checkpoints.

    All files of a part are there before the job looks, and file sources without a limit take all
    new files at once: one part is one micro-batch, however many files it has.
    """
    spark = messages.sparkSession
    staged = f"{incoming}-staged"
    last = F.lit(parts - 1)
    numbered = messages.withColumn("_part", F.least(F.coalesce(part.cast("int"), last), last))
    numbered.write.partitionBy("_part").parquet(staged)
    for n in range(parts):
        if has_folder(spark, f"{staged}/_part={n}"):
            spark.read.schema(messages.schema).parquet(f"{staged}/_part={n}").write.mode("append").parquet(incoming)
        elif not has_folder(spark, incoming):
            messages.limit(0).write.parquet(incoming)
        queries = start()
        for query in queries if isinstance(queries, tuple) else (queries,):
            query.awaitTermination()
    drop_folder(spark, staged)
