"""Sinks for batch output and for ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workspace import drop_folder, has_folder

Sink = Callable[[DataFrame, int], None]


def folder_sink(path: str, fmt: str = "parquet", few_files: bool = False) -> Sink:
    """One folder per batch id. Writing a batch again replaces it, so a replay changes nothing.

    ``few_files`` is for output that is sparse among its input, such as late or bad rows: it is
    shuffled into files of a fair size rather than written as a file per input task.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if few_files:
            df = df.hint("rebalance")
        df.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def read_folder(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """All batches written by ``folder_sink``, with their ``batch_id``."""
    return spark.read.schema(f"{schema}, batch_id bigint").format(fmt).load(path)


def kafka_sink(topic: str, servers: str) -> Sink:
    """Sends the ``value`` column, and ``key`` if there is one. A replayed batch is sent again: delivery is at least once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.select(*[c for c in ("key", "value") if c in df.columns]).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def console_sink() -> Sink:
    """Prints every row, each from the task that has it: on the executors' output, or here in local mode. For debugging."""

    def write(df: DataFrame, batch_id: int) -> None:
        def show(rows: Iterator[str]) -> None:
            for row in rows:
                print(f"batch {batch_id}: {row}", flush=True)

        df.toJSON().foreachPartition(show)

    return write


INDEX = "day string, version bigint"


def upsert_sink(path: str) -> Sink:
    """The current documents (``report_docs``): one for each ``doc_id``, the last emitted.

    A batch rewrites only the window days that it has documents of, starting from the index its
    predecessor left, and leaves an index of its own: which batch wrote each day last. So a batch that
    is run again does the same again, and a reader goes by one index. What no index of the last two
    batches names is dropped.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before, earlier = (_index(spark, path, batch_id - n) for n in (1, 2))
        fresh = df.withColumn("day", F.substring("time", 1, 10))
        days = [row["day"] for row in fresh.select("day").distinct().collect()]  # window days of one batch
        if days:
            held = [f"{path}/docs/{before[day]}/day={day}" for day in days if day in before]
            # Columns by name, the day from the time text: a day read by itself has no folder column.
            columns = [name for name in fresh.columns if name != "day"]
            old = spark.read.schema(fresh.select(columns).schema).parquet(*held) if held else fresh.select(columns).limit(0)
            both = fresh.select(*columns, F.lit(1).alias("turn")).union(old.select(*columns, F.lit(0).alias("turn")))
            latest = both.groupBy("doc_id").agg(F.max_by(F.struct(*columns), "turn").alias("doc")).select("doc.*")
            latest = latest.withColumn("day", F.substring("time", 1, 10)).repartition("day")
            latest.write.mode("overwrite").partitionBy("day").parquet(f"{path}/docs/{batch_id}")
        index = before | dict.fromkeys(days, batch_id)
        listed = spark.createDataFrame(sorted(index.items()), INDEX).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{path}/index/batch_id={batch_id}")
        for day, version in earlier.items():
            if before.get(day) != version:
                drop_folder(spark, f"{path}/docs/{version}/day={day}")
        drop_folder(spark, f"{path}/index/batch_id={batch_id - 2}")

    return write


def _index(spark: SparkSession, path: str, batch_id: int) -> dict[str, int]:
    """Which batch last wrote each day, as of a batch: one row for each day that has documents."""
    if batch_id < 0 or not has_folder(spark, f"{path}/index/batch_id={batch_id}"):
        return {}
    rows = spark.read.schema(INDEX).parquet(f"{path}/index/batch_id={batch_id}").collect()
    return {row["day"]: row["version"] for row in rows}


def read_upserted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The documents that ``upsert_sink`` holds now."""
    batches = spark.read.schema(f"{INDEX}, batch_id bigint").parquet(f"{path}/index")
    last = batches.agg(F.max("batch_id")).first()[0]
    index = {} if last is None else _index(spark, path, last)
    folders = [f"{path}/docs/{version}/day={day}" for day, version in index.items()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def all_of(*sinks: Sink) -> Sink:
    def write(df: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(df, batch_id)

    return write


def documents(log: DataFrame, mode: str = "append") -> DataFrame:
    """The report documents in a log of emissions.

    ``append``: every emission is a document. ``upsert``: one per ``doc_id``, the last emitted.
    """
    if mode == "append":
        return log
    if mode != "upsert":
        raise ValueError(f"mode must be 'append' or 'upsert', not {mode!r}")
    latest = log.groupBy("doc_id", "time", "type", "area").agg(F.max_by("count", "batch_id").alias("count"))
    return latest.withColumn("document", F.to_json(F.struct("time", "type", "area", "count")))
