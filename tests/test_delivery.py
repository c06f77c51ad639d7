"""A batch that is sent twice is read once."""

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import delivery
from tidemark.sinks.delivery import with_ids, with_ids_sink
from tidemark.sinks.writers import folder_sink, read_folder
from tidemark.sources.messages import ON_DISK, keys_on_disk, read_once
from tidemark.streaming.replay import NOW
from tidemark.workspace import shared_folder

VALUES = ["a"] * 700 + ["b"] * 3 + ["", "", None, None, "c"]


def ids(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("run", [1 << 16, 64])
def test_ids_depend_on_batch_and_values_alone(spark, values, monkeypatch, run):
    monkeypatch.setattr(delivery, "RUN", run)
    sent = ids(with_ids(values(*VALUES).repartition(3), 4))
    shuffled = VALUES[:]
    random.Random(1).shuffle(shuffled)
    assert ids(with_ids(values(*shuffled).coalesce(1), 4)) == sent
    assert Counter(value for _, value in sent) == Counter(VALUES)
    assert len({key for key, _ in sent}) == len(VALUES)
    assert not {key for key, _ in sent} & {key for key, _ in ids(with_ids(values(*VALUES), 5))}
    assert with_ids(values("a").limit(0), 1).collect() == []


def test_replayed_batches_are_read_once(spark, values, tmp_path):
    """Batch 1 is lost half way and sent again, batch 2 is sent again after batch 3; the stream stops in between."""

    def append(df, batch_id):
        df.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(f"{tmp_path}/log")

    def read():
        log = spark.readStream.schema("key string, value string, timestamp timestamp").parquet(f"{tmp_path}/log")
        query = read_once(log).writeStream.foreachBatch(folder_sink(f"{tmp_path}/out"))
        query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(**NOW).start().awaitTermination()

    send = with_ids_sink(append)
    batches = {n: values(*VALUES, f"only {n}") for n in range(4)}
    send(batches[0], 0)
    append(with_ids(batches[1], 1).where(F.col("value") == "a").limit(300), 1)
    send(batches[1], 1)
    read()
    for n in (1, 2, 3, 2):
        send(batches[n], n)
    read()
    expected = Counter(VALUES * 4 + [f"only {n}" for n in range(4)])
    got = read_folder(spark, f"{tmp_path}/out", "value string")
    assert Counter(row["value"] for row in got.collect()) == expected
    table = read_once(spark.read.parquet(f"{tmp_path}/log"))
    assert Counter(row["value"] for row in table.collect()) == expected and table.columns == ["key", "value", "timestamp"]


def test_many_records_of_few_values_are_dealt_to_many_tasks(spark):
    """The runs of 50 values are too small to be dealt by their size, the records that they stand for are not."""
    records = spark.range(200_000).select((F.col("id") % 50).cast("string").alias("value"))
    assert with_ids(records, 1).groupBy(F.spark_partition_id()).count().count() == 4


def stores(checkpoint):
    return {os.path.splitext(path)[1] for path in glob.glob(f"{checkpoint}/state/0/*/**", recursive=True)} & {".delta", ".changelog"}


def test_keys_on_disk(spark, values, tmp_path):
    """What was read before a stop is known after it, though that stream is started as usual."""

    def append(df, batch_id):
        df.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(f"{tmp_path}/log")

    def read():
        log = spark.readStream.schema("key string, value string, timestamp timestamp").parquet(f"{tmp_path}/log")
        query = read_once(log).writeStream.foreachBatch(folder_sink(f"{tmp_path}/out"))
        query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(**NOW).start().awaitTermination()

    send, before = with_ids_sink(append), [spark.conf.get(key, None) for key in ON_DISK]
    send(values(*VALUES), 0)
    with keys_on_disk(spark):
        read()
    assert [spark.conf.get(key, None) for key in ON_DISK] == before
    send(values(*VALUES), 0)
    send(values("new"), 1)
    read()
    assert stores(f"{tmp_path}/checkpoint") == {".changelog"}
    got = read_folder(spark, f"{tmp_path}/out", "value string")
    assert Counter(row["value"] for row in got.collect()) == Counter([*VALUES, "new"])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_the_query_keeps_its_keys_on_disk(spark):
    import __spark_entry__ as spark_entry

    folders = lambda: set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/tidemark/delivery-*"))
    before = folders()
    spark_entry.queries()["stream_delivered_once"](spark, "/root/testdata/sf0.001")
    (folder,) = folders() - before
    assert stores(f"{folder}/checkpoint") == {".changelog"}


def test_messages_without_a_key_stay(spark):
    table = spark.createDataFrame([(None, "a", 1), (None, "a", 1), ("k", "b", 1), ("k", "b", 2)], "key string, value string, timestamp long")
    assert sorted(row["value"] for row in read_once(table).collect()) == ["a", "a", "b"]
