"""Text messages from Kafka, text files or any table with a ``value`` column."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workspace import setting

# Fixed value: how the connector marks times set by the broker.
LOG_APPEND_TIME = 1

_STORE = "spark.sql.streaming.stateStore"
#: State in files of the executors rather than in their memory. A batch is saved as what it changed; the
#: filters of the files stay cached; and rows are not counted, for which each would be looked up once more.
ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.blockCacheSizeMB": "64",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
#: Bytes of SHA-256 by which a key is remembered.
DIGEST = 16


def read_messages(
    spark: SparkSession,
    fmt: str,
    streaming: bool = False,
    schema: str | None = None,
    once: str | None = None,
    **options: str,
) -> DataFrame:
    """One ``value`` text per message, and ``arrival`` where the source knows it.

    ``fmt='kafka'`` needs ``subscribe`` and ``kafka.bootstrap.servers`` (keyword names with dots go
    in as ``**{'kafka.bootstrap.servers': ...}``) and the Kafka connector on the class path; see
    ``kafka_messages`` for its arrival. ``fmt='text'`` takes each line as a message. Other formats
    must hold a ``value`` column; for streams give their ``schema``. With ``once``, a span of time such as
    ``1 hour``, records that were sent again within it are left out (``read_once``); they must have ``key`` and ``timestamp``.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.load()
    if once is not None:
        raw = read_once(raw, horizon=once)
    if fmt == "kafka":
        return kafka_messages(raw)
    kept = [name for name in ("arrival",) if name in raw.columns]
    return raw.select(F.col("value").cast("string").alias("value"), *kept)


def kafka_messages(records: DataFrame) -> DataFrame:
    """Kafka records to messages; keys and offsets are not used here.

    ``arrival`` is the record's time in microseconds where the broker set it (log-append time). A
    producer's clock says nothing of the order in which records are read, so such a record has no
    arrival of its own: it came with its micro-batch.
    """
    appended = F.col("timestampType") == LOG_APPEND_TIME
    return records.select(
        F.col("value").cast("string").alias("value"), F.when(appended, F.unix_micros("timestamp")).alias("arrival")
    )


@contextmanager
def keys_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state, such as the keys of ``read_once``, on the executors' disks.

    Spark's default keeps it in their memory: some 200 bytes for each key of the horizon. A stream goes on
    with the kind of state that its checkpoint was begun with.
    """
    with ExitStack() as held:
        for key, value in ON_DISK.items():
            held.enter_context(setting(spark, key, value))
        yield


def read_once(messages: DataFrame, key: str = "key", sent: str = "timestamp", horizon: str = "1 hour") -> DataFrame:
    """``messages`` without those whose ``key`` came before, in a stream or a table.

    A stream remembers a key for ``horizon`` after the time it was ``sent``: a batch must be replayed within that.
    It does so by a watermark, for which that of the built-in report would wait, too; the other jobs have none.
    Keys are told apart by 128 bits of SHA-256, so one takes 16 bytes however long it is; start streams with
    many of them inside ``keys_on_disk``.
    Messages without a key stay as they are, all of them.
    """
    # Those without a key get one of their own, which no other has.
    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("none "), F.uuid()))
    keyed = messages.withColumn("_id", F.substring(F.unhex(F.sha2(own.cast("binary"), 256)), 1, DIGEST))
    if messages.isStreaming:
        found = keyed.withWatermark(sent, horizon).dropDuplicatesWithinWatermark(["_id"])
    else:
        found = keyed.dropDuplicates(["_id"])
    return found.drop("_id")
