"""The area dimension, re-read from time to time."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.areas import invert_areas
from tidemark.settings import AREA_REFRESH_SECONDS
from tidemark.workspace import drop_folder, has_folder, new_folder

log = logging.getLogger(__name__)

CODES = "country_code string, area string"


class AreaSnapshots:
    """Hands out the country-to-area table, renewed once it is older than ``max_age`` seconds.

    ``load`` returns the current ``(area, codes)`` rows. Each renewal replaces the whole table by a
    written copy, so a job in flight keeps the one it started with. The last ``keep`` copies stay, for
    other jobs that share the object. If ``load`` fails or finds no rows, the last good table stays.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        max_age: float = AREA_REFRESH_SECONDS,
        clock: Callable[[], float] = time.monotonic,
        keep: int = 10,
    ):
        self._load = load
        self._max_age = max_age
        self._clock = clock
        self._keep = keep
        self._table: DataFrame | None = None
        self._folders: list[str] = []
        self._loaded_at = 0.0

    def current(self) -> DataFrame:
        if self._table is None or self._clock() - self._loaded_at >= self._max_age:
            self.refresh()
        return self._table

    def refresh(self) -> None:
        spark = folder = None
        try:
            codes = invert_areas(self._load())
            spark = codes.sparkSession
            folder = new_folder(spark, "areas")
            codes.write.parquet(folder)
            fresh = spark.read.schema(codes.schema).parquet(folder)
            empty = fresh.isEmpty()
        except Exception:
            if folder is not None:
                drop_folder(spark, folder)
            if self._table is None:
                raise
            log.exception("cannot read the area table, keeping the last one")
            return
        self._loaded_at = self._clock()
        if empty:
            log.warning("the area table is empty")
            if self._table is not None:
                drop_folder(spark, folder)
                return
        self._table = fresh
        self._folders.append(folder)
        if len(self._folders) > self._keep:
            drop_folder(spark, self._folders.pop(0))


class PinnedAreas:
    """Says which area table a micro-batch uses, and says the same when the batch runs again.

    ``folder``, beside the query's checkpoint, holds ``versions``, the tables that batches have used, and
    ``batches``, for each batch the version it read first. Both outlive the job: a batch that failed, or
    whose end the checkpoint doesn't know of, meets the table it met before, whatever the source has become. Where the
    source can't be read when a job starts, the last version used stays in force.

    The last ``keep`` batches stay listed, and so do the versions that they name.
    """

    def __init__(self, areas: AreaSnapshots, folder: str, keep: int = 100):
        self._areas = areas
        self._folder = folder
        self._keep = keep
        self._written: tuple[DataFrame, int] | None = None

    def for_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        version = self._named(spark, batch_id)
        if version is None:
            version = self._newest(spark, batch_id)
            named = spark.createDataFrame([(version,)], "version bigint").coalesce(1)
            named.write.mode("overwrite").parquet(f"{self._folder}/batches/{batch_id}")
            self._forget(spark, batch_id - self._keep, batch_id)
        return spark.read.schema(CODES).parquet(f"{self._folder}/versions/{version}")

    def _named(self, spark: SparkSession, batch_id: int) -> int | None:
        """The version that a batch has read; None if it hasn't got so far."""
        path = f"{self._folder}/batches/{batch_id}"
        if batch_id < 0 or not has_folder(spark, f"{path}/_SUCCESS"):
            return None
        return spark.read.schema("version bigint").parquet(path).first()["version"]

    def _newest(self, spark: SparkSession, batch_id: int) -> int:
        """Called after the batch that first uses it; the one before if the source has not changed or can't be read."""
        try:
            table = self._areas.current()
        except Exception:
            before = self._named(spark, batch_id - 1)
            if before is None:
                raise
            log.exception("cannot read the area table, going on with that of the batch before")
            return before
        if self._written is None or self._written[0] is not table:
            table.write.mode("overwrite").parquet(f"{self._folder}/versions/{batch_id}")
            self._written = table, batch_id
        return self._written[1]

    def _forget(self, spark: SparkSession, old: int, batch_id: int) -> None:
        gone = self._named(spark, old)
        if gone is None:
            return
        drop_folder(spark, f"{self._folder}/batches/{old}")
        # Versions only rise, so the oldest batch left names the oldest version that is still needed.
        if self._named(spark, old + 1) != gone:
            drop_folder(spark, f"{self._folder}/versions/{gone}")
