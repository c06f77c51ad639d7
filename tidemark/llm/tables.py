"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType

from tidemark.operators.joins import lookup_join
from tidemark.workspace import setting, table_path

SLICE_BYTES = 1 << 21
#: Rows that go to a Python worker at once while a table is written.
BATCH_ROWS = 2000
#: A table to look rows up in is broadcast up to about so many bytes; beyond that both sides are shuffled.
BROADCAST_BYTES = 8 << 20
#: Rows with whole texts are spread beyond so many of one key.
ROWS_PER_SALT = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns alone, cast to their ``kinds``, whatever else ``df`` holds.

    Columns are found by place, so others whose names differ in case only, or repeat, do no harm: the
    first of the exact name counts, else the first that is equal but for case.
    """
    plain, *places = numbered(df, *kinds)
    return plain.select(*[F.col(place).cast(kind).alias(name) for place, (name, kind) in zip(places, kinds.items())])


def numbered(df: DataFrame, *needed: str) -> tuple:
    """``df`` with its columns renamed c0, c1, ... in order, and what the ``needed`` ones are called now, as ``picked`` finds them."""
    lowered = [c.lower() for c in df.columns]
    places = [df.columns.index(name) if name in df.columns else lowered.index(name.lower()) for name in needed]
    return df.toDF(*[f"c{n}" for n in range(len(lowered))]), *[f"c{n}" for n in places]


def renamed(plain: DataFrame, names: list[str]) -> DataFrame:
    """The columns c0, c1, ... of ``plain`` under their own names again."""
    return plain.select(*[f"c{n}" for n in range(len(names))]).toDF(*names)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 marks the held-out rows. A null id counts as the text ""."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


HELD_OUT = 2


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, so that working arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in one array, and where each text starts and ends. Null: empty."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a zstd table in the shared folder, computed once; lost executors do not lose it, and ``scratch`` drops it."""
    path = table_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def given_back() -> None:
    """Give this process's free memory back to the system; of the heap, only glibc can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors, whose workers give back what they no longer use."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            given_back()

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def _size(kind: DataType, column: Column) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, StringType | BinaryType):
        return F.octet_length(column).cast("long")
    if isinstance(kind, ArrayType):
        return F.size(column).cast("long") * 8
    return F.lit(8).cast("long")


def table_bytes(table: DataFrame) -> int:
    """About how many bytes the rows of a table take, from the lengths of its texts and lists."""
    parts = [F.coalesce(_size(f.dataType, F.col(f"`{f.name}`")), F.lit(8).cast("long")) for f in table.schema.fields]
    return table.agg(F.sum(reduce(Column.__add__, parts))).first()[0] or 0


def looked_up(
    table: DataFrame, keys: DataFrame, on: str, how: str, rows_per_salt: int = ROWS_PER_SALT, size: int | None = None
) -> DataFrame:
    """A left, left_semi or left_anti join of ``table`` with ``keys``, whose ``on`` values are unique: a stored table,
    or one of which ``size`` says how many bytes it takes at most.

    Small keys are broadcast. Beyond ``BROADCAST_BYTES`` both sides are shuffled, and of ``table`` the rows of
    a key with over ``rows_per_salt`` are spread. A null ``on`` finds nothing.
    """
    if (table_bytes(keys) if size is None else size) <= BROADCAST_BYTES:
        return table.join(F.broadcast(keys), on, how)
    if how == "left":
        return lookup_join(table, keys, on, 0, rows_per_salt)
    found = lookup_join(table, keys.select(on, F.lit(True).alias("_found")), on, 0, rows_per_salt)
    return found.where("_found" if how == "left_semi" else "_found is null").select(table.columns)
