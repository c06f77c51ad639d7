"""Token ids as files of shuffled planes.

A shard holds the ids of a range of documents in ascending order of doc_id. Its ids are cut into
blocks of a fixed number; a block is transposed into byte planes (or bit planes), each compressed on
its own with zstandard, so that the nearly empty high planes cost nothing. Layout of a shard:

    MAGIC | planes of block 0 | planes of block 1 | ... | index (JSON, zstandard) | its length (8 bytes) | MAGIC

The index names the kind of planes, the ids in a block, each block's place, its number of ids and its
planes' compressed lengths, and each document's id and number of ids. A block can be read without the others.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import encoder
from tidemark.llm.tables import map_arrow, slices, stored

MAGIC = b"TIDEBITS"
BLOCK = 1 << 16
ENCODE_BYTES = 8 << 20
READ_BYTES = 4 << 20


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, i]).tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    parts = [np.frombuffer(p, np.uint8) for p in planes]
    if kind == "byte":
        return np.stack(parts, axis=1).reshape(-1).view("<u4")
    bits = np.stack([np.unpackbits(p, count=n) for p in parts], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class ShardWriter:
    def __init__(self, path: str, kind: str = "byte", block: int = BLOCK):
        system, self.path = fs.FileSystem.from_uri(path)
        system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(self.path)
        self.file.write(MAGIC)
        self.kind, self.block, self.at = kind, block, len(MAGIC)
        self.blocks: list[list] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.codec = zstandard.ZstdCompressor(level=1)

    def add(self, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.sizes += sizes
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            held = np.concatenate(self.waiting)
            full = len(held) // self.block * self.block
            for i in range(0, full, self.block):
                self._put(held[i : i + self.block])
            self.waiting, self.held = [held[full:]], len(held) - full

    def _put(self, ids: np.ndarray) -> None:
        planes = [self.codec.compress(p) for p in to_planes(ids, self.kind)]
        self.blocks.append([self.at, len(ids), [len(p) for p in planes]])
        for plane in planes:
            self.file.write(plane)
            self.at += len(plane)

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        index = {"kind": self.kind, "block": self.block, "blocks": self.blocks, "docs": self.docs, "sizes": self.sizes}
        packed = self.codec.compress(json.dumps(index).encode())
        self.file.write(packed)
        self.file.write(len(packed).to_bytes(8, "little"))
        self.file.write(MAGIC)
        self.file.close()


class ShardReader:
    def __init__(self, path: str):
        system, own = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(own)
        end = self.file.size()
        tail = self._at(end - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a whole shard: {path}")
        size = int.from_bytes(tail[:8], "little")
        self.index = json.loads(zstandard.ZstdDecompressor().decompress(self._at(end - 16 - size, size)))

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def block(self, n: int) -> np.ndarray:
        place, count, sizes = self.index["blocks"][n]
        data, codec, planes = self._at(place, sum(sizes)), zstandard.ZstdDecompressor(), []
        for size in sizes:
            planes.append(codec.decompress(data[:size]))
            data = data[size:]
        return from_planes(planes, count, self.index["kind"])

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, its place in the shard and its ids, holding little more than one block and one document."""
        blocks = iter(range(len(self.index["blocks"])))
        held, start = np.zeros(0, "<u4"), 0
        for doc_id, size in zip(self.index["docs"], self.index["sizes"]):
            parts, have = [held], len(held)
            while have < size:
                parts.append(self.block(next(blocks)))
                have += len(parts[-1])
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, start, held[:size]
            held, start = held[size:], start + size


SHARDS = "shard int, path string, n_docs long, n_tokens long"
_SHARDS = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_shards(docs: DataFrame, folder: str, tokenizer: str, lead: bool, end_id: int, kind: str = "byte", block: int = BLOCK) -> DataFrame:
    """Write the ids of all documents, each with ``end_id`` after it, in ascending doc_id order.

    Returns the shards: shard, path, n_docs, n_tokens. A null text is empty, a null doc_id comes first,
    rows that share a doc_id are ordered by text; other columns are ignored; an empty table has no
    shard. ``folder`` must be one that all executors reach; the file of an attempt that failed is not listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, writer, total = task.partitionId(), None, 0
        path = f"{folder}/{shard:06d}-{task.taskAttemptId()}.bits"
        for batch in slices(batches, limit=ENCODE_BYTES):
            writer = writer or ShardWriter(path, kind, block)
            ids, ends = encoder(tokenizer, lead).encode(batch.column("text"))
            with_end = np.insert(ids, ends[1:], end_id)
            writer.add(batch.column("doc_id").to_pylist(), (np.diff(ends) + 1).tolist(), with_end)
            total += len(with_end)
        if writer:
            writer.close()
            row = [[shard], [path], [len(writer.docs)], [total]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SHARDS)], schema=_SHARDS)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # The list has one row a shard, and is written as one file instead of one for each.
    return stored(map_arrow(ordered, run, SHARDS).repartition(1), "shards")


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_shards(shards: DataFrame) -> DataFrame:
    """All documents of the listed shards: doc_id, start (ids before it in all shards), n_tokens, ids (little-endian uint32)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DOCS)], schema=_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for path, first in zip(listed.column("path").to_pylist(), listed.column("first").to_pylist()):
                rows, size = [], 0
                for doc_id, start, ids in ShardReader(path).documents():
                    rows.append((doc_id, first + start, len(ids), ids.tobytes()))
                    size += 4 * len(ids) + 64
                    if size >= READ_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    spread = placed.select("path", "first").repartitionByRange(max(1, shards.count()), F.col("first"))
    return map_arrow(spread, run, "doc_id long, start long, n_tokens long, ids binary")
