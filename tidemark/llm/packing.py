"""Best-fit packing of documents into training sequences by minimum bin slack.

Each sequence is filled by the fullest combination of the lengths that are left: a bitset holds the
sums that can be reached, length by length, and the way back from the highest one names the
combination. Only counts by length matter for that, so a combination is taken as often as the counts
allow at once: each use ends at least one length, and the plan has at most ``capacity`` combinations
however many documents there are. The documents themselves never leave the executors: a piece finds
its place by its length and its number among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import encoder
from tidemark.llm.tables import map_arrow, slices, stored

CAPACITY = 2048
END_ID = 0
ENCODE_BYTES = 2 << 20
RANK_BITS = 44


@dataclass
class Packed:
    """``pieces``: the token ids of each piece, as stored. ``placed``: where each piece lies."""

    pieces: DataFrame
    placed: DataFrame

    def sequences(self) -> DataFrame:
        """sequence_id, its pieces' doc_id, piece and length in order, and all its ids as little-endian uint32.

        The pieces of a sequence are at most ``capacity``; they are joined by the row keys of the store.
        """
        keys = ["part", "row"]
        joined = self.placed.select(*keys, "sequence_id", "offset").join(self.pieces, keys)
        item = F.struct("offset", "doc_id", "piece", "length", "ids")
        rows = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
        ids = F.unhex(F.array_join(F.transform("items", lambda x: F.hex(x["ids"])), ""))
        segments = F.transform("items", lambda x: F.struct(x["doc_id"], x["piece"], x["length"]))
        return rows.select("sequence_id", segments.alias("segments"), ids.alias("ids"))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room``: length -> times.

    Long lengths are tried first, and the search ends as soon as the room can be filled exactly.
    """
    mask, reached, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        steps.append((length, reached))
        left, times = min(counts[length], room // length), 1
        while left:
            times = min(times, left)
            reached |= reached << times * length & mask
            left, times = left - times, times * 2
        if reached >> room:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total, times = total - length, times + 1
        if times:
            chosen[length] = times
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, length -> times) for every combination. The longest piece left goes first."""
    left, found = {n: c for n, c in counts.items() if c}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        bins = min(left[n] // times for n, times in chosen.items())
        for n, times in chosen.items():
            left[n] -= bins * times
        left = {n: c for n, c in left.items() if c}
        found.append((bins, chosen))
    return found


def _cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: all but the first are full."""
    first = size % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, size, capacity))]


PIECES = "part int, row long, doc_id long, piece int, start long, length long, nth long, ids binary, ids_crc32 long"


def _pieces(path: str, lead: bool, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, limit=ENCODE_BYTES):
            ids, ends = encoder(path, lead).encode(batch.column("text"))
            rows: list[tuple] = []
            size = 0
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends.tolist(), ends[1:].tolist()):
                whole = ids[a:b].tobytes() + end
                for n, (start, length) in enumerate(_cut(b - a + 1, capacity)):
                    own = whole[4 * start : 4 * (start + length)]
                    rows.append((part, row, doc, n, start, length, int(seen[length]), own, zlib.crc32(own)))
                    seen[length] += 1
                    row += 1
                    size += len(own)
                if size > 4 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return run


_ARROW = pa.schema(
    [("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())]
    + [(n, pa.int64()) for n in ("start", "length", "nth")]
    + [("ids", pa.binary()), ("ids_crc32", pa.int64())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _places(plan_rows: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """The plan by length and number: from which number on pieces go to which sequences, and where."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for bins, chosen in plan_rows:
        offset = 0
        for length, times in chosen.items():
            rows.append((length << RANK_BITS | used.get(length, 0), used.get(length, 0), times, sequence, offset))
            used[length] = used.get(length, 0) + bins * times
            offset += length * times
        sequence += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("key", "first", "times", "sequence", "offset"), table.T.copy()))


def pack(docs: DataFrame, tokenizer: str, lead: bool = True, capacity: int = CAPACITY, end_id: int = END_ID) -> Packed:
    """Pack all documents (doc_id, text; other columns are ignored) into few sequences of at most ``capacity`` ids.

    A document is its ids and then ``end_id``; only longer ones are cut. A null or empty text is
    ``end_id`` alone. Repeated rows and null ids are packed like any other row; an empty table gives
    no sequence. The driver gets one count for each length; the plan it sends back has at most
    ``capacity`` combinations of at most 63 lengths each.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stored(map_arrow(source, _pieces(tokenizer, lead, capacity, end_id), PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(plan(totals, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = places.value
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            i = np.searchsorted(at["key"], length << RANK_BITS | rank, "right") - 1
            nth = rank - at["first"][i]
            found = [at["sequence"][i] + nth // at["times"][i], at["offset"][i] + nth % at["times"][i] * length]
            kept = [n for n in batch.schema.names if n != "rank"]
            arrays = [batch.column(n) for n in kept] + [pa.array(x) for x in found]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "sequence_id", "offset"])

    ranked = pieces.drop("ids").join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    ranked = ranked.select("part", "row", "doc_id", "piece", "start", "length", "ids_crc32", "rank")
    schema = "part int, row long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return Packed(pieces, map_arrow(ranked, place, schema))
