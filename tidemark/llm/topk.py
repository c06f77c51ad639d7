"""Exact top-k search by inner product, with block-at-a-time pruning.

Vectors are laid out in blocks by ranges of their ids. A block keeps each dimension's largest and
smallest component and, as its forward index, the components row by row. For a query, the largest
product that a dimension can give, summed over the dimensions, bounds every score in the block; the
blocks are scored in descending order of that bound until it falls below the k-th best score so far.

Queries are taken in chunks. A chunk first meets one group of blocks, whose k-th scores then start
its pruning in all the other groups, each a task of its own; only k rows a query leave a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import map_arrow, stored

BLOCK = 256
GROUP_BLOCKS = 32
CHUNK = 256
#: Products and sums below this are exact in double precision.
EXACT = 1 << 53
LEAST = np.iinfo(np.int64).min

GROUPS = "size int, part int, grp int, ids binary, asked binary, rows binary"


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if any is null or not finite."""
    x = vector.cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(sound, F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of consecutive vectors of one length."""
    part, grp = TaskContext.get().partitionId(), 0
    held: dict[int, list[tuple[int, bool, np.ndarray]]] = {}
    last = None

    def packed(size: int) -> pa.RecordBatch:
        ids, asked, rows = zip(*held.pop(size))
        arrays = [np.array(ids, np.int64), np.array(asked, bool), np.stack(rows)]
        numbers = [pa.array([x], pa.int32()) for x in (size, part, grp)]
        return pa.RecordBatch.from_arrays([*numbers, *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], ["size", "part", "grp", "ids", "asked", "rows"])

    for batch in batches:
        vectors = batch.column("vector")
        offsets = vectors.offsets.to_numpy()
        values = vectors.values.to_numpy(zero_copy_only=False)
        rows = zip(batch.column("vec_id").to_pylist(), batch.column("asked").to_pylist(), offsets.tolist(), offsets[1:].tolist())
        for vec_id, asked, a, b in rows:
            held.setdefault(b - a, []).append((vec_id, bool(asked) and vec_id != last, values[a:b]))
            last = vec_id
            if len(held[b - a]) == BLOCK * GROUP_BLOCKS:
                yield packed(b - a)
                grp += 1
    for size in list(held):
        yield packed(size)
        grp += 1


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores; equal ones by smaller id."""
    if len(ids) > 4 * k:  # those below the k-th score can't be among them
        kept = scores >= np.partition(scores, -k)[-k]
        ids, scores = ids[kept], scores[kept]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_group(queries: np.ndarray, own: np.ndarray, floors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """For each query (with its own id, and a score that k others reach): the best of one group's vectors, and how many blocks were scored."""
    begin = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(rows, begin), np.minimum.reduceat(rows, begin)
    peak = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0)))) * max(abs(int(queries.min(initial=0))), abs(int(queries.max(initial=0))))
    if peak * max(1, rows.shape[1]) < EXACT:  # then products in double precision are exact, and fast
        rows, high, low, queries = (x.astype(np.float64) for x in (rows, high, low, queries))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    found, scored = [], 0
    for q, me, floor, bound in zip(queries, own, floors, bounds):
        kept_ids, kept = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] < (max(floor, kept[-1]) if len(kept) == k else floor):
                break
            a, b = begin[block], min(begin[block] + BLOCK, len(ids))
            scores = (rows[a:b] @ q).astype(np.int64)
            others = ids[a:b] != me
            kept_ids, kept = best(np.concatenate([kept_ids, ids[a:b][others]]), np.concatenate([kept, scores[others]]), k)
            scored += 1
        found.append((kept_ids, kept))
    return found, scored


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                own, ids = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                queries = np.frombuffer(row["queries"], np.int64).reshape(len(own), -1)
                rows = np.frombuffer(row["rows"], np.int64).reshape(len(ids), -1)
                kth = dict(row.get("kth") or ())
                floors = np.array([kth.get(q, LEAST) for q in own.tolist()], np.int64)
                found, _ = search_group(queries, own, floors, ids, rows, k)
                columns = [np.repeat(own, [len(i) for i, _ in found]), *(np.concatenate([f[n] for f in found]) for n in (0, 1))]
                chunk = pa.array(np.full(len(columns[0]), row["chunk"], np.int64))
                yield pa.RecordBatch.from_arrays([chunk, *map(pa.array, columns)], ["chunk", "query_id", "vec_id", "score"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of each group, at most CHUNK together."""
    names = ["chunk", "size", "part", "grp", "query_ids", "queries"]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids, own = np.frombuffer(row["ids"], np.int64), np.flatnonzero(np.frombuffer(row["asked"], bool))
            rows = np.frombuffer(row["rows"], np.int64).reshape(len(ids), -1)
            for nth in range(0, len(own), CHUNK):
                some = own[nth : nth + CHUNK]
                chunk = (row["part"] << 20 | row["grp"]) << 16 | nth
                values = (chunk, row["size"], row["part"], row["grp"], ids[some].tobytes(), rows[some].tobytes())
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)


def top_k(vectors: DataFrame, asked: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """Each query's k best: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding; ``asked`` says which rows are queries. The score is the inner
    product of the components floor(scale * x); candidates are all rows with another vec_id and a vector
    of the same length; equal scores go to the smaller vec_id. Rows without an id, and vectors that are
    null, empty or hold null or non-finite components, take no part. Of rows that repeat an id, each is a
    candidate and the first a query. Fewer than k candidates are all returned; other columns are ignored;
    an empty table gives no rows.
    """
    sound = vectors.select(F.col("vec_id").cast("long"), quantised(F.col("embedding"), scale).alias("vector"), asked.alias("asked"))
    sound = sound.where("vec_id is not null and size(vector) > 0")
    ordered = sound.repartitionByRange("vec_id").sortWithinPartitions("vec_id", "vector")
    groups = stored(map_arrow(ordered, _blocks, GROUPS), "vector-groups")
    place = ["size", "part", "grp"]
    found = "chunk long, query_id long, vec_id long, score long"
    queries = "chunk long, size int, part int, grp int, query_ids binary, queries binary"
    chunks = stored(map_arrow(groups, _chunks, queries), "query-chunks")
    targets = groups.select(*place, "ids", "rows")

    first = stored(map_arrow(chunks.join(targets, place), _search(k), found), "first-scores")
    by_score = Window.partitionBy("chunk", "query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") == k).groupBy("chunk")
    kth = kth.agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("kth"))  # at most CHUNK entries
    # Every chunk meets every other group of its length: a stated query set against all rows, in blocks.
    others = groups.groupBy("size").agg(F.collect_list(F.struct("part", "grp")).alias("others"))
    met = chunks.join(kth, "chunk", "left").join(others, "size")
    met = met.withColumn("other", F.explode("others")).where("not (part = other.part and grp = other.grp)")
    met = met.select("chunk", "size", "other.part", "other.grp", "query_ids", "queries", "kth")
    rest = map_arrow(met.join(targets, place), _search(k), found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
