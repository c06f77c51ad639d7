"""Centroid clustering on bit planes.

Vectors are whole numbers. The 64 components' bits of one weight, a bit plane, are one 64-bit word,
and the last plane of a vector is its sign in two's complement, of negative weight. The dot product of
two vectors is then the sum over pairs of planes of their weights times the number of bits that both
words have set, so squared distances come out exact, without floating point. The planes are
written once; each round reads them alone and shuffles sums of whole tasks, one row per centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import map_arrow, picked, stored

#: One component per bit of a plane.
COMPONENTS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
#: Components beyond this size have distances that a long can't hold.
MOST = 1 << 27
#: Vectors that are worked on at once.
CHUNK = 4096


def planes(values: np.ndarray) -> np.ndarray:
    """(n, 64) whole numbers to (n, planes) words; bit j of a word belongs to component j, the last plane is the sign."""
    values = values.astype(np.int64)
    n = int(np.maximum(values, ~values).max(initial=0)).bit_length() + 1
    bits = (values[:, None, :] >> np.arange(n)[:, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8").reshape(len(values), n)


def weights(n: int) -> np.ndarray:
    found = 1 << np.arange(n, dtype=np.int64)
    found[-1:] *= -1
    return found


def numbers(words: np.ndarray) -> np.ndarray:
    """The whole numbers of (n, planes) words."""
    bits = np.unpackbits(np.ascontiguousarray(words, "<u8").view(np.uint8).reshape(*words.shape, 8), axis=2, bitorder="little")
    return np.einsum("npj,p->nj", bits, weights(words.shape[1]))


def same_width(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of planes as one array; a narrower one repeats its sign, which changes no number."""
    width = max(map(len, rows), default=1)
    return np.array([np.pad(r, (0, width - len(r)), "edge") for r in rows], np.uint64).reshape(len(rows), width)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all vectors of ``a`` with all of ``b``, from their planes."""
    total = np.zeros((len(a), len(b)), np.int64)
    for i, wa in enumerate(weights(a.shape[1]).tolist()):
        row = np.zeros_like(total)
        for j, wb in enumerate(weights(b.shape[1]).tolist()):
            row += np.bitwise_count(a[:, i, None] & b[None, :, j]) * np.int64(wb)
        total += row * wa
    return total


def norms(a: np.ndarray) -> np.ndarray:
    """Squared lengths."""
    total = np.zeros(len(a), np.int64)
    for i, wi in enumerate(weights(a.shape[1]).tolist()):
        for j, wj in enumerate(weights(a.shape[1]).tolist()):
            total += np.bitwise_count(a[:, i] & a[:, j]) * np.int64(wi * wj)
    return total


class Centroids(NamedTuple):
    words: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, values: list[list[int]]) -> Centroids:
        words = planes(np.array(values, np.int64).reshape(-1, COMPONENTS))
        return cls(words, norms(words))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector, the number of the nearest centroid (of equals the smaller), and the squared distance."""
        far = norms(vectors)[:, None] + self.lengths - 2 * dots(vectors, self.words)
        at = far.argmin(axis=1)
        return at, far[np.arange(len(vectors)), at]


def _packed(batch: pa.RecordBatch) -> np.ndarray:
    """The planes of a batch, whose rows may differ in how many they have."""
    column = batch.column("planes")
    flat = column.flatten().to_numpy().view(np.uint64)
    sizes = column.value_lengths().to_numpy()
    if (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    return same_width(np.split(flat, np.cumsum(sizes)[:-1]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK):
            yield batch.slice(i, CHUNK)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _chunks(batches):
        values = batch.column("e").flatten().to_numpy().reshape(-1, COMPONENTS)
        words = planes(np.floor(values * SCALE).astype(np.int64))
        edges = np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]
        lists = pa.ListArray.from_arrays(edges, words.reshape(-1).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "planes"])


def packed_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and planes of floor(256 * x) of each vector of 64 components, all of them finite and not null.

    Vectors with a number beyond 2**27 are left out, too. Other columns are ignored.
    """
    small = lambda x: F.coalesce((x * SCALE >= -MOST) & (x * SCALE < MOST) & ~F.isnan(x), F.lit(False))
    source = picked(vectors, **{"vec_id": "long", column: "array<double>"}).toDF("vec_id", "e")
    kept = source.where((F.size("e") == COMPONENTS) & F.forall("e", small))
    return map_arrow(kept, _pack, "vec_id long, planes array<long>")


def first_centroids(packed: DataFrame, number: int = CENTROIDS) -> list[list[int]]:
    """The ``number`` vectors whose ``2:<vec_id>`` has the smallest sha256, ascending; equal ids by their planes, null ids last."""
    draw = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = packed.select("planes", draw.alias("draw")).orderBy(F.col("draw").asc_nulls_last(), "planes").limit(number).collect()
    words = same_width([np.array(r["planes"], np.int64).view(np.uint64) for r in rows])
    return numbers(words).tolist() if rows else []


def _sums(centroids: Centroids) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per centroid that has vectors in a task: how many, and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids.words), np.int64)
        total = np.zeros((len(count), COMPONENTS), np.int64)
        for batch in _chunks(batches):
            words = _packed(batch)
            at, _ = centroids.nearest(words)
            order = np.argsort(at, kind="stable")
            begin = np.flatnonzero(np.diff(at[order], prepend=-1))
            total[at[order][begin]] += np.add.reduceat(numbers(words)[order], begin, axis=0)
            count += np.bincount(at, minlength=len(count))
        own = np.flatnonzero(count)
        columns = [pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    return run


def _moved(packed: DataFrame, values: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: floor(sum / count) by component; a centroid without vectors stays."""
    partial = map_arrow(packed.select("planes"), _sums(Centroids.of(values)), "cluster int, n long, sums array<long>")
    by_component = partial.select("cluster", "n", F.posexplode("sums").alias("j", "x")).groupBy("cluster", "j")
    found = [list(centroid) for centroid in values]
    for r in by_component.agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")).collect():
        found[r["cluster"]][r["j"]] = int(r["total"]) // r["n"]  # 64 rows for each centroid
    return found


def _assigned(centroids: Centroids) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            at, far = centroids.nearest(_packed(batch))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    return run


class Clustered(NamedTuple):
    """``assigned``: vec_id, cluster, distance (squared), as stored. ``centroids``: the last ones, by number."""

    assigned: DataFrame
    centroids: list[list[int]]


def cluster(vectors: DataFrame, number: int = CENTROIDS, rounds: int = ROUNDS, column: str = "embedding") -> Clustered:
    """Cluster all vectors (vec_id, ``column``) around ``number`` centroids in ``rounds`` rounds.

    Vectors that are null, of another length than 64, or hold a null, an infinite or not-a-number
    component, or one beyond 2**27 when multiplied by 256, take no part. Repeated rows and null ids count as any
    other row. Fewer vectors than ``number`` are as many centroids; an empty table gives none. Only
    sums by centroid and component pass the driver, 64 times ``number`` rows in each round.
    """
    packed = stored(packed_vectors(vectors, column), "planes")
    values = first_centroids(packed, number)
    if not values:
        empty = packed.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustered(empty, values)
    for _ in range(rounds):
        values = _moved(packed, values)
    assigned = map_arrow(packed, _assigned(Centroids.of(values)), "vec_id long, cluster int, distance long")
    return Clustered(stored(assigned, "assigned"), values)


def with_inertia(found: Clustered) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia (distances summed by cluster and in all; null if no long holds
    them) and centroid_sha256 (of the components as decimal numbers joined by commas)."""
    sums = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    by_cluster = {r["cluster"]: int(r["total"]) for r in sums}  # one number per centroid
    whole = sum(by_cluster.values())

    def long(value: int) -> Column:
        return F.lit(value if value < 1 << 63 else None).cast("long")

    def looked_up(values: dict[int, Column], kind: str) -> Column:
        if not values:
            return F.lit(None).cast(kind)
        return F.create_map(*[c for n, v in values.items() for c in (F.lit(n), v)])[F.col("cluster")]

    digests = {n: F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(found.centroids)}
    return found.assigned.select(
        "vec_id",
        "cluster",
        "distance",
        looked_up({n: long(total) for n, total in by_cluster.items()}, "long").alias("cluster_inertia"),
        long(whole).alias("inertia"),
        looked_up(digests, "string").alias("centroid_sha256"),
    )
