"""A quality classifier: random-indexing vectors of words, pooled, and a small network over them.

Words, and their shapes (runs of capitals, small letters, digits, and other signs as they are), are
hashed to ``ROWS`` rows. Each row has a sparse random index vector; its context vector is the sum of
the index vectors of its neighbours over the whole corpus. A document is the mean of its words'
context and index vectors, and of its shapes'. Two layers over that, fitted in numpy by one task on a
bounded sample of labelled rows, give a logit; a temperature, fitted on a part of the sample that the
layers do not see, makes it a probability.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import HELD_OUT, fold, given_back, map_arrow, picked, slices, text_bytes
from tidemark.llm.words import Words, byte_set, mix, words

ROWS = 1 << 15
DIMENSIONS = 64
SIGNS = 2
WINDOW = 2
BLOCK_ROWS = 1 << 10
#: At most so many labelled rows, the first by hash, are learnt from.
SAMPLE_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
GATHER = 1 << 15
SPACES = byte_set((0x00, 0x20))


def _shape_table() -> np.ndarray:
    found = np.arange(256, dtype=np.uint8)
    found[ord("0") : ord("9") + 1] = ord("0")
    found[ord("a") : ord("z") + 1] = ord("a")
    found[ord("A") : ord("Z") + 1] = 0xFF  # a byte that no text has
    found[0x80:0xF8] = ord("a")
    return found


_SHAPE = _shape_table()


def streams(texts: pa.Array) -> list[Words]:
    """The words of each text, and their shapes."""
    data, offsets = text_bytes(texts)
    plain = words(data, offsets, SPACES)
    shape = _SHAPE[data]
    kept = np.ones(len(data), bool)
    kept[1:] = (shape[1:] != shape[:-1]) | SPACES[data[1:]]
    kept[offsets[(offsets > 0) & (offsets < len(data))]] = True
    places = np.concatenate([[0], np.cumsum(kept)])
    return [plain, words(shape[kept], places[offsets], SPACES)]


def rows_of(found: Words) -> np.ndarray:
    return (found.hash >> np.uint64(40)).astype(np.int64) % ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Every row's places and signs, ``SIGNS`` of each."""
    numbers = mix(np.arange(ROWS * SIGNS, dtype=np.uint64) + np.uint64(77)).reshape(ROWS, SIGNS)
    return (numbers >> np.uint64(8)).astype(np.int64) % DIMENSIONS, 1 - 2 * (numbers & np.uint64(1)).astype(np.int32)


def _context(found: Words, total: np.ndarray) -> None:
    """Add the index vectors of each word's neighbours in its text to its row."""
    row, (places, signs) = rows_of(found), index_vectors()
    text = np.repeat(np.arange(len(found.ends) - 1), found.counts)
    for distance in range(1, WINDOW + 1):
        near = np.flatnonzero(text[distance:] == text[:-distance])
        for own, other in ((near, near + distance), (near + distance, near)):
            for i in range(SIGNS):
                np.add.at(total, row[own] * DIMENSIONS + places[row[other], i], signs[row[other], i])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The context vectors of a task's texts, in blocks of rows."""
    totals = np.zeros((2, ROWS * DIMENSIONS), np.int32)  # a task's words are far fewer than 2**31
    for batch in slices(batches):
        for total, found in zip(totals, streams(batch.column("text"))):
            _context(found, total)
    codec = zstandard.ZstdCompressor(level=1)
    rows = [
        (stream * ROWS + first, codec.compress(part.astype(np.int64).tobytes()))
        for stream in range(2)
        for first, part in ((i, totals[stream].reshape(ROWS, -1)[i : i + BLOCK_ROWS]) for i in range(0, ROWS, BLOCK_ROWS))
        if part.any()
    ]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["first", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by block, made unit vectors, holding one block of numbers for each."""
    totals: dict[int, np.ndarray] = {}
    codec = zstandard.ZstdDecompressor()
    for batch in batches:
        for first, packed in zip(batch.column("first").to_pylist(), batch.column("sums").to_pylist()):
            part = np.frombuffer(codec.decompress(packed), np.int64)
            totals[first] = totals[first] + part if first in totals else part
    parts = [t.reshape(-1, DIMENSIONS).astype(np.float32) for t in totals.values()]
    units = [part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9) for part in parts]
    columns = [pa.array(list(totals), pa.int32()), pa.array([unit.astype(np.float32).tobytes() for unit in units], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["first", "units"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of the rows of both streams, learnt from all texts; zeros for rows that no word has."""
    parts = map_arrow(picked(docs, text="string"), _contexts, "first int, sums binary").repartition("first")
    table = np.zeros((2 * ROWS, DIMENSIONS), np.float32)
    blocks = map_arrow(parts, _added, "first int, units binary").toArrow()  # 2 * ROWS rows of numbers, whatever the corpus
    for first, unit in zip(blocks.column("first").to_pylist(), blocks.column("units")):
        table[first : first + BLOCK_ROWS] = np.frombuffer(unit.as_buffer(), np.float32).reshape(-1, DIMENSIONS)
    return table


def features(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One vector for each text: the means of its words' context and index vectors, and of its shapes'. No words: zeros."""
    places, signs = index_vectors()
    parts = []
    for stream, found in enumerate(streams(texts)):
        row = rows_of(found)
        total = np.zeros((len(found.ends) - 1, 2 * DIMENSIONS))
        text = np.repeat(np.arange(len(total)), found.counts)
        for i in range(0, len(row), GATHER):
            own, some = text[i : i + GATHER], row[i : i + GATHER]
            begin = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[begin], :DIMENSIONS] += np.add.reduceat(vectors[some + stream * ROWS], begin, axis=0)
            for n in range(SIGNS):
                np.add.at(total, (own, DIMENSIONS + places[some, n]), signs[some, n])
        parts.append(total / np.maximum(found.counts, 1)[:, None])
    return np.concatenate(parts, axis=1)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Two layers by Adam on four fifths of the rows, the temperature of least log loss on the others."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    d = x.shape[1]
    net = Network(x[used].mean(axis=0), x[used].std(axis=0) + 1e-3, rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // 64)):
            step += 1
            inputs = (x[rows] - net.mean) / net.scale
            hidden = np.maximum(inputs @ values[0] + values[1], 0)
            error = (sigmoid(hidden @ values[2] + values[3][0]) - y[rows]) / len(rows)
            inner = np.outer(error, values[2]) * (hidden > 0)
            slopes = [inputs.T @ inner + 1e-3 * values[0], inner.sum(axis=0), hidden.T @ error + 1e-3 * values[2], np.array([error.sum()])]
            for v, m, s, g in zip(values, first, second, slopes):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if len(held) and 0 < y[held].mean() < 1:
        z = net.logits(x[held])
        losses = {t: np.logaddexp(0, np.where(y[held] == 1, -z, z) / t).mean() for t in np.geomspace(0.25, 8, 41).tolist()}
        net.temperature = min(losses, key=losses.get)
    return net


def _untrained() -> Network:
    """Every score is one half."""
    width = 4 * DIMENSIONS
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network that the whole sample gives, pickled, in one row."""
    parts = [(b.column("doc_id").to_numpy(), b.column("quality").to_numpy(), np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32)) for b in batches]
    parts = [p for p in parts if len(p[0])]
    if not parts:
        return
    doc_id, y, x = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((y, doc_id))
    net = train(x.reshape(len(y), -1)[order].astype(np.float64), y[order].astype(np.float64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["network"])


@dataclass
class Quality:
    """``vectors``: the context vectors, broadcast. ``release`` lets them go once every score that needs them is written."""

    vectors: Broadcast
    network: Network

    def release(self) -> None:
        self.vectors.destroy()


def fit(docs: DataFrame, labels: DataFrame) -> Quality:
    """Word vectors from all texts, and the network from at most ``SAMPLE_ROWS`` labelled rows that aren't held out.

    Labels that are null or neither 0 nor 1 teach nothing; a doc_id that is labelled twice counts twice. With no label at all every
    score is one half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(word_vectors(docs))
    given_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = features(batch.column("text"), shared.value).astype(np.float32)
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array([row.tobytes() for row in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "x"])

    known = picked(labels, doc_id="long", quality="int").where("quality in (0, 1) and doc_id is not null")
    known = known.where(fold(F.col("doc_id")) != HELD_OUT).orderBy(F.xxhash64("doc_id"), "quality").limit(SAMPLE_ROWS)
    source = picked(docs, doc_id="long", text="string").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
    table = map_arrow(source, run, "doc_id long, quality int, x binary").orderBy("doc_id", "quality").limit(SAMPLE_ROWS)
    learnt = map_arrow(table.repartition(1), _train, "network binary").collect()  # one row of a fixed size, or none
    return Quality(shared, pickle.loads(learnt[0]["network"]) if learnt else _untrained())


def score(docs: DataFrame, fitted: Quality) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score (0 to 1; higher: label 1 likelier).

    A null or empty text has the score of a text without words. Repeated rows and null ids come out as they are.
    """
    vectors, network = fitted.vectors, fitted.network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = network.scores(features(batch.column("text"), vectors.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    return map_arrow(picked(docs, doc_id="long", text="string"), run, "doc_id long, score double")
