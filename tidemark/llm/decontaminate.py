"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is present where a window of it, ``size`` consecutive words, stands in a document. A
window is the set of its shingles. All of them must occur, so one necessary prefix token is enough to
find every candidate: the window's rarest shingle by its count over all documents. Candidates must
lie within the document (positional bound; the window's length is the length bound) and are then
compared word by word.

A benchmark whose windows and item ids are at most ``FAST_BYTES``, measured, is split into blocks of
``BLOCK`` windows, which are broadcast; each document is met by all blocks in turn without a shuffle.
Any larger one stays in tables: runs of words of the documents that a bit table lets through are joined
with the windows by all their words, and item lists, one for each distinct set of items, afterwards.
The bit table only spares rows, whatever its size. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_BYTES, looked_up, map_arrow, slices, stored, text_bytes
from tidemark.llm.words import Words, byte_set, grams, words
from tidemark.operators.joins import ROWS_PER_SALT, lookup_join

SIZE = 13
SHINGLE = 5
#: Beyond so many windows, or bytes of windows and item ids, the windows are joined and not broadcast.
BLOCK = 1 << 18
MOST_BLOCKS = 8
FAST_BYTES = 64 << 20
#: Bits for a window, and the most bits, of the table that spares the join most of the documents' runs.
BITS = 16
MOST_BITS = 1 << 27
#: Runs that go to Spark at once.
HITS = 1 << 16
#: Not words: fixed by the contract of the query (after A-Z are lowered).
SEPARATORS = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _found(texts: pa.Array) -> Words:
    return words(*text_bytes(texts), SEPARATORS)


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One row per window of an item: item_id, the hashes of its words."""
    for batch in slices(batches):
        found = _found(batch.column("text"))
        items, rows = batch.column("item_id").to_pylist(), []
        for item, a, b in zip(items, found.ends.tolist(), found.ends[1:].tolist()):
            for i in range(a, max(b - size, a) + 1 if b > a else a):
                rows.append((item, found.hash[i : min(i + size, b)].tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item_id", "words"]
        )


def window_shingles(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """The shingles of one window, in order; a window of fewer words is one shingle."""
    one = Words(hashes, np.array([0, len(hashes)]), np.zeros(0, int), np.zeros(0, int))
    return grams(one, shingle)[0]


@dataclass
class Block:
    """Windows by the shingle that stands for them: its hash, its place in the window; words padded with 0."""

    key: np.ndarray
    place: np.ndarray
    length: np.ndarray
    words: np.ndarray
    items: list[tuple[str, ...]]
    shingle: int


def _blocks(windows: DataFrame) -> Iterator[list]:
    """Rows of distinct windows, fetched BLOCK at a time."""
    held = []
    for row in windows.toLocalIterator(prefetchPartitions=False):
        held.append((bytes(row["words"]), tuple(row["items"])))
        if len(held) == BLOCK:
            yield held
            held = []
    if held:
        yield held


def _count(vocabulary: np.ndarray, shingle: int):
    """Occurrences in the documents of the given shingles (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.value), np.int64)
        for batch in slices(batches):
            at, hit = _look_up(vocabulary.value, grams(_found(batch.column("text")), shingle)[0])
            total += np.bincount(at[hit], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["nth", "n"])

    return run


def _look_up(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in the sorted ones, and whether it is there. Few pass a first test by their low bits."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    low = np.uint64(0xFFFFF)
    table = np.zeros(1 << 20, bool)
    table[(sorted_keys & low).astype(np.int64)] = True
    hit = table[(keys & low).astype(np.int64)]
    at = np.zeros(len(keys), np.int64)
    some = np.flatnonzero(hit)
    place = np.minimum(np.searchsorted(sorted_keys, keys[some]), len(sorted_keys) - 1)
    at[some] = place
    hit[some] = sorted_keys[place] == keys[some]
    return at, hit


def _index(rows: list, docs: DataFrame, size: int, shingle: int) -> Block:
    """Choose every window's rarest shingle by its count over all documents."""
    hashes = [np.frombuffer(w, np.uint64) for w, _ in rows]
    sets = [window_shingles(h, shingle) for h in hashes]
    vocabulary = np.unique(np.concatenate(sets))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counted = map_arrow(docs.select("text"), _count(shared, shingle), "nth long, n long")
    counts = np.zeros(len(vocabulary), np.int64)
    for row in counted.groupBy("nth").agg(F.sum("n").alias("n")).collect():  # at most the shingles of one block
        counts[row["nth"]] = row["n"]
    shared.unpersist()
    place = np.array([int(np.argmin(counts[np.searchsorted(vocabulary, s)])) for s in sets], np.int64)
    key = np.array([s[p] for s, p in zip(sets, place)], np.uint64)
    order = np.argsort(key, kind="stable")
    padded = np.zeros((len(rows), size), np.uint64)
    for i, h in enumerate(hashes):
        padded[i, : len(h)] = h
    length = np.array([len(h) for h in hashes], np.int64)
    return Block(key[order], place[order], length[order], padded[order], [rows[i][1] for i in order], shingle)


def _matches(block: Block, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Windows found, and the word at which each occurrence begins."""
    shingles, begin = grams(found, block.shingle)
    _, hit = _look_up(block.key, shingles)
    candidates = [np.zeros((2, 0), np.int64)]
    some = np.flatnonzero(hit)
    low, high = (np.searchsorted(block.key, shingles[some], side) for side in ("left", "right"))
    while (low < high).any():  # windows that share their rarest shingle, one after the other
        more = low < high
        some, low, high = some[more], low[more], high[more]
        candidates.append(np.stack([low, some]))
        low = low + 1
    # A window of fewer words than a shingle stands anywhere in a text: its own length is its shingle.
    for length in np.unique(block.length[block.length < block.shingle]).tolist():
        own = np.flatnonzero(block.length == length)
        runs, at = grams(found, length)
        order = own[np.argsort(block.key[own])]
        place, hit = _look_up(block.key[order], runs)
        candidates.append(np.stack([order[place[hit]], -at[hit] - 1]))
    window, at = np.concatenate(candidates, axis=1)
    begin = np.where(at >= 0, begin[np.maximum(at, 0)] - block.place[window], -at - 1) if len(window) else at
    text = np.searchsorted(found.ends, np.where(at >= 0, begin + block.place[window], begin), "right") - 1 if len(window) else at
    inside = (begin >= found.ends[text]) & (begin + block.length[window] <= found.ends[text + 1])
    window, begin = window[inside], begin[inside]
    same = np.ones(len(window), bool)
    for i in range(block.words.shape[1]):
        longer = same & (block.length[window] > i)
        rows = np.flatnonzero(longer)
        same[rows] = found.hash[begin[rows] + i] == block.words[window[rows], i]
    pairs = np.unique(np.stack([window[same], begin[same]]), axis=1)
    return pairs[0], pairs[1]


def _scan(blocks: list):
    """Per document: its number of words, the words hit (as spans) and the items present."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = _found(batch.column("text"))
            n = batch.num_rows
            change = np.zeros(len(found.hash) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for shared in blocks:
                block = shared.value
                window, begin = _matches(block, found)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + block.length[window], -1)
                for w, text in zip(window.tolist(), (np.searchsorted(found.ends, begin, "right") - 1).tolist()):
                    items.setdefault(text, set()).update(block.items[w])
            hit = np.cumsum(change)[:-1] > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            spans: list[list[dict]] = [[] for _ in range(n)]
            flat = hit.astype(np.int8)
            for text in items:
                a, b = found.ends[text], found.ends[text + 1]
                edge = np.diff(flat[a:b], prepend=0, append=0)
                spans[text] = [{"first": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))]
            arrays = [
                pa.array(found.counts, pa.int64()),
                pa.array(np.diff(total[found.ends]), pa.int64()),
                pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
            ]
            kept = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *arrays], names=[*kept, *FOUND])

    return run


FOUND = ["n_words", "n_hit", "items", "spans"]
SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first: int, end: int>>"
CONTAMINATED = "n_hit > 0 and 20 * n_hit >= n_words"


def _marks(n_bits: int):
    """Of the hashes of whole windows: the set bits of each 64-bit slot of the bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("words")
            sizes = pc.binary_length(column)
            for n in pc.unique(sizes).to_pylist():
                flat = np.frombuffer(b"".join(column.filter(pc.equal(sizes, n)).to_pylist()), np.uint64)
                none = np.zeros(0, int)
                hashes = grams(Words(flat, np.arange(0, len(flat) + 1, n // 8), none, none), n // 8)[0]
                slot = ((hashes & np.uint64(n_bits - 1)) >> np.uint64(6)).astype(np.int64)
                order = np.argsort(slot, kind="stable")
                slots, first = np.unique(slot[order], return_index=True)
                bits = np.bitwise_or.reduceat((np.uint64(1) << (hashes & np.uint64(63)))[order], first)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(bits.view(np.int64))], ["slot", "bits"])

    return run


def _runs(shared, lengths: list[int]):
    """One row per document (begin null), and one per run of words that may be a window, with its words."""
    names = ["row", "doc_id", "n_words", "begin", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        mask = np.uint64(64 * len(table) - 1)
        for batch in slices(batches):
            found, n = _found(batch.column("text")), batch.num_rows
            nothing = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(found.counts, pa.int64()), *nothing], names)
            rows = np.asarray(batch.column("row"))
            for length in lengths:
                hashes, begin = grams(found, length)
                maybe = (table[((hashes & mask) >> np.uint64(6)).astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1)
                begin = begin[maybe.astype(bool)]
                text = np.searchsorted(found.ends, begin, "right") - 1
                inside = begin + length <= found.ends[text + 1]
                begin, text = begin[inside], text[inside]
                for i in range(0, len(begin), HITS):
                    at, own = begin[i : i + HITS], text[i : i + HITS]
                    offsets = np.arange(len(at) + 1, dtype=np.int32) * (8 * length)
                    held = np.ascontiguousarray(found.hash[at[:, None] + np.arange(length)])
                    whole = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
                    nothing = [pa.nulls(len(at), pa.int64())] * 2
                    columns = [pa.array(rows[own]), *nothing, pa.array((at - found.ends[own]).astype(np.int32)), whole]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words hit and their spans, from where windows begin and how long they are."""
    for batch in batches:
        hit, spans = [], []
        for n, runs in zip(batch.column("n_words").to_pylist(), batch.column("runs")):
            flat = np.zeros(0, np.int8)
            if runs.is_valid:
                begin, length = (np.asarray(runs.values.field(c)) for c in ("begin", "length"))
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + length, -1)
                flat = (np.cumsum(change)[:-1] > 0).astype(np.int8)
            edge = np.diff(flat, prepend=0, append=0)
            hit.append(int(flat.sum()))
            spans.append([{"first": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))])
        arrays = [
            batch.column("doc_id"),
            batch.column("n_words"),
            pa.array(hit, pa.int64()),
            batch.column("items"),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *FOUND])


def _joined(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """What ``_scan`` finds, for any number of windows (pairs of words and item_id): nothing of them but bits leaves the tables."""
    # Windows of the same items share one list of them.
    item = F.col("item_id")
    own = F.concat_ws(" ", F.bit_xor(F.xxhash64(item)), F.bit_xor(F.xxhash64(item, F.lit(1))), F.count(item))
    windows = stored(pairs.groupBy("words").agg(own.alias("listed")), "windows-by-items")
    lists = lookup_join(pairs, windows, "words", BROADCAST_BYTES).groupBy("listed").agg(F.collect_set("item_id").alias("items"))
    lists = stored(lists, "item-lists")
    n_bits = 1 << 20
    while n_bits < min(BITS * windows.count(), MOST_BITS):
        n_bits *= 2
    marks = map_arrow(windows.select("words"), _marks(n_bits), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(n_bits // 64, np.uint64)
    table[marks.column("slot").to_numpy()] = marks.column("bits").to_numpy().view(np.uint64)
    lengths = sorted(r[0] // 8 for r in windows.select(F.length("words")).distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(table)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    runs = map_arrow(numbered, _runs(shared, lengths), "row long, doc_id long, n_words long, begin int, words binary")
    runs = stored(runs, "runs")
    hits = runs.where("begin is not null").select("row", "begin", "words")
    met = lookup_join(hits, windows, "words", BROADCAST_BYTES, ROWS_PER_SALT).where("listed is not null")
    spot = F.struct("begin", F.expr("cast(length(words) div 8 as int)").alias("length"))
    met = stored(met.groupBy("row").agg(F.collect_list(spot).alias("runs"), F.collect_set("listed").alias("lists")), "runs-met")
    named = lookup_join(met.select("row", F.explode("lists").alias("listed")), lists, "listed", BROADCAST_BYTES)
    items = named.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    met = stored(met.select("row", "runs").join(items, "row"), "items-met")
    whole = looked_up(runs.where("begin is null").select("row", "doc_id", "n_words"), met, "row", "left")
    none = F.array().cast("array<string>")
    return map_arrow(whole.select("doc_id", "n_words", "runs", F.coalesce("items", none).alias("items")), _covered, SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, items (sorted ids), spans (first word, end), contaminated.

    A word is hit inside any occurrence of ``size`` consecutive words of an item, or of the whole item
    if it has fewer; contaminated: some word is hit, and at least a twentieth of all. A null text has
    no words; an item without words, or a null item_id or text, is never present; items that repeat
    an id count once; an empty benchmark hits nothing; ties and repeated rows are kept; other columns
    are ignored.
    """
    source = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("item_id is not null")
    pairs = map_arrow(source, lambda rows: _windows(rows, size), "item_id string, words binary")
    pairs = stored(pairs.distinct(), "windows")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    n_bytes = pairs.agg(F.sum((F.length("words") + F.octet_length("item_id") + 16).cast("long"))).first()[0] or 0
    if n_bytes > FAST_BYTES or pairs.select("words").distinct().count() > BLOCK * MOST_BLOCKS:
        return _joined(docs, pairs).withColumn("contaminated", F.expr(CONTAMINATED))
    windows = stored(pairs.groupBy("words").agg(F.collect_set("item_id").alias("items")), "window-items")
    blocks = [context.broadcast(_index(rows, docs, size, shingle)) for rows in _blocks(windows)]
    return map_arrow(docs, _scan(blocks), SCHEMA).withColumn("contaminated", F.expr(CONTAMINATED))


def clean(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't contaminated; rows without a doc_id stay."""
    bad = found.where("contaminated and doc_id is not null").select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, F.col("doc_id") == F.col("bad_id"), "left_anti")
