"""N-gram Jaccard join with token-combination prefixes.

A text is the set of its word n-grams (tokens). Tokens have one order for all texts: rare ones first,
by hash, then frequent ones by their number of texts. Two texts that reach the threshold share, among
the first tokens of each, either a rare token, or two frequent ones of the same group:

- a set of n tokens may miss t = n - ceil(threshold * n) of them in a partner; its prefix is extended
  until (rare tokens) + sum over groups of (frequent tokens of the group - 1) exceeds t. Were no rare
  token shared, and at most one frequent token in each group, more than t tokens would be missing;
- rare tokens are indexed alone, frequent ones in pairs within their group, so a common passage makes
  no candidates by itself. How many groups there are depends on the size, in octaves; a set also
  takes part in the next octave when a partner could lie there.

Which tokens count as frequent is a matter of speed alone. Counts are exact over all texts, up to
equal 40-bit hashes; the most frequent tokens, at most ``FREQUENT`` of them, are broadcast.

A group of copies is not expanded into pairs. Equal sets are one node. The nodes under an index key
are first compared with the one of them that has the fewest rare tokens (the likely original of a
group of edited copies); only nodes that are then still in different components are compared with
each other, after exact bounds on size and on bit sketches of the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import given_back, map_arrow, ship, slices, stored, text_bytes
from tidemark.llm.words import byte_set, grams, mix, words

NGRAM = 5
THRESHOLD = Fraction(4, 5)
#: Below it, partners could lie two octaves apart.
LEAST_THRESHOLD = Fraction(3, 5)
FREQUENT = 1 << 19
LEAST_COUNT = 8
BUCKETS = 4
SKETCH = 16
BLOOM_BITS = 1 << 26
FLUSH = 1 << 21
#: White space that separates words: fixed by the contract of the query.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))


def token_sets(batch: pa.RecordBatch, ngram: int) -> Iterator[np.ndarray]:
    """The sorted distinct tokens of every text of a slice."""
    found = words(*text_bytes(batch.column("text")), SPACES)
    tokens, begin = grams(found, ngram)
    for a, b in zip(*(np.searchsorted(begin, e).tolist() for e in (found.ends[:-1], found.ends[1:]))):
        yield np.unique(tokens[a:b])


def set_key(tokens: np.ndarray) -> int:
    """One number for a set; equal for equal sets only, as far as 63 bits go."""
    total = mix(tokens + np.uint64(0x51ED27)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total]))[0] >> np.uint64(1))


class Seen:
    """Sets met before in this task; forgets when it grows large, which costs time but no result."""

    def __init__(self, most: int = 200_000):
        self.keys: set[int] = set()
        self.most = most

    def new(self, key: int) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= self.most:
            self.keys.clear()
        self.keys.add(key)
        return True


def _nodes(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(len(s), set_key(s) if len(s) else None) for s in token_sets(batch, ngram)]
            columns = [batch.column("doc_id"), pa.array([n for n, _ in found]), pa.array([k for _, k in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "node"])

    return run


def _packed_counts(tokens: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Sorted 40-bit tokens, dealt to buckets by their first bits, as compressed planes of differences."""
    short = np.sort(np.concatenate(tokens) >> np.uint64(24))
    bucket = (short * np.uint64(buckets)) >> np.uint64(40)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    codec, rows = zstandard.ZstdCompressor(level=1), []
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        part = np.diff(short[cuts[i] : cuts[i + 1]], prepend=np.uint64(0))
        planes = np.ascontiguousarray(part.view(np.uint8).reshape(-1, 8)[:, :5].T)
        rows.append((i, codec.compress(planes.tobytes())))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "tokens"])


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(5, -1)
    octets = np.zeros((planes.shape[1], 8), np.uint8)
    octets[:, :5] = planes.T
    return np.cumsum(octets.reshape(-1).view(np.uint64), dtype=np.uint64)


def _all_tokens(ngram: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, Seen()
        for batch in slices(batches):
            for tokens in token_sets(batch, ngram):
                if len(tokens) and seen.new(set_key(tokens)):
                    held.append(tokens)
                    size += len(tokens)
            if size > FLUSH:
                yield _packed_counts(held, buckets)
                held, size = [], 0
        if held:
            yield _packed_counts(held, buckets)

    return run


def _counted(table: pa.Table) -> pa.Table:
    tokens, n = np.unique(np.concatenate([_unpacked(x.as_py()) for x in table.column("tokens")]), return_counts=True)
    often = n >= LEAST_COUNT
    return pa.table({"token": tokens[often].astype(np.int64), "n": n[often].astype(np.int64)})


@dataclass
class Frequent:
    """The frequent tokens' 40-bit hashes, sorted, and their places in the order."""

    token: np.ndarray
    place: np.ndarray

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """Each token's place among the frequent ones; -1: rare."""
        if not len(self.token):
            return np.full(len(tokens), -1, np.int64)
        short = (tokens >> np.uint64(24)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.token, short), len(self.token) - 1)
        return np.where(self.token[at] == short, self.place[at], -1)


def frequent_tokens(docs: DataFrame, ngram: int, most: int = FREQUENT) -> Frequent:
    """Tokens of many texts: those of the highest counts, at most ``most``, and none below ``LEAST_COUNT``."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = map_arrow(docs.select("text"), _all_tokens(ngram, buckets), "bucket int, tokens binary")
    counts = stored(packed.groupBy("bucket").applyInArrow(_counted, "token long, n long"), "token-counts")
    classes = counts.groupBy(F.floor(F.log2("n") * 4).alias("class")).agg(F.count(F.lit(1)).alias("tokens"))
    least, total = None, 0
    for row in sorted(classes.collect(), key=lambda r: -r["class"]):  # four rows for each power of two
        total += row["tokens"]
        if total > most:
            break
        least = row["class"]
    if least is None:
        return Frequent(np.zeros(0, np.int64), np.zeros(0, np.int64))
    table = counts.where(F.floor(F.log2("n") * 4) >= least).toArrow()
    token, n = table.column("token").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(token)
    token, n = token[order], n[order]
    place = np.empty(len(token), np.int64)
    place[np.lexsort((token, n))] = np.arange(len(token))
    return Frequent(token, place)


def misses(n: int, threshold: Fraction) -> int:
    """How many tokens of a set of n no partner needs to have."""
    return n - -(-threshold.numerator * n // threshold.denominator)


def _groups(octave: int, threshold: Fraction) -> int:
    return max(1, misses(1 << octave, threshold) // 3)


def octaves(n: int, threshold: Fraction) -> list[int]:
    """The octave of a set of n tokens, and the next one if a partner could be that large."""
    own = n.bit_length() - 1
    largest = threshold.denominator * n // threshold.numerator
    return [own] if largest.bit_length() - 1 == own else [own, own + 1]


def signatures(tokens: np.ndarray, frequent: Frequent, threshold: Fraction) -> tuple[np.ndarray, int]:
    """Index keys of a set, and its number of rare tokens. No key: no other set can reach the threshold."""
    n = len(tokens)
    if threshold.denominator * n // threshold.numerator <= n and misses(n, threshold) == 0:
        return np.zeros(0, np.uint64), 0  # only an equal set could
    place = frequent.places(tokens)
    rare = tokens[place < 0]
    need = misses(n, threshold) + 1
    if len(rare) >= need:
        return rare[:need], len(rare)
    common = tokens[place >= 0][np.argsort(place[place >= 0], kind="stable")]
    keys = [rare]
    for octave in octaves(n, threshold):
        count = _groups(octave, threshold)
        group = (mix(common + np.uint64(0xA5)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        first = np.ones(len(group), bool)
        first[1:] = np.diff(group[order]) != 0
        gain = np.empty(len(group), np.int64)
        gain[order] = ~first  # the first token of a group, in the order of tokens, gains nothing
        length = int(np.searchsorted(np.cumsum(gain), need - len(rare))) + 1
        used, own = common[:length], group[:length]
        order = np.argsort(own, kind="stable")
        used, own = used[order], own[order]
        for distance in range(1, int(np.bincount(own).max(initial=0))):
            same = own[distance:] == own[:-distance]
            keys.append(mix(used[distance:][same] * np.uint64(3) + mix(used[:-distance][same]) + np.uint64(octave)))
    return np.concatenate(keys), len(rare)


def _index(ngram: int, threshold: Fraction, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in slices(batches, limit=1 << 20):
            keys, nodes, sizes, rares = [np.zeros(0, np.uint64)], [], [], []
            for tokens in token_sets(batch, ngram):
                if len(tokens) and seen.new(node := set_key(tokens)):
                    own, rare = signatures(tokens, frequent.value, threshold)
                    keys.append(own)
                    nodes.append((node, len(own)))
                    sizes.append(len(tokens))
                    rares.append(rare * 1000 // len(tokens))
            times = [c for _, c in nodes]
            columns = [np.concatenate(keys).view(np.int64), np.repeat(np.array([k for k, _ in nodes], np.int64), times)]
            columns += [np.repeat(np.array(x, np.int32), times) for x in (sizes, rares)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "n", "rare"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: those under keys of several nodes, each with the first node of its key (the hub)."""
    last_key, hub, hub_n, last_node, opened = None, 0, 0, None, False
    for batch in batches:
        key, node, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("key", "node", "n"))
        if not len(key):
            continue
        begins = np.ones(len(key), bool)
        begins[1:] = key[1:] != key[:-1]
        begins[0] = key[0] != last_key
        repeat = np.zeros(len(key), bool)  # copies of one set, found by different tasks
        repeat[1:] = (node[1:] == node[:-1]) & ~begins[1:]
        repeat[0] = not begins[0] and node[0] == last_node
        first = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
        hubs = np.where(first >= 0, node[np.maximum(first, 0)], hub)
        hub_sizes = np.where(first >= 0, n[np.maximum(first, 0)], hub_n)
        member = np.flatnonzero(~begins & ~repeat & (hubs != node))
        opens = np.ones(len(member), bool)  # the hub's own row goes with its first other node
        opens[1:] = key[member[1:]] != key[member[:-1]]
        if len(member) and opened and key[member[0]] == last_key:
            opens[0] = False
        opened = bool(len(member) and key[member[-1]] == key[-1]) or (opened and key[-1] == last_key)
        at = member[opens]
        rows = [(key, key), (node, hubs), (n, hub_sizes), (hubs, hubs), (hub_sizes, hub_sizes)]
        last_key, hub, hub_n, last_node = key[-1], hubs[-1], hub_sizes[-1], node[-1]
        columns = [pa.array(np.concatenate([x[member], y[at]])) for x, y in rows]
        yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "hub", "hub_n"])


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the numbers of tokens in 64 * SKETCH classes: each token that differs flips one."""
    odd = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _bloom(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that has two bits of every node set, for dropping most other texts early."""
    place = F.explode(F.array(F.expr(f"node % {BLOOM_BITS}"), F.expr(f"shiftright(node, 30) % {BLOOM_BITS}")))
    places = nodes.select(place.alias("place"))
    bits = places.select(F.expr("shiftright(place, 6)").alias("word"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit"))
    table = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(BLOOM_BITS // 64, np.int64)
    found[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return found.view(np.uint64)


def _in_bloom(bloom: np.ndarray, node: int) -> bool:
    return all(int(bloom[p >> 6]) >> (p & 63) & 1 for p in (node % BLOOM_BITS, (node >> 30) % BLOOM_BITS))


def _details(ngram: int, bloom, whole: bool):
    """Of the sets in the bitmap: their tokens (``whole``), or their sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in slices(batches):
            rows = []
            for tokens in token_sets(batch, ngram):
                if len(tokens) and _in_bloom(bloom.value, node := set_key(tokens)) and seen.new(node):
                    rows.append((node, len(tokens), tokens.tobytes() if whole else sketch(tokens)))
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())]
            columns.append(pa.array([r[2] for r in rows], pa.binary() if whole else pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "tokens" if whole else "sketch"])

    return run


def _details_of(nodes: DataFrame, source: DataFrame, ngram: int, whole: bool) -> DataFrame:
    """node, n and tokens, or sketch, of the given nodes, from one pass over the texts."""
    nodes = nodes.distinct()
    bloom = source.sparkSession.sparkContext.broadcast(_bloom(nodes))
    schema = "node long, n long, tokens binary" if whole else "node long, n long, sketch array<long>"
    found = map_arrow(source.select("text"), _details(ngram, bloom, whole), schema)
    held = stored(found.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sets" if whole else "sketches")
    bloom.destroy()
    given_back()
    return held


def _reaches(threshold: Fraction, shared: Column | np.ndarray, total: Column | np.ndarray):
    """Whether ``shared`` tokens in common, of ``total`` in both sets together, reach the threshold."""
    return shared * (threshold.denominator + threshold.numerator) >= total * threshold.numerator


def _verified(threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = []
            for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b")):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                a, b = (a, b) if len(a) <= len(b) else (b, a)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                shared.append(int((b[at] == a).sum()))
            n = np.array(shared, np.int64)
            linked = _reaches(threshold, n, (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()))
            columns = [batch.column("a"), batch.column("b"), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "shared"]).filter(pa.array(linked))

    return run


@dataclass
class Joined:
    """``documents``: doc_id, n (set size), node (equal sets have one; null: no words). ``links``: verified pairs of
    nodes a < b with ``shared`` tokens. ``labels``: node, label of its component, for linked nodes."""

    documents: DataFrame
    links: DataFrame
    labels: DataFrame

    def component_ids(self) -> DataFrame:
        """doc_id, n, component_id: the smallest doc_id that links lead to."""
        alone = F.coalesce("label", "node")
        docs = self.documents.join(self.labels, "node", "left").withColumn("label", alone)
        least = docs.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
        joined = docs.join(least, "label", "left")
        return joined.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def jaccard_join(docs: DataFrame, ngram: int = NGRAM, threshold: Fraction = THRESHOLD, every_link: bool = False) -> Joined:
    """Link texts (doc_id, text; other columns are ignored) whose sets of word n-grams reach the Jaccard threshold.

    Letters A-Z are lowered. A text of fewer words is one n-gram; a null text or one without words is
    linked with nothing. Rows with equal sets, repeated rows among them, are one node. Rows without a
    doc_id keep a null component, but links lead through them. An empty table gives empty results.
    By default as many links are verified as the components need; ``every_link`` finds all pairs of nodes.
    """
    if not LEAST_THRESHOLD <= threshold <= 1:
        raise ValueError(f"the threshold must lie between {LEAST_THRESHOLD} and 1")
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    documents = stored(map_arrow(source, _nodes(ngram), "doc_id long, n long, node long"), "nodes")
    frequent = spark.sparkContext.broadcast(frequent_tokens(source, ngram))
    index = map_arrow(source.select("text"), _index(ngram, threshold, frequent), "key long, node long, n int, rare int")
    dealt = index.repartition("key").sortWithinPartitions("key", "rare", "node")
    schema = "key long, node long, n long, hub long, hub_n long"
    members = stored(map_arrow(dealt, _stars, schema), "members")
    frequent.destroy()
    given_back()

    fits = F.least("n_a", "n_b") * threshold.denominator >= F.greatest("n_a", "n_b") * threshold.numerator
    most = (threshold.denominator - threshold.numerator, threshold.denominator + threshold.numerator)
    flips = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH)), F.lit(0))
    near = fits & (flips * most[1] <= (F.col("n_a") + F.col("n_b")) * most[0])
    sketches = _details_of(members.select("node"), source, ngram, whole=False)

    def side(table: DataFrame, name: str, *more: str) -> DataFrame:
        return table.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in more))

    def verified(pairs: DataFrame) -> DataFrame:
        """Of the pairs of nodes (a, b), those whose sets reach the threshold."""
        sets = _details_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), source, ngram, whole=True)
        full = pairs.join(side(sets, "a", "n", "tokens"), "a").join(side(sets, "b", "n", "tokens"), "b")
        checked = map_arrow(full.select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b"), _verified(threshold), "a long, b long, shared long")
        return stored(checked, "links")

    stars = members.where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    likely = stars.join(side(sketches, "a", "n", "sketch"), "a").join(side(sketches, "b", "n", "sketch"), "b").where(near)
    likely = stored(likely.select("a", "b"), "pairs")
    links = verified(likely)
    labels = components(links)

    tagged = members.select("key", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if every_link:
        apart = tagged
    else:
        mixed = tagged.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
        apart = tagged.join(mixed.select("key", "low"), "key")
    apart = apart.join(sketches.select("node", "sketch"), "node")
    odd = apart if every_link else apart.where("label != low")
    left, right = (
        t.select("key", F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("label").alias(f"label_{x}"), F.col("sketch").alias(f"sketch_{x}"))
        for t, x in ((odd, "a"), (apart, "b"))
    )
    other = (F.col("a") != F.col("b")) if every_link else (F.col("label_a") != F.col("label_b"))
    pairs = left.join(right, "key").where(other & near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs.join(likely, ["a", "b"], "left_anti"), "pairs")
    if pairs.limit(1).count():
        more = verified(pairs)
        links = links.union(more)
        labels = components(links) if more.limit(1).count() else labels
    return Joined(documents, links, labels)
