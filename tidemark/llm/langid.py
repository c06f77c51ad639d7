"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

A text is its letters in lower case, with one blank for whatever stands between them. 4-grams are
counted over all texts whose language is given, and lower orders by the distinct characters before
them. Small models are kept as sorted arrays of hashed n-grams with their log probabilities, and of hashed
contexts with their back-off weights, which are broadcast. Beyond ``MOST_GRAMS`` or ``MOST_LANGUAGES``
the same models are tables, and the n-grams of the texts are joined with them; nothing is left out. The language of lowest cross-entropy per character is chosen.
A temperature and a rejection threshold are fitted on all those texts, too: each is scored by models of the
other parts, so that none meets its own counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_BYTES, HELD_OUT, fold, map_arrow, slices, stored
from tidemark.llm.words import mix
from tidemark.operators.joins import ROWS_PER_SALT, lookup_join

ORDER = 4
UNKNOWN = "und"
#: Bounds of the models that are broadcast: n-grams of all languages together, and languages. Larger ones stay in tables.
MOST_GRAMS = 1 << 21
MOST_LANGUAGES = 256
#: The texts learnt from are dealt to so many parts; each part is scored by models of the others.
PARTS = 2
TEMPERATURES = np.geomspace(0.02, 20, 60)
ACCEPTED_RIGHT = 0.99
SLICE = 1 << 20

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    return _letters[0]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """16-bit characters of all texts, each after three zeros, and where each text begins."""
    joined = "".join("\0\0\0" + (t or "").replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    other = np.flatnonzero(codes > 0xFFFF)
    letter = _is_letter()[np.minimum(codes, 0xFFFF)]
    if len(other):
        points, at = np.unique(codes[other], return_inverse=True)
        letter[other] = np.array([chr(c).isalpha() for c in points.tolist()])[at]
    codes = np.where(codes > 0xFFFF, 0x4E00 + codes % 0x5000, codes).astype(np.uint16)  # letters of other planes: folded onto CJK ones
    codes = np.where(letter | (codes == 0), codes, 32)
    kept = codes != 32
    kept[1:] |= letter[:-1]
    codes = codes[kept]
    return codes, np.flatnonzero(codes == 0)[2::3] + 1


def grams(codes: np.ndarray) -> np.ndarray:
    """The 4-gram that ends at each character, 16 bits a character; 0 at the zeros."""
    wide = codes.astype(np.uint64)
    found = wide.copy()
    for i in range(1, ORDER):
        found[i:] |= wide[:-i] << np.uint64(16 * i)
    found[codes == 0] = 0
    return found


@dataclass
class Model:
    """For each order: sorted hashes of n-grams, log probabilities; sorted hashes of contexts, log back-off weights."""

    seen: list[tuple[np.ndarray, np.ndarray]]
    back: list[tuple[np.ndarray, np.ndarray]]
    floor: float

    def log_p(self, keys: np.ndarray) -> np.ndarray:
        """Natural log probability of the last character of each 4-gram after the others."""
        found = np.full(len(keys), self.floor)
        for order in range(1, ORDER + 1):
            own = keys & np.uint64((1 << 16 * order) - 1)
            if order > 1:
                found = found + _find(*self.back[order - 1], mix(own >> np.uint64(16)), 0.0)
            value = _find(*self.seen[order - 1], mix(own), np.nan)
            found = np.where(np.isnan(value), found, value)
        return found


def _find(hashes: np.ndarray, values: np.ndarray, keys: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
    return np.where(hashes[at] == keys, values[at], default)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = mix(keys)
    order = np.argsort(hashes)
    return hashes[order], values[order]


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> Model:
    """A model of the 4-grams ``keys`` and their counts."""
    tables = [(keys, counts)]
    for order in range(ORDER - 1, 0, -1):  # distinct characters before each shorter n-gram
        tables.insert(0, np.unique(tables[0][0] & np.uint64((1 << 16 * order) - 1), return_counts=True))
    seen, back, log_p = [], [], None
    floor = 0.0
    for order, (grams_, n) in enumerate(tables, 1):
        ones, twos = int((n == 1).sum()), int((n == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, at = np.unique(grams_ >> np.uint64(16), return_inverse=True)
        total = np.bincount(at, weights=n)
        weight = discount * np.bincount(at) / total
        if order == 1:
            lower = np.full(len(grams_), 1.0 / (len(grams_) + 1))
            floor = float(np.log(weight[0] / (len(grams_) + 1)))
        else:
            shorter, values = tables[order - 2][0], log_p
            lower = np.exp(values[np.searchsorted(shorter, grams_ & np.uint64((1 << 16 * (order - 1)) - 1))])
        log_p = np.log(np.maximum(n - discount, 0) / total[at] + weight[at] * lower)
        seen.append(_sorted(grams_, log_p))
        back.append(_sorted(contexts, np.log(weight)))
    return Model(seen, back, floor)


def _counted(langs: dict[tuple[int, str], int]):
    """Counts of 4-grams by part and language, whose number is ``langs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in langs]
        size = 0

        def merged() -> Iterator[pa.RecordBatch]:
            for lang, parts in enumerate(held):
                if parts:
                    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                    n = np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                    columns = [pa.array(np.full(len(keys), lang, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
                parts.clear()

        for batch in slices(batches, limit=SLICE):
            own = np.array([langs[x] for x in zip(batch.column("part").to_pylist(), batch.column("lang").to_pylist())])
            codes, begin = characters(batch.column("text").to_pylist())
            keys, text = grams(codes), np.searchsorted(begin, np.arange(len(codes)), "right") - 1
            for lang in np.unique(own).tolist():
                part = keys[(own[text] == lang) & (keys != 0) & (codes != 0)]
                held[lang].append(np.unique(part, return_counts=True))
                size += len(held[lang][-1][0])
            if size > 1 << 20:
                yield from merged()
                size = 0
        yield from merged()

    return run


@dataclass
class Tables:
    """Models as ``Model`` has them, in tables: for each order gram and its log probabilities by language; context and log
    back-off weights by language (its place in the names). ``floors``: by language."""

    seen: list[DataFrame]
    back: list[DataFrame]
    floors: list[float]


def _suffix(order: int) -> Column:
    return F.col("gram") if order == ORDER else F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))


def kneser_ney_tables(table: DataFrame) -> Tables:
    """The models of ``table`` (lang, gram, n), one for each lang from 0 on; no row but the few by language meets the driver."""
    counts = {ORDER: table}
    for order in range(ORDER - 1, 0, -1):  # distinct characters before each shorter n-gram
        shorter = counts[order + 1].groupBy("lang", _suffix(order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counts[order] = stored(shorter, "language-counts")
    seen, back, floors, log_p = [], [], [], None
    for order in range(1, ORDER + 1):
        ones, twos = (F.sum((F.col("n") == k).cast("long")) for k in (1, 2))
        discount = F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5)
        by_lang = counts[order].groupBy("lang").agg(discount.alias("discount"), F.count(F.lit(1)).alias("size"))
        by_lang = F.broadcast(stored(by_lang, "language-discounts"))  # a row for each language
        keyed = counts[order].withColumn("context", F.shiftrightunsigned("gram", 16))
        contexts = keyed.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("after")).join(by_lang, "lang")
        contexts = stored(contexts.withColumn("weight", F.col("discount") * F.col("after") / F.col("total")), "language-contexts")
        rows = keyed.join(contexts.select("lang", "context", "total", "weight", "discount", "size"), ["lang", "context"])
        if order == 1:
            rows = rows.withColumn("lower", 1 / (F.col("size") + 1))
            found = contexts.select("lang", F.log(F.col("weight") / (F.col("size") + 1)).alias("floor")).orderBy("lang").collect()
            floors = [r["floor"] for r in found]
        else:
            shorter = log_p.select("lang", F.col("gram").alias("shorter"), F.exp("log_p").alias("lower"))
            rows = rows.withColumn("shorter", _suffix(order - 1)).join(shorter, ["lang", "shorter"])
        p = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        log_p = stored(rows.select("lang", "gram", F.log(p).alias("log_p")), "language-probabilities")
        seen.append(_by_language(log_p, "gram", F.col("log_p")))
        back.append(_by_language(contexts, "context", F.log("weight")))
    return Tables(seen, back, floors)


def _by_language(table: DataFrame, key: str, value: Column) -> DataFrame:
    """One row for each key: its value by language."""
    entries = F.map_from_entries(F.collect_list(F.struct("lang", value.alias("value"))))
    return stored(table.groupBy(key).agg(entries.alias("values")), "language-models")


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text (gram null) with its number of characters, and one for each of its distinct 4-grams."""
    for batch in slices(batches, limit=SLICE):
        codes, begin = characters(batch.column("text").to_pylist())
        size = np.append(begin[1:] - 3, len(codes)) - begin
        n, names = batch.num_rows, ["row", "own", "size", "gram", "n"]
        nothing = [pa.nulls(n, pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("own"), pa.array(size, pa.int64()), *nothing], names)
        keys, text = grams(codes), np.searchsorted(begin, np.arange(len(codes)), "right") - 1
        keys, text = keys[codes != 0], text[codes != 0]
        order = np.lexsort((keys, text))
        keys, text = keys[order], text[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(first)
        rows = pa.array(np.asarray(batch.column("row"))[text[first]], pa.int64())
        nothing = [pa.nulls(len(first), batch.column("own").type), pa.nulls(len(first), pa.int64())]
        columns = [rows, *nothing, pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(keys))), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)


def _joined_entropies(docs: DataFrame, own: str, tables: Tables) -> DataFrame:
    """Per row of ``docs``: its column ``own``, the entropies by all models (null without a letter), and the number of characters."""
    kind = dict(docs.dtypes)[own]
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(own).alias("own"), "text")
    texts = stored(map_arrow(numbered, _text_grams, f"row long, own {kind}, size long, gram long, n long"), "text-grams")
    asked = texts.where("gram is not null").select("row", "gram", "n")
    suffixes = {ORDER: stored(asked.select("gram").distinct(), "asked-grams")}
    for order in range(ORDER - 1, 0, -1):
        suffixes[order] = stored(suffixes[order + 1].select(_suffix(order).alias("gram")).distinct(), "asked-grams")

    def looked(rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
        return stored(lookup_join(rows, table, on, BROADCAST_BYTES, ROWS_PER_SALT), "asked-values")

    value = F.array(*(F.lit(x) for x in tables.floors))
    for order in range(1, ORDER + 1):
        rows = suffixes[order]
        if order > 1:
            rows = rows.withColumn("shorter", _suffix(order - 1)).withColumn("context", F.shiftrightunsigned("gram", 16))
            rows = looked(rows, values.withColumnRenamed("gram", "shorter"), "shorter")
            rows = looked(rows, tables.back[order - 1].withColumnRenamed("values", "weights"), "context")
            weight = lambda i: F.coalesce(F.try_element_at("weights", i), F.lit(0.0))
            value = F.transform("p", lambda p, i: p + weight(i))
        rows = looked(rows, tables.seen[order - 1], "gram")
        found = F.transform(value, lambda p, i: F.coalesce(F.try_element_at("values", i), p))
        values = stored(rows.select("gram", found.alias("p")), "asked-values")
    scored = lookup_join(asked, values, "gram", BROADCAST_BYTES, ROWS_PER_SALT)
    sums = [F.sum(F.col("n") * F.col("p")[i]).alias(f"_{i}") for i in range(len(tables.floors))]
    sums = scored.groupBy("row").agg(*sums)
    sums = sums.select("row", F.array(*(c for c in sums.columns if c != "row")).alias("sums"))
    whole = texts.where("gram is null").select("row", "own", "size").join(sums, "row", "left")
    return whole.select(F.col("own").alias(own), F.transform("sums", lambda x: -x / F.col("size")).alias("entropies"), "size")


@dataclass
class Languages:
    """Fitted models (or ``tables``), the temperature, and the score below which a prediction is rejected."""

    names: list[str]
    models: list[Model]
    temperature: float = 1.0
    reject_below: float = 0.0
    tables: Tables | None = field(default=None, repr=False)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character by each model, for each text, and its number of characters."""
        codes, begin = characters(texts)
        keys, at = np.unique(grams(codes), return_inverse=True)
        ends = np.append(begin[1:] - 3, len(codes))
        found = np.zeros((len(texts), len(self.models)))
        for i, model in enumerate(self.models):
            value = model.log_p(keys)
            value[keys == 0] = 0
            total = np.concatenate([[0.0], np.cumsum(value[at])])
            found[:, i] = total[begin] - total[ends]
        size = ends - begin
        return found / np.maximum(size, 1)[:, None], size

    def scores(self, entropies: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Probabilities of the languages."""
        return softmax(-entropies * np.sqrt(size)[:, None] / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _entropy_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            values, size = shared.value.entropies(batch.column("text").to_pylist())
            columns = [batch.column("lang"), pa.array(list(values), pa.list_(pa.float64())), pa.array(size)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "entropies", "size"])

    return run


def _part(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(PARTS)).cast("int")


def fit(docs: DataFrame) -> Languages:
    """Learn from the rows that are not held out and have a text with letters and a language.

    All of them are counted, and all of them calibrate; every language and n-gram is learnt.
    """
    known = docs.where("lang is not null and text is not null").where(fold(F.col("doc_id")) != HELD_OUT)
    known = known.select(_part(F.col("doc_id")).alias("part"), "lang", "text")
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    index = {(part, name): part * len(names) + i for i, name in enumerate(names) for part in range(PARTS)}
    counts = map_arrow(known, _counted(index), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    part, lang = F.floor(F.col("lang") / len(names)).cast("int"), F.pmod("lang", F.lit(len(names))).alias("lang")
    counts = stored(counts.select(part.alias("part"), lang, "gram", "n"), "language-grams") if names else None
    found = _modelled(counts, names)
    if found.names:
        _calibrate(found, known, counts, names)
    return found


def _modelled(counts: DataFrame | None, names: list[str]) -> Languages:
    """Models of ``counts`` (lang, gram, n; several rows of a gram add up), of those ``names`` that have any."""
    if counts is None:
        return Languages([], [])
    table = stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    sizes = {r["lang"]: r["grams"] for r in table.groupBy("lang").agg(F.count(F.lit(1)).alias("grams")).collect()}
    found = Languages([names[i] for i in sorted(sizes)], [])
    if sum(sizes.values()) > MOST_GRAMS or len(sizes) > MOST_LANGUAGES:
        place = F.array_position(F.array(*(F.lit(i) for i in sorted(sizes))), F.col("lang")) - 1
        found.tables = kneser_ney_tables(table.withColumn("lang", place.cast("int")))
    elif sizes:
        rows = table.toArrow()
        lang, gram, n = (rows.column(c).to_numpy() for c in ("lang", "gram", "n"))
        for i in sorted(sizes):
            keys, order = np.unique(gram[lang == i].view(np.uint64), return_index=True)
            found.models.append(kneser_ney(keys, n[lang == i][order]))
    return found


def _calibrate(found: Languages, known: DataFrame, counts: DataFrame, names: list[str]) -> None:
    """Set the temperature of least log loss and the lowest threshold that leaves enough right, by all of ``known``.

    Texts whose language no other part holds are left out: models without it tell nothing about them.
    """
    rows = [_scored(_modelled(counts.where(F.col("part") != part), names), known.where(F.col("part") == part), names) for part in range(PARTS)]
    rows = [stored(part, "language-entropies") for part in rows if part is not None]
    if not rows:
        return
    scored = reduce(DataFrame.union, rows)
    losses = map_arrow(scored, _losses(found), "step int, loss double").groupBy("step").agg(F.sum("loss").alias("loss")).collect()
    if not losses:
        return
    found.temperature = float(TEMPERATURES[min(losses, key=lambda r: (r["loss"], r["step"]))["step"]])
    best = map_arrow(scored, _decisions(found), "best double, right boolean")
    found.reject_below = _threshold(best)
    found.reject_below -= 1e-12  # sums over joined rows differ from others in their last digits


def _scored(models: Languages, rows: DataFrame, names: list[str]) -> DataFrame | None:
    """truth (place in ``names``), entropies (by all ``names``; infinite for those without a model) and size of the ``rows``
    with letters whose language ``models`` know; None if they know none."""
    if not models.names:
        return None
    rows = rows.where(F.col("lang").isin(models.names)).select("lang", "text")
    if models.tables:
        rows = _joined_entropies(rows, "lang", models.tables)
    else:
        shared = rows.sparkSession.sparkContext.broadcast(models)
        rows = map_arrow(rows, _entropy_rows(shared), "lang string, entropies array<double>, size long")
    place = {name: F.get("entropies", F.lit(i)) for i, name in enumerate(models.names)}
    by_all = F.array(*(place.get(name, F.lit(float("inf"))) for name in names))
    truth = F.array_position(F.array(*map(F.lit, names)), F.col("lang")) - 1
    return rows.where("size > 0").select(truth.alias("truth"), by_all.alias("entropies"), "size")


def _probabilities(batch: pa.RecordBatch, light: Languages) -> tuple[np.ndarray, np.ndarray]:
    values = batch.column("entropies").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return light.scores(values, np.asarray(batch.column("size"))), np.asarray(batch.column("truth"))


def _losses(found: Languages):
    """For each batch, the log loss of its texts at each of the ``TEMPERATURES``."""
    lights = [Languages(found.names, [], t) for t in TEMPERATURES.tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = [_probabilities(batch, light) for light in lights]
                loss = [-np.log(np.maximum(p[np.arange(len(p)), truth], 1e-12)).sum() for p, truth in both]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(loss), dtype=np.int32)), pa.array(loss)], ["step", "loss"])

    return run


def _decisions(found: Languages):
    """For each text, the probability of the language chosen, and whether it is the right one."""
    light = Languages(found.names, [], found.temperature)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p, truth = _probabilities(batch, light)
                yield pa.RecordBatch.from_arrays([pa.array(p.max(axis=1)), pa.array(p.argmax(axis=1) == truth)], ["best", "right"])

    return run


def _threshold(decisions: DataFrame) -> float:
    """The lowest score such that of all ``decisions`` (best, right) from it upwards enough are right; 1 if there is none.

    Scores are counted up from the highest in ranges, each of which starts from the sums of those above it.
    """
    counted = decisions.groupBy("best").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("right").cast("long")).alias("right"))
    dealt = counted.repartitionByRange(F.col("best").desc()).withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, "language-scores")
    ranges = dealt.groupBy("range").agg(F.max("best").alias("top"), F.sum("n").alias("n"), F.sum("right").alias("right"))
    above = Window.orderBy(F.col("top").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = [F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("n", "right")]
    so_far = Window.partitionBy("range").orderBy(F.col("best").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = dealt.join(F.broadcast(ranges.select("range", *before)), "range")
    share = (F.col("right_above") + F.sum("right").over(so_far)) / (F.col("n_above") + F.sum("n").over(so_far))
    lowest = summed.select("best", share.alias("share")).where(F.col("share") >= ACCEPTED_RIGHT).agg(F.min("best")).first()[0]
    return 1.0 if lowest is None else lowest


def identify(docs: DataFrame, fitted: Languages) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score (0 to 1), accepted.

    ``und`` with score 0, not accepted, if the text is null or has no letter, or nothing was learnt. Equal scores go to the
    first language by name. ``accepted`` is false below the calibrated threshold. Every row comes out, repeated ones too.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    light = Languages(fitted.names, [], fitted.temperature, fitted.reject_below)

    def decided(ids: pa.Array, values: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        names, best = np.full(len(ids), UNKNOWN, object), np.zeros(len(ids))
        if light.names:
            p = light.scores(values, size)
            some = size > 0
            names[some] = np.array(light.names, object)[p.argmax(axis=1)][some]
            best[some] = p.max(axis=1)[some]
        accepted = (names != UNKNOWN) & (best >= light.reject_below)
        columns = [ids, pa.array(names.tolist(), pa.string()), pa.array(best), pa.array(accepted.tolist(), pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "accepted"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in slices(batches, limit=SLICE):
            values, size = models.entropies(batch.column("text").to_pylist())
            yield decided(batch.column("doc_id"), values, size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.zeros((batch.num_rows, len(light.names)))
            for i, x in enumerate(batch.column("entropies")):
                if x.is_valid:
                    values[i] = x.values
            yield decided(batch.column("doc_id"), values, np.asarray(batch.column("size")))

    schema = "doc_id long, lang_pred string, score double, accepted boolean"
    if fitted.tables:
        return map_arrow(_joined_entropies(source, "doc_id", fitted.tables), read, schema)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    return map_arrow(source, run, schema)
