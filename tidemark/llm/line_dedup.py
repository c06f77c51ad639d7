"""Line deduplication by a deletion-neighbourhood join, in DataFrame operations only.

Two lines match when their words are equal or, in lines of at least ``MIN_WORDS`` words, differ by one
word put in, left out or replaced. Lines that match leave an equal rest when the right word is taken
out of one or both, so every line emits the hash of each rest, with the place of the word taken out,
and its own hash; equal hashes are joined. A line stays unless an earlier line matches it, earlier
by (doc_id, row, line number).

- Equal lines are one class first, so a common line is one row from there on.
- One differing word leaves the first or the last half of the words alike. Only classes that share a
  half with another class emit their rests.
- Rests that agree in hash and place are all within the bound of each other, so each needs to meet
  only the earliest: minima are combined before the shuffle, and no pairs within a group are made.
- A match found by hash is verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.once import with_once
from tidemark.llm.tables import looked_up, numbered, stored, table_bytes

MIN_WORDS = 8


def _row() -> Column:
    """Tells rows apart; rows that share doc_id and text are one document."""
    return F.xxhash64("doc_id", "text")


def _lines(docs: DataFrame) -> DataFrame:
    """Every line, those without words among them: doc_id, row, line_no (from 0), words, n."""
    text = F.col("text")
    for sign in "\t\x0b\f\r":  # with the space and the line break, all that cuts words
        text = F.replace(text, F.lit(sign), F.lit(" "))
    lines = docs.select("doc_id", "row", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    words = F.array_remove(F.split("line", " "), "")
    return lines.select("doc_id", "row", "line_no", words.alias("words")).select("*", F.size("words").alias("n"))


def _hashes() -> list[Column]:
    """Hashes of a line's halves: ``a`` and ``b`` cut it in two and tell its class; the middle word of an odd
    number belongs to ``b``, and in ``a2`` and ``b1`` to the other half. Those are for lines that may match by an edit."""
    n, half = F.col("n"), F.expr("n div 2").cast("int")

    def first(size: Column) -> Column:
        return F.xxhash64(F.slice("words", F.lit(1), size))

    def last(size: Column) -> Column:
        return F.xxhash64(F.slice("words", n - size + 1, size))

    odd = (n % 2 == 1) & (n >= MIN_WORDS)
    found = {"a": first(half), "b": last(n - half), "a2": F.when(odd, first(half + 1)), "b1": F.when(odd, last(half))}
    return [column.alias(name) for name, column in found.items()]


def _class_id() -> Column:
    return F.xxhash64("a", "b", "n").alias("k1")


def _halves() -> Column:
    """What a line of at least ``MIN_WORDS`` shares with one that an edit makes equal: its first or last half, for
    the length of either."""
    half = F.expr("n div 2")
    parts = [(0, half, "a"), (1, F.col("n") - half, "b"), (0, half + 1, "a2"), (1, half, "b1")]
    keys = [F.when(F.col(name).isNotNull(), F.xxhash64(F.lit(side), size.cast("int"), F.col(name))) for side, size, name in parts]
    return F.array_compact(F.array(*keys))


def _rests(lines: DataFrame) -> DataFrame:
    """For each line, every rest with one word taken out at ``place``, and the line whole (place -1): key, place, k1, first."""
    # After its last word each line has a place without one, which adds nothing to the sums: what is left there is the whole line.
    ended = F.concat("words", F.array(F.lit(None).cast("string")))
    dealt = lines.repartition("k1").select("k1", "first", "n", F.posexplode(ended).alias("place", "word"))
    is_word = F.col("place") < F.col("n")

    def hashed(place: Column) -> Column:
        return F.when(is_word, F.xxhash64("word", place)).otherwise(F.lit(0).cast("long"))

    here = dealt.select("k1", "first", "n", "place", hashed(F.col("place")).alias("own"), hashed(F.col("place") - 1).alias("moved"))
    by_line = Window.partitionBy("k1")
    so_far = by_line.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = here.select(
        "k1", "first", "n", "place", "own",
        F.bit_xor("own").over(so_far).alias("before"),
        F.bit_xor("moved").over(so_far).alias("moved_before"),
    )
    total = here.groupBy("k1").agg(F.bit_xor("moved").alias("moved_whole"))
    both = summed.join(total, "k1")
    # Words before the place keep their number, words after it move up by one.
    rest = F.col("before").bitwiseXOR(F.col("own")).bitwiseXOR(F.col("moved_whole")).bitwiseXOR(F.col("moved_before"))
    size, place = F.when(is_word, F.col("n") - 1).otherwise(F.col("n")), F.when(is_word, F.col("place")).otherwise(F.lit(-1))
    return both.select(F.xxhash64(rest, size).alias("key"), place.alias("place"), "k1", "first")


def _without(words: Column, place: Column) -> Column:
    kept = F.concat(F.slice(words, F.lit(1), F.greatest(place, F.lit(0))), F.slice(words, place + 2, F.size(words)))
    return F.when(place < 0, words).otherwise(kept)


def near_classes(lines: DataFrame) -> DataFrame:
    """k1 of the lines (k1, first, n, words; one of each class) that an earlier one matches by an edit."""
    rests = stored(_rests(lines), "rests")
    earliest = rests.groupBy("key", "place").agg(F.min(F.struct("first", "place")).alias("at"), F.count(F.lit(1)).alias("c"))
    whole, taken = F.when(F.col("place") < 0, F.col("at")), F.when(F.col("place") >= 0, F.col("at"))
    by_key = earliest.groupBy("key").agg(F.min(whole).alias("whole"), F.min(taken).alias("taken"), F.sum("c").alias("all"))
    # A rest matches rests of the same place, and a whole line; a whole line matches any rest.
    match = F.when(F.col("place") < 0, F.col("taken")).otherwise(F.least("at", "whole"))
    offers = earliest.join(by_key.where("all > 1"), "key").select("key", "place", match.alias("match")).where("match is not null")
    found = rests.join(offers, ["key", "place"]).where("match.first < first").select("k1", "place", "match")
    pairs = found.select("k1", "place", F.col("match.first").alias("first"), F.col("match.place").alias("other_place")).distinct()
    other = lines.select("first", F.col("words").alias("other"))
    both = pairs.join(lines.select("k1", "words"), "k1").join(other, "first")
    same = _without(F.col("words"), F.col("place")) == _without(F.col("other"), F.col("other_place"))
    return both.where(same).select("k1").distinct()


def repeated_lines(docs: DataFrame) -> DataFrame:
    """row, drops: the numbers (from 0) of the lines of each row that an earlier line matches. Rows without any are left out."""
    # Filtered as they are read: a filter on n before the table is written would cut the words twice.
    lines = stored(_lines(docs).select("doc_id", "row", "line_no", "n", *_hashes()), "lines").where("n > 0")
    first = F.struct("doc_id", "row", "line_no")
    classes = lines.groupBy("a", "b", "n").agg(F.min(first).alias("first"), F.min("a2").alias("a2"), F.min("b1").alias("b1"), F.count(F.lit(1)).alias("c"))
    classes = stored(classes.select("*", _class_id()), "line-classes")

    shared = classes.where(F.col("n") >= MIN_WORDS).select("k1", F.explode(_halves()).alias("half"))
    common = shared.groupBy("half").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low != high").select("half")
    candidates = stored(shared.join(common, "half", "left_semi").select("k1").distinct().join(classes.select("k1", "first"), "k1"), "candidates")
    holders = candidates.select(F.col("first.row").alias("row"))
    texts = _lines(looked_up(docs, holders.distinct(), "row", "left_semi", size=table_bytes(holders)))
    cut = with_once(texts, "line", F.struct(first.alias("first"), "n", "words")).select("line.*")
    own = cut.where(F.col("n") >= MIN_WORDS).dropDuplicates(["first"])
    near = stored(near_classes(stored(own.join(candidates.select("first", "k1"), "first"), "candidate-lines")), "near-lines")

    decided = classes.join(near.withColumn("gone", F.lit(True)), "k1", "left").where("gone or c > 1")
    decided = decided.select("a", "b", "n", F.when(F.col("gone").isNull(), F.col("first")).alias("kept"))
    dropped = lines.join(decided, ["a", "b", "n"]).where(F.col("kept").isNull() | (first != F.col("kept")))
    return dropped.groupBy("row").agg(F.collect_set("line_no").alias("drops"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with repeated lines taken out, and n_lines, n_dropped.

    Lines are parts between line breaks; white space cuts words. Lines without words stay. A null text
    stays null, with no lines. Rows that share doc_id and text are one document and stay alike; a null
    doc_id comes before all others. Every row comes out, in any order, even if no line is left; an
    empty table gives an empty one. Columns named n_lines or n_dropped are replaced; all others come
    through whatever their names, and only texts that lose a line are cut up again.
    """
    kept = [n for n, c in enumerate(docs.columns) if c not in ("n_lines", "n_dropped")]
    plain, doc_id, own = numbered(docs, "doc_id", "text")
    texts = plain.withColumnsRenamed({doc_id: "doc_id", own: "text"})
    keyed = texts.withColumn("row", _row())
    drops = stored(repeated_lines(keyed.select("doc_id", "text", "row")), "drops")
    # Cut once: a function of each line that is kept would cut the text again for each.
    found = with_once(looked_up(keyed, drops, "row", "left"), "lines", F.when(F.col("drops").isNotNull(), F.split("text", "\n")))
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    n = F.coalesce(breaks + 1, F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    text = F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    counts = [n.cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped")]
    names = {own: text, doc_id: F.col("doc_id")}
    columns = [names.get(f"c{n}", F.col(f"c{n}")) for n in kept]
    return found.select(*columns, *counts).toDF(*[docs.columns[n] for n in kept], "n_lines", "n_dropped")
