"""Document fingerprints by threshold-scaled sketches, in DataFrame operations only.

The sketch of a text holds every hash of its shingles of five words that lies below a fixed fraction of
all hashes, so it grows with the text, and whether a hash is in it depends on that shingle alone. Sketches
merge by union, and the share of one that another holds estimates containment even between very
unequal texts. A text without any hash that low keeps its smallest, which survives merging the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import picked, stored

SHINGLE = 5
#: One hash in so many is kept.
SCALE = 8
#: A hash is the first 15 hexadecimal digits of an md5, 60 bits.
DIGITS = 15
LIMIT = (1 << 4 * DIGITS) // SCALE
#: White space cuts words, and A to Z are lowered.
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = "\t\n\x0b\f\r"


def words(text: Column) -> Column:
    even = F.translate(text, _CAPITALS + _SPACES, _CAPITALS.lower() + " " * len(_SPACES))
    return F.array_remove(F.split(even, " "), "")


def _bound(value: Column, then) -> Column:
    """``then(value)``, with ``value`` worked out once."""
    return F.transform(F.array(value), then)[0]


def sketch(text: Column) -> Column:
    """Ascending distinct hashes of a text's shingles below ``LIMIT``, else its smallest one; none without words.

    A text of fewer than five words is one shingle. The hashes of a long text are never held all at once:
    the numbers of the shingles that stay are found first.
    """

    def of(found: Column) -> Column:
        numbers = F.sequence(F.lit(1), F.greatest(F.size(found) - (SHINGLE - 1), F.lit(1)))

        def digest(i: Column) -> Column:
            return F.substring(F.md5(F.array_join(F.slice(found, i, SHINGLE), " ")), 1, DIGITS)

        def number(digits: Column) -> Column:
            return F.conv(digits, 16, 10).cast("long")

        low = F.filter(numbers, lambda i: digest(i) < F.lit(f"{LIMIT:0{DIGITS}x}"))
        least = F.array(number(F.array_min(F.transform(numbers, digest))))
        kept = _bound(low, lambda some: F.when(F.size(some) > 0, F.transform(some, lambda i: number(digest(i)))).otherwise(least))
        return F.when(F.size(found) > 0, F.sort_array(F.array_distinct(kept))).otherwise(F.array().cast("array<long>"))

    return _bound(words(text), of)


def merged(a: Column, b: Column) -> Column:
    """The sketch of all shingles of two texts, from their sketches."""
    both = F.sort_array(F.array_union(a, b))
    low = F.filter(both, lambda h: h < LIMIT)
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either text that both have, 0 to 1; two texts without words are alike."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, 1.0).otherwise(shared / F.greatest(either, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has, 0 to 1; a text without words is in any other."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, joined by commas."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), ",")


#: What tells documents apart, and orders them. Null ids are the smallest, told from a true one by their mark.
KEY = ["id", "mark"]
_NO_ID = -(1 << 63)


def successors(keys: DataFrame) -> DataFrame:
    """``keys`` (distinct ``KEY`` and other columns) with ``next``, the key that follows; the last is followed by the first.

    The keys are spread by ranges, which are pinned by writing them; a range knows the first key of the
    next one from a table of one row for each range.
    """
    ranged = stored(keys.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id()), "ranges")
    key = F.struct(*KEY)
    firsts = ranged.groupBy("range").agg(F.min(key).alias("first"))
    begin = F.min("first").over(Window.partitionBy())
    ahead = firsts.select("range", F.coalesce(F.lead("first").over(Window.orderBy("range")), begin).alias("ahead"))
    led = ranged.withColumn("next", F.lead(key).over(Window.partitionBy("range").orderBy(*KEY)))
    return led.join(F.broadcast(ahead), "range").withColumn("next", F.coalesce("next", "ahead")).drop("range", "ahead")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) its sketch and that of its edited text.

    Columns: doc_id, n_chars (code points), edited_sha256, sketch, edited_sketch, next_sketch. The edited
    text has the last quarter of the code points (rounded down) replaced by as many from the start of the
    next document, or by all of it if it is shorter. Documents follow each other by doc_id, null first,
    equal ids by a hash of their texts; the last is followed by the first, a single one by itself. A null
    text counts as empty. Rows that share doc_id and text are one document and come out alike, as often as
    they are there. An empty table gives an empty one.

    Texts are shuffled once, one for each document however often it repeats, and starts of texts once.
    """
    rows = picked(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    mark = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit(1))).otherwise(F.xxhash64("text"))
    rows = rows.select("doc_id", "text", F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), mark.alias("mark"))
    quarter = F.expr("length(text) div 4").cast("int").alias("quarter")
    following = stored(successors(rows.select("doc_id", *KEY, quarter).distinct()), "following")

    # Both branches below read the same shuffled rows; they must ask for the same columns for that.
    columns = [F.first("text").alias("text"), F.first(sketch(F.col("text"))).alias("sketch"), F.count(F.lit(1)).alias("copies")]
    one = rows.groupBy(*KEY).agg(*columns)
    wanted = following.select("next.*", F.struct(*KEY).alias("owner"), "doc_id", "quarter")
    ahead = one.where("copies > 0").join(wanted.hint("merge"), KEY)
    start = F.expr("substring(text, 1, quarter)").alias("start")
    ahead = ahead.select("owner.*", "doc_id", "quarter", start, F.col("sketch").alias("next_sketch"))
    both = one.join(ahead.hint("merge"), KEY)
    edited = F.expr("concat(substring(text, 1, length(text) - quarter), start)")
    whole = both.select("doc_id", "text", edited.alias("edited"), "sketch", "next_sketch", "copies")
    found = whole.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        sketch(F.col("edited")).alias("edited_sketch"),
        "next_sketch",
        "copies",
    )
    return found.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).drop("copies", "copy")
