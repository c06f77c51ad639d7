"""The corpus pipeline: five stages in order, each over what its predecessor kept.

Documents that the quality classifier rejects go; repeated lines are taken out, and a document of
which nothing is left goes; of each group of near duplicates the document with the smallest doc_id
stays; contaminated documents go; the rest is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.decontaminate import contamination
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_join import jaccard_join
from tidemark.llm.packing import pack
from tidemark.llm.queries import BYTE_BPE, KEEP_SCORE
from tidemark.llm.tables import BROADCAST_BYTES, looked_up, numbered, read, renamed, stored
from tidemark.operators.joins import lookup_join

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1, ... whatever their names, and doc_id, text and a key ``row`` of both beside them."""
    plain, doc_id, text = numbered(docs, "doc_id", "text")
    own = plain.select("*", F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.withColumn("row", F.xxhash64("doc_id", "text"))


def _texts(keyed: DataFrame) -> DataFrame:
    """What an operator reads: each row's key as its doc_id, and its text."""
    return keyed.select(F.col("row").alias("doc_id"), "text")


def _without(keyed: DataFrame, gone: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, of the keyed rows whose ``row`` isn't in ``gone``."""
    left = looked_up(keyed, stored(gone.select("row").distinct(), "gone"), "row", "left_anti")
    return renamed(left, docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score for quality is at least ``KEEP_SCORE``; each row by its own text, whatever its doc_id.

    A null text counts as empty. All columns stay as they are, whatever their names; an empty table stays empty.
    """
    keyed = _keyed(docs)
    fitted = quality.fit(keyed, read(spark, sf_dir, "labels"))
    bad = quality.score(_texts(keyed), fitted).where(F.col("score") < KEEP_SCORE)
    kept = _without(keyed, bad.select(F.col("doc_id").alias("row")), docs)
    fitted.release()
    return kept


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier one matches. A document that loses all its words goes; n_chars follows the text.

    All other columns stay as they are, whatever their names; null and empty texts stay, and so does an empty table.
    """
    plain, doc_id, text = numbered(docs, "doc_id", "text")
    found = dedup_lines(plain.withColumnsRenamed({doc_id: "doc_id", text: "text"}))
    found = found.where(~((F.col("n_dropped") > 0) & ~F.regexp_like("text", F.lit(r"\S"))))
    if "n_chars" in docs.columns:
        own = plain.columns[docs.columns.index("n_chars")]
        kind = plain.schema[own].dataType
        found = found.withColumn(own, F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col(own)))
    return renamed(found.drop("n_lines", "n_dropped").withColumnsRenamed({"doc_id": doc_id, "text": text}), docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by word 5-grams at 0.8 or more, the one with the smallest doc_id; of repeated rows, one.

    Each row goes by its own text, whatever its doc_id; of rows that share the smallest one, the first by hash stays.
    Documents without words or doc_id stay. All columns stay as they are, whatever their names; an empty table stays empty.
    """
    rows = _keyed(docs)
    known = rows.where("doc_id is not null")
    found = jaccard_join(_texts(known)).component_ids()
    linked = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    linked = stored(known.select("doc_id", "row").distinct().join(linked.distinct(), "row"), "linked")
    own = F.struct("doc_id", "row")
    first = linked.groupBy("component").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first.select("component", "first"), "first-of-each")
    others = lookup_join(linked, first, "component", BROADCAST_BYTES).where(own != F.col("first")).select("row")
    others = stored(others.distinct(), "gone")
    repeated = rows.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row")
    repeated = stored(repeated, "repeated")
    left = looked_up(rows, others, "row", "left_anti")
    if repeated.limit(1).count():
        one = looked_up(left, repeated, "row", "left_semi").dropDuplicates(["row"])
        left = looked_up(left, repeated, "row", "left_anti").unionByName(one)
    return renamed(left, docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark; each row by its own text.

    Null and empty texts stay. All columns stay as they are, whatever their names; an empty table stays empty.
    """
    keyed = _keyed(docs)
    found = contamination(_texts(keyed), read(spark, sf_dir, "benchmark"))
    return _without(keyed, found.where("contaminated").select(F.col("doc_id").alias("row")), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    placed = pack(docs, BYTE_BPE).placed
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the classifier and the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
