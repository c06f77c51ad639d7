"""The registered queries and the pipeline on given tables, against SQL or plain Python."""

import hashlib
import os
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_joins_and_lines import brute_force, deduped
from test_text_operators import BYTES, WORDS, library
from test_text_operators import brute_force as contaminated
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.queries import CONTROL_TEXT, ORACLES, QUERIES
from tidemark.llm.tables import read, stored

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in "documents benchmark embeddings labels conversations".split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(sql):
    return sql.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    expected = sql.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({ORACLES[name]})").fetchall()
    assert expected and sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, expected))


def test_packing_query(spark, documents):
    rows = QUERIES["op1_best_fit_packing"](spark, FOLDER).collect()
    encode = library(BYTES)
    ids = {d: np.array([*encode(t), 0], "<u4") for d, t, _ in documents}
    used = {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    for places in used.values():
        ends = [0, *np.cumsum([n for _, n in sorted(places)]).tolist()]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
    assert len(used) <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_token_files_query(spark, documents):
    rows = QUERIES["op10_token_files"](spark, FOLDER).orderBy("doc_id").collect()
    encode, start = library(WORDS), 0
    for r, (d, t, _) in zip(rows, documents, strict=True):
        ids = np.array([*encode(t), 2], "<u4")
        assert tuple(r) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_near_duplicates_query(spark, documents):
    got = sorted(map(tuple, QUERIES["op3_ngram_jaccard_join"](spark, FOLDER).select("doc_id", "n_shingles", "component_id").collect()))
    expected, _ = brute_force([t for _, t, _ in documents], 4, Fraction(85, 100))
    ids = [d for d, _, _ in documents]
    assert got == [(ids[n], size, ids[c]) for n, size, c in expected]


def test_chat_query(spark, sql):
    turns = {}
    for c, role, text in sql.execute("SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        turns.setdefault(c, []).append((role, text or ""))
    turns[-1] = [("user", CONTROL_TEXT), ("assistant", CONTROL_TEXT)]
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = {}
    for c, own in turns.items():
        loss = "".join(text for role, text in own if role == "assistant")
        expected[c] = (len(own), digest("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), digest(loss))
    got = QUERIES["op4_chat_formatting"](spark, FOLDER).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == expected and len(got) == len(expected)


def test_classifier_queries(spark, sql, documents):
    quality = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, FOLDER).collect()}
    lang = {r["doc_id"]: r for r in QUERIES["op9_language_id"](spark, FOLDER).collect()}
    assert set(quality) == set(lang) == {d for d, _, _ in documents}
    for d in quality:
        assert quality[d]["held_out"] == lang[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert quality[d]["predicted"] == (quality[d]["score"] >= 0.7) and 0 <= lang[d]["score"] <= 1
    held = [(quality[d]["predicted"], q) for d, q in sql.execute("SELECT doc_id, quality FROM labels").fetchall() if quality[d]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.85
    held = [(lang[d]["lang_pred"], x) for d, _, x in documents if lang[d]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_surrogates_query(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op7_pii_surrogates"](spark, FOLDER).collect()}
    kinds = [r"[\w.]+@[\w.]+\.com", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"(?<!\d)\d{16}(?!\d)", r"(?<![\d.])\d+\.\d+\.\d+\.\d+", "AKIA[0-9A-Z]{16}"]
    for d, text, _ in documents:
        for kind in kinds:
            old, new = re.findall(kind, text), re.findall(kind, got[d]["text"])
            assert len(old) == len(new) and not set(old) & set(new)
        if not got[d]["n_entities"]:
            assert got[d]["text"] == text
    assert sum(r["n_entities"] for r in got.values()) > 5


def test_pipeline(spark, sql):
    docs = read(spark, FOLDER, "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "s", 0), (-6, None, "en", "s", None)], docs.schema)
    docs = stored(docs.union(docs.where("doc_id < 3")).union(extra), "documents")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, FOLDER), name)
        found[name] = (sorted(map(tuple, before.select("doc_id", "text").collect()), key=str), docs)
        assert name == "best_fit_packing" or docs.columns == columns
    texts = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)

    before, after = found["quality_classifier"]
    assert 0 < len(texts(after)) < len(before) and set(texts(after)) <= set(before)

    before, after = found["line_dedup"]
    expected = {(d, t) for d, t, _, dropped in deduped(set(before)) if not (dropped and not t.strip())}
    assert set(texts(after)) == expected
    assert after.where("text IS NOT NULL AND n_chars != length(text) AND doc_id > 0").count() == 0

    before, after = found["ngram_jaccard_join"]
    distinct = sorted({b for b in before if b[0] is not None})
    label = [c for _, _, c in brute_force([t for _, t in distinct], 5, Fraction(4, 5))[0]]
    stays = {d for n, d in enumerate(distinct) if label[n] == n}
    assert [t for t in texts(after) if t[0] is not None] == sorted(stays, key=str)

    before, after = found["benchmark_decontamination"]
    items = sql.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert texts(after) == [b for b, x in zip(before, contaminated([t for _, t in before], items, 13)) if not x[3]]

    before, after = found["best_fit_packing"]
    encode = Tokenizer.from_file(BYTES).encode
    sizes = after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in sizes} == {d: len(encode(t or "", add_special_tokens=False).ids) + 1 for d, t in before}
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


CLASHING = "row,drops,_row,_drops,c0,c1,gone,_found,_salt,key,n,label,score,component,first,n_lines_,Lines,doc_id_".split(",")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, name, stage):
    docs = read(spark, FOLDER, "documents").where("doc_id < 120")
    own = docs.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHING])
    kept = stage(spark, own, FOLDER)
    assert kept.columns == own.columns
    plain = {r["doc_id"]: r["text"] for r in stage(spark, docs, FOLDER).collect()}
    rows = kept.collect()
    assert plain and {r["doc_id"]: r["text"] for r in rows} == plain
    assert all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in CLASHING)
    assert stage(spark, own.limit(0), FOLDER).collect() == []


def test_columns_that_differ_in_case(spark):
    docs = spark.createDataFrame([(1, "one line", "other", 5), (2, "one line", "other", 6)], "doc_id long, text string, Text string, DOC_ID long")
    rows = corpus_pipeline.drop_repeated_lines(spark, docs, FOLDER).collect()
    assert [tuple(r) for r in rows] == [(1, "one line", "other", 5)]


def test_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_near_duplicates_go_by_row(spark):
    a, b = " ".join(f"a{n}" for n in range(30)), " ".join(f"b{n}" for n in range(30))
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b), (None, a), (8, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each(spark, docs, FOLDER).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (5, b), (None, a), (8, ""), (9, None)], key=str)
