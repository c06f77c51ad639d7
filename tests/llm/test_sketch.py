"""Threshold-scaled sketches against plain Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.sketch import SCALE, containment, fingerprint, fingerprints, likeness, merged, sketch


def by_hand(text):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = [" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []
    found = {int(hashlib.md5(run.encode()).hexdigest()[:15], 16) for run in runs}
    low = sorted(h for h in found if h < 16**15 // SCALE)
    return low or ([min(found)] if found else [])


def long(n, seed):
    return " ".join(f"w{(seed * 7919 + i * i) % 5003}" for i in range(n))


TEXTS = ["", " \t\n\x0b", "one", "One two", "a b c d", "a b c d e", "A B\tC\nD\rE f", "é日 😀 ẞ İ Σ", "x y z", "a " * 300, long(9, 1), long(400, 2), long(5000, 3), "q" * 100_000]


def test_sketch_is_the_low_hashes(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "n int, t string")
    got = {r["n"]: r for r in rows.select("n", sketch(F.col("t")).alias("s"), fingerprint(sketch(F.col("t"))).alias("f")).collect()}
    for n, text in enumerate(TEXTS):
        assert got[n]["s"] == by_hand(text), text[:40]
        assert got[n]["f"] == ",".join(f"{h:015x}" for h in by_hand(text))
    share = len(by_hand(long(5000, 3))) / len({tuple(long(5000, 3).split()[i : i + 5]) for i in range(4996)})
    assert 0.8 / SCALE < share < 1.2 / SCALE


def test_sketches_merge_and_compare(spark):
    texts = [t for t in TEXTS if len(t) < 50_000]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    a, b = F.col("x"), F.col("y")
    both = rows.select("a", "b", sketch(F.col("a")).alias("x"), sketch(F.col("b")).alias("y"))
    for r in both.select("a", "b", merged(a, b).alias("m"), likeness(a, b).alias("l"), containment(a, b).alias("c")).collect():
        x, y = set(by_hand(r["a"])), set(by_hand(r["b"]))
        low = sorted(h for h in x | y if h < 16**15 // SCALE)
        assert r["m"] == (low or sorted(x | y)[:1])
        assert r["l"] == (len(x & y) / len(x | y) if x | y else 1.0) and r["c"] == (len(x & y) / len(x) if x else 1.0)


def test_containment_of_unequal_texts(spark):
    whole = " ".join(f"w{i}" for i in range(20_000))
    part = " ".join(f"w{i}" for i in range(4_000, 6_000))
    row = spark.createDataFrame([(part, whole)], "a string, b string").select(sketch(F.col("a")).alias("x"), sketch(F.col("b")).alias("y"))
    found = row.select(containment(F.col("x"), F.col("y")), containment(F.col("y"), F.col("x")), likeness(F.col("x"), F.col("y"))).first()
    assert found[0] == 1.0 and abs(found[1] - 0.1) < 0.02 and abs(found[2] - 0.1) < 0.02


def expected(rows):
    """By (doc_id, text): n_chars, edited text and next text; rows are sorted."""
    found = {}
    for (d, text), (_, ahead) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        found[d, text] = (len(text), text[: len(text) - cut] + ahead[:cut], ahead)
    return found


def checked(got, rows):
    want = expected(rows)
    for r in got:
        hits = [(k, v) for k, v in want.items() if k[0] == r["doc_id"] and hashlib.sha256(v[1].encode()).hexdigest() == r["edited_sha256"]]
        assert hits, r["doc_id"]
        (_, text), (n, edited, ahead) = hits[0]
        assert r["n_chars"] == n and r["sketch"] == by_hand(text)
        assert r["edited_sketch"] == by_hand(edited) and r["next_sketch"] == by_hand(ahead)


def test_fingerprints(spark):
    rows = [(None, long(30, 9))] + [(n * 3 - 20, text) for n, text in enumerate(TEXTS)] + [(1 << 60, "last one of them all " * 9)]
    table = spark.createDataFrame([(d, t or None, "x", 5, 6) for d, t in rows], "doc_id long, text string, sketch string, quarter int, `key` int")
    repeated = table.union(table.where("doc_id in (-20, -11, 13) or doc_id is null"))
    got = fingerprints(repeated.repartition(5)).collect()
    assert len(got) == len(rows) + 4
    checked(got, rows)
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((r["doc_id"] for r in repeated.collect()), key=str)


def test_ids_that_several_texts_share(spark):
    texts = [long(40, n) for n in range(6)]
    table = spark.createDataFrame([(7, t) for t in texts] + [(-(1 << 63), texts[0]), (None, texts[0])], "doc_id long, text string")
    got = fingerprints(table).collect()
    assert sorted(map(str, (r["sketch"] for r in got))) == sorted(str(by_hand(t)) for t in texts + [texts[0]] * 2)
    # Each is followed by another one of the table.
    assert sorted(str(r["next_sketch"]) for r in got) == sorted(str(r["sketch"]) for r in got)


@pytest.mark.parametrize("rows", [[], [(1, "a lonely text of some words")], [(1, None)], [(None, "")]])
def test_small_tables(spark, rows):
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    checked(got, [(d, t or "") for d, t in rows])


def test_plan_is_native_and_shuffles_texts_once(spark):
    table = spark.createDataFrame([(n, long(20, n)) for n in range(40)], "doc_id long, text string")
    df = fingerprints(table)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and "SortMergeJoin" in plan
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
