"""The lookup in a versioned table against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.versions import as_of_lookup, invert_versions, version_blocks


def by_hand(versions, moment, key):
    past = [v for v, _, _ in versions if v is not None and moment is not None and v <= moment]
    if not past:
        return None
    return max((area for v, k, area in versions if v == max(past) and k == key), default=None)


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 0}, {"max_broadcast": 0, "rows_per_salt": 20}])
@pytest.mark.parametrize("moments", [[10], [0, 1, 2, 3, 1000], [-50, -49, 7, 400, 401, 402, 403, 404, 405, 900], list(range(0, 3000, 60))])
def test_every_row_meets_the_version_of_its_time(spark, moments, limits):
    rng = random.Random(len(moments))
    versions = [(m, f"k{n}", f"a{m}-{n}") for m in moments for n in range(6) if rng.random() < 0.8 or n == 0]
    edges = [m + d for m in moments for d in (-1, 0, 1)]
    rows = [(n, rng.choice([*edges, 5_000, -5_000]), f"k{rng.choice([0, 0, 0, 1, 2, 7])}") for n in range(200)] + [(900, None, "k0"), (901, moments[0], None)]
    table = spark.createDataFrame(versions, "version long, k string, area string")
    found = as_of_lookup(spark.createDataFrame(rows, "n int, at long, k string"), table, "k", "at", **limits)
    assert set(found.columns) == {"n", "at", "k", "area"}
    assert {r["n"]: r["area"] for r in found.collect()} == {n: by_hand(versions, at, k) for n, at, k in rows}


def test_no_version(spark):
    empty = spark.createDataFrame([], "version long, k string, area string")
    rows = spark.createDataFrame([(1, "k0")], "at long, k string")
    assert [r["area"] for r in as_of_lookup(rows, empty, "k", "at").collect()] == [None]


def test_blocks_are_as_many_as_versions(spark):
    moments = [0, 3, 50, 51, 52, 99, 100]
    table, first, last, width = version_blocks(spark.createDataFrame([(m,) for m in moments], "version long"))
    assert (first, last, width) == (0, 100, 15)
    held = {r["block"]: r["moments"] for r in table.collect()}
    assert held == {0: [0, 3], 1: [3], 2: [3], 3: [3, 50, 51, 52], 4: [52], 5: [52], 6: [52, 99, 100]}


def test_versions_of_area_rows(spark):
    log = spark.createDataFrame([(1, "A", "X,Y"), (1, "B", "X"), (2, "A", "Y"), (None, "A", "Z")], "version long, area string, codes string")
    assert sorted(map(tuple, invert_versions(log).collect())) == [(1, "X", "B"), (1, "Y", "A"), (2, "Y", "A")]


def test_plan_joins_by_equal_keys(spark):
    versions = spark.createDataFrame([(n, "k", "a") for n in range(9)], "version long, k string, area string")
    rows = spark.range(50).select(F.col("id").alias("at"), F.lit("k").alias("k"))
    for most in (0, 1 << 20):
        plan = as_of_lookup(rows, versions, "k", "at", most)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Cartesian|NestedLoop", plan)
