import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.scans import minimum_from_here_up, running_total


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_minimum_from_here_up(spark, block):
    rng = random.Random(block)
    rows = [(rng.randint(-60, 60), rng.choice([None, rng.randint(0, 99)]), rng.randint(0, 99)) for _ in range(150)]
    df = spark.createDataFrame(rows, "p bigint, a bigint, b bigint")
    got = minimum_from_here_up(df, "p", ["a", "b"], [F.count("*").alias("n")], block=block)

    def least(position, column):
        return min((row[column] for row in rows if row[0] >= position and row[column] is not None), default=None)

    places = {row[0] for row in rows}
    expected = {(p, least(p, 1), least(p, 2), sum(row[0] == p for row in rows)) for p in places}
    assert {(row["p"], row["a"], row["b"], row["n"]) for row in got.collect()} == expected


def test_running_total_with_a_hot_group(spark):
    rng = random.Random(0)
    rows = [("hot" if rng.random() < 0.7 else f"g{rng.randrange(20)}", rng.choice([None, rng.randint(0, 900)]), 1) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, at bigint, n bigint")
    got = running_total(df, ["g"], "at", "n").collect()

    expected = {}
    for group in {row[0] for row in rows}:
        total = 0
        orders = [row[1] for row in rows if row[0] == group]
        for order in sorted(set(orders), key=lambda x: (x is not None, x)):
            total += orders.count(order)
            expected[group, order] = total
    assert len(got) == len(expected)
    assert {(row["g"], row["at"]): row["n"] for row in got} == expected


def test_hot_group_is_spread_over_tasks(spark, monkeypatch):
    from tidemark.operators import scans

    kept = []
    written = scans.written
    monkeypatch.setattr(scans, "written", lambda df, name: kept.append(written(df, name)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("'hot' AS g", "id AS at", "1 AS n")
        assert running_total(df, ["g"], "at", "n").agg(F.max("n")).first()[0] == 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["count"] for row in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000
