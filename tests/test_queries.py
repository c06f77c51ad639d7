"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


#: Those of the library itself; the training-data queries have tests of their own.
NAMES = sorted(ORACLES)


def test_every_query_has_sql():
    assert set(NAMES) <= set(spark_entry.queries())
    rest = set(spark_entry.queries()) - set(NAMES)
    assert all(name.startswith("op") or name == "pipeline" for name in rest)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    expected = sql.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({spark_entry.oracle_sql()[name]})").fetchall()
    assert expected
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, expected))


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
