"""What the physical plans must and must not hold."""

import json
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.audit import good_rows, parse_audit
from tidemark.operators.lateness import classify_lateness, window_turns
from tidemark.operators.windows import sorted_event_times, window_counts
from tidemark.plans import tables
from tidemark.plans.clean import clean_messages

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def audit(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("audit"))
    value = F.lit('{"dt":"2024-01-01 00:00:05","type":"t","username":"u","area":"a"}')
    spark.range(50).select(value.alias("value"), F.col("id").alias("arrival"), F.col("id").alias("unused")).write.parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/t")


def test_clean_has_no_shuffle(spark, audit):
    dim = spark.createDataFrame([("NL", "A")], "country_code string, area string")
    for fields in ("type string", None):
        plan = plan_of(clean_messages(audit, dim, "other", fields).json)
        assert "BroadcastHashJoin" in plan
        assert not re.search(r"(?<!Broadcast)Exchange (hash|range|Single|RoundRobin)", plan)
        assert plan.count("from_json(ArrayType(StructType(StructField(dt") == 1
        assert not any(name in plan for name in PYTHON)
        assert "unused" not in plan


def test_item_text_is_parsed_once(spark, audit):
    dim = spark.createDataFrame([("NL", "A")], "country_code string, area string")
    assert plan_of(clean_messages(audit, dim).json).count("from_json(MapType") == 1


def test_typed_items_are_read_with_their_envelope(spark, audit):
    dim = spark.createDataFrame([("NL", "A")], "country_code string, area string")
    plan = plan_of(clean_messages(audit, dim, "other", "type string").json)
    assert plan.count("from_json(StructField(tidemark_texts,ArrayType(StructType(StructField(dt") == 1


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_lists_of_items_are_shuffled_once(spark):
    plan = plan_of(tables.order_messages(spark, FOLDER))
    assert "ObjectHashAggregate" in plan
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey[^\n]*\n[^\n]*ObjectHashAggregate", plan)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_large_orders_become_several_envelopes(spark, monkeypatch):
    def found():
        envelopes = [json.loads(row["value"]) for row in tables.order_messages(spark, FOLDER).select("value").collect()]
        items = Counter((e["dt"], e["countryCode"], str(item)) for e in envelopes for item in e["data"])
        return items, Counter((e["dt"], e["countryCode"]) for e in envelopes if not e["data"]), len(envelopes)

    items, empty, n = found()
    monkeypatch.setattr(tables, "ITEMS_PER_ENVELOPE", 3)
    dealt = found()
    assert dealt[:2] == (items, empty) and dealt[2] > n


def test_report_has_one_shuffle_and_counts_before_it(audit):
    plan = plan_of(window_counts(good_rows(parse_audit(audit))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
    assert plan.count("from_json") == 1 and plan.count("gettimestamp") == 1
    assert "unused" not in plan and "arrival" not in plan


def test_classifying_does_not_shuffle_the_rows(audit):
    plan = plan_of(classify_lateness(good_rows(parse_audit(audit))))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_turns_shrink_before_any_shuffle(audit):
    plan = plan_of(window_turns(good_rows(parse_audit(audit))))
    assert "partial_min" in plan and "SortAggregate" not in plan
    # Of all windows, only the one over the block minima is unpartitioned.
    assert plan.count("SinglePartition") == 1


def test_event_times_are_counted_not_collected(audit):
    assert "collect_list" not in plan_of(sorted_event_times(good_rows(parse_audit(audit))))
