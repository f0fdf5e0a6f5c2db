"""What the plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_point
from lakequeries import changes, extracts, folds
from tidemark.operators import merge

QUERIES = entry_point.queries()
# File movement is the only Python in the library.
LAZY = [n for n in QUERIES if not n.startswith(("stream_", "incremental_run"))]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_product_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in plan


def exchanges(plan: str) -> int:
    """Distinct exchanges by key; a subquery is printed wherever it is used."""
    return len(set(re.findall(r"Exchange hashpartitioning.*plan_id=(\d+)", plan)))


@pytest.mark.parametrize("name", ["scd1_fold", "scd2_fold", "fact_fold"])
def test_a_fold_shuffles_once(spark, name):
    """Six batches and the table: one exchange by key, one sort."""
    plan = plan_of(folds.QUERIES[name](spark, SF_DIR))
    assert exchanges(plan) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_a_merge_shuffles_each_side_once(spark):
    plan = plan_of(changes.scd1_upsert(spark, SF_DIR))
    assert plan.count("FullOuter") == 1
    # Both sides by key; the third is the key count that guards against repeated keys.
    assert exchanges(plan) <= 3


def test_closed_versions_bypass_the_shuffle(spark):
    plan = plan_of(changes.scd2_merge(spark, SF_DIR))
    assert exchanges(plan) == 1


def test_pruned_merge_filters_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    target = extracts.with_year(extracts.target_orders(spark, SF_DIR))
    target.write.partitionBy("o_year").parquet(path)
    source = extracts.recent(extracts.batch_orders(spark, SF_DIR))
    touched, _ = merge.split_by_partition(spark.read.parquet(path), source, ["o_year"])
    pruning = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(touched)).group(1)
    assert "o_year" in pruning
    assert {r[0] for r in touched.select("o_year").distinct().collect()} == {1999, 2000}


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["export_incremental"](spark, SF_DIR))
    assert "GreaterThan(l_shipdate" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_tax" not in read
