"""Joins with dominant keys give what the plain join gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlake.operators import joins


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share key 7; one in fifty has none; keys over 900 are unknown."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(
        (F.col("id") * 37) % 1000
    )
    return spark.range(6000).select(F.col("id").alias("row_id"), key.cast("bigint").alias("k"))


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(900).select(F.col("id").alias("k"), (F.col("id") % 5).alias("c"))


def test_dominant_key_is_found(facts):
    assert joins.frequent_keys(facts, "k") == [7]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_lookup_equals_plain_join(facts, table, how):
    right = table if how == "left" else table.select("k")
    got = joins.lookup(facts, right, "k", how)
    expected = facts.join(right, "k", how)
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)


def test_dominant_rows_skip_the_shuffle(spark, facts, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.lookup(facts, table, "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_text_keys_take_the_plain_join(facts):
    assert joins.frequent_keys(facts.withColumn("k", F.col("k").cast("string")), "k") == []
