"""Merged daily sketches agree with one pass and stay within their stated errors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlake.operators.sketches import daily_sketches, merged_sketches, sketch_summary
from churnlake.sources.tables import read_partitions, write_partitions

ROWS = 60_000


@pytest.fixture(scope="module")
def sales(spark):
    return spark.range(ROWS).select(
        F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("team"),
        (F.col("id") * 7919 % 20_011).alias("user"),
        (F.col("id") * 104_729 % ROWS).alias("amount"),
        F.timestamp_add("HOUR", (F.col("id") % 480).cast("int"),
                        F.lit("2025-01-01").cast("timestamp_ntz")).alias("at"))


def test_merge_equals_one_pass_for_counts_and_keeps_error_bounds(sales):
    days = daily_sketches(sales, "at", ["team"], ["user"], ["amount"])
    assert days.count() == 40
    got = sketch_summary(merged_sketches(days)).first()
    whole = sketch_summary(
        daily_sketches(sales.withColumn("at", F.lit("2025-01-01")), "at", (), ["user"])).first()
    assert got["n"] == ROWS
    assert got["user_distinct"] == pytest.approx(whole["user_distinct"], rel=0.05)
    assert got["user_distinct"] == pytest.approx(20_011, rel=0.05)
    assert list(got["amount_quantiles"]) == pytest.approx(
        [ROWS * p for p in (0.25, 0.5, 0.75)], abs=0.03 * ROWS)


def test_a_day_that_runs_again_replaces_itself(spark, sales, tmp_path):
    path = str(tmp_path / "sketches")
    days = daily_sketches(sales, "at", ["team"], ["user"], ["amount"])
    write_partitions(days, path, ["day"])
    write_partitions(days.where("day = DATE '2025-01-03'"), path, ["day"])
    back = read_partitions(spark, path, days.schema)
    by_team = {r["team"]: r for r in sketch_summary(merged_sketches(back, ["team"])).collect()}
    assert by_team["a"]["n"] == ROWS * 2 // 3 and by_team["b"]["n"] == ROWS // 3


def test_small_groups_are_exact_and_nulls_are_in_no_sketch(spark):
    rows = spark.createDataFrame(
        [("x", 1, 5.0), ("x", 1, 7.0), ("x", 2, None), ("y", None, None)],
        "team STRING, user INT, amount DOUBLE").withColumn("at", F.lit("2025-01-01"))
    days = daily_sketches(rows, "at", ["team"], ["user"], ["amount"])
    got = {r["team"]: r for r in sketch_summary(merged_sketches(days, ["team"]), [0.5, 1.0]).collect()}
    assert (got["x"]["n"], got["x"]["user_distinct"]) == (3, 2)
    assert list(got["x"]["amount_quantiles"]) == [5.0, 7.0]
    assert (got["y"]["user_distinct"], got["y"]["amount_quantiles"]) == (0, None)
    empty = daily_sketches(rows.limit(0), "at", ["team"], ["user"], ["amount"])
    assert sketch_summary(merged_sketches(empty, ["team"])).count() == 0
