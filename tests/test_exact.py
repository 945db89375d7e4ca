"""Sums and means that are the same bits whatever the order and partitioning."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlake.functions.exact import exact_avg, exact_sum, limb_sums, refolded
from churnlake.operators.activity import order_profile
from churnlake.operators.evaluate import brier, reliability
from churnlake.operators.explore import describe
from tests.conftest import TESTDATA


def nearest(values) -> float:
    """The double nearest to the exact sum."""
    total = sum((Fraction(v) for v in values), Fraction(0))
    return total.numerator / total.denominator


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e15, 1e15).filter(lambda v: v == 0 or abs(v) > 1e-3), min_size=1,
                max_size=60))
def test_sum_is_rounded_once(spark, values):
    row = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(3).agg(
        exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("m")).first()
    assert row["s"] == nearest(values) == math.fsum(values)
    assert row["m"] == nearest(values) / len(values)


def test_sum_of_nothing_of_large_and_of_odd_values(spark):
    frame = spark.createDataFrame([
        ("none", None), ("some", None), ("some", 0.1), ("some", 0.2), ("large", 1e300),
        ("large", 1.0), ("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 2.0),
        ("cancel", 1e22), ("cancel", 0.25), ("cancel", -1e22), ("tiny", 1e-30), ("minus", -0.75),
        ("minus", -1e-3)], "g STRING, x DOUBLE")
    got = {r["g"]: r["s"] for r in frame.groupBy("g").agg(exact_sum(F.col("x")).alias("s")).collect()}
    assert got["none"] is None and got["some"] == nearest([0.1, 0.2])
    assert got["large"] == 1e300 and math.isnan(got["nan"]) and got["inf"] == float("inf")
    assert got["cancel"] == 0.25 and got["tiny"] == 0.0 and got["minus"] == nearest([-0.75, -1e-3])


def test_folding_twice_changes_nothing(spark):
    values = np.random.default_rng(1).normal(0, 1e4, 3000).round(2).tolist()
    frame = spark.createDataFrame([(i % 37, v) for i, v in enumerate(values)], "k INT, x DOUBLE")
    days = frame.groupBy("k").agg(*limb_sums(F.col("x"), "x"))
    assert days.agg(refolded("x")).first()[0] == nearest(values)
    even = [v for i, v in enumerate(values) if i % 37 % 2 == 0]
    assert days.agg(refolded("x", F.col("k") % 2 == 0)).first()[0] == nearest(even)


@pytest.fixture(scope="module")
def scores(spark):
    rows = spark.read.parquet(f"{TESTDATA}/orders.parquet")
    label = F.when(F.col("o_totalprice") > 250000, 1).otherwise(0)
    return rows.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
                       F.col("o_totalprice").alias("total_amount"), label.alias("label"),
                       (((F.col("o_orderkey") * 7919) % 1000 + 600 * label) / 1600.0).alias("score"),
                       F.col("o_orderdate").alias("order_date"),
                       F.col("o_orderkey").alias("order_id"),
                       F.lit(None).cast("string").alias("used_coupon_code"))


def test_same_bits_under_any_partitioning(spark, scores):
    def results(n):
        rows = scores.repartition(n, F.rand(n))
        return [sorted(map(tuple, f.collect()), key=repr) for f in (
            reliability(rows), brier(rows), describe(rows, ["total_amount", "score"]).select(
                "variable", "count", "mean"),
            order_profile(rows).select("user_id", "total_spend", "avg_order_value"))]

    first = results(1)
    assert all(results(n) == first for n in (3, 8, 17, 40))
    values = [r[0] for r in scores.select("total_amount").collect()]
    assert dict((r[0], r[2]) for r in first[2])["total_amount"] == nearest(values) / len(values)


def test_reliability_keeps_empty_bins_and_leaves_one_out(spark):
    rows = spark.createDataFrame([("a", 0.05, 1), ("a", 0.05, 0), ("a", 1.0, 1), ("b", 1.0, 0),
                                  ("b", None, 0)], "m STRING, score DOUBLE, label INT")
    got = {(r["m"], r["bin"]): r for r in reliability(rows, 10, ["m"]).collect()}
    assert len(got) == 20 and got["a", 0]["n"] == 2 and got["a", 0]["positive_share"] == 0.5
    assert all(r["n"] == 0 and r["mean_score"] is None for k, r in got.items() if k != ("a", 0))
