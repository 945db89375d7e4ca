"""Facts stored by user and day give the same features, without a shuffle."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from churnlake.operators.features import features_of_days, user_features
from churnlake.sources.tables import ShopTables
from churnlake.sources.user_days import open_user_days, write_user_days
from tests.conftest import REF


def ordered(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()))


def test_features_equal_those_of_the_facts(spark, small_shop, tmp_path):
    days = write_user_days(small_shop, str(tmp_path), "same_days", 4)
    assert ordered(features_of_days(days, REF)) == ordered(user_features(small_shop, REF))


def test_no_exchange_between_the_scans_and_the_wide_row(spark, small_shop, tmp_path):
    write_user_days(small_shop, str(tmp_path), "plan_days", 4)
    spark.sql("DROP TABLE plan_days_orders")        # as in a session that did not write it
    days = open_user_days(spark, str(tmp_path), "plan_days", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features_of_days(days, REF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4
    assert plan.count("SelectedBucketsCount: 4 out of 4") == 5


def test_a_dominant_user_is_a_row_per_day(spark, small_shop, tmp_path):
    many = spark.range(5000).select(
        F.col("id").alias("login_id"), F.lit(1).cast("bigint").alias("user_id"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2025-06-01")
                        .cast("timestamp_ntz")).alias("login_at"))
    shop = ShopTables(**(small_shop.__dict__ | {"user_logins": many, "order_items": None}))
    days = write_user_days(shop, str(tmp_path), "hot_days", 4)
    assert days.logins.count() == 4 and days.bought.count() == 0
    assert ordered(features_of_days(days, REF)) == ordered(user_features(shop, REF))


def test_another_number_of_buckets_is_refused(spark, small_shop, tmp_path):
    write_user_days(small_shop, str(tmp_path), "four_days", 4)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        open_user_days(spark, str(tmp_path), "other_days", 8)
