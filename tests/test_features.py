"""Labels, features and snapshots on hand-made users at the boundaries."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.operators import activity as A
from churnlake.operators import cleaning as C
from churnlake.operators import cox
from churnlake.operators import snapshot as N
from churnlake.operators.features import user_features
from churnlake.sources import tables as IO
from tests.conftest import REF, at


def by_user(df, *columns):
    return {r["user_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_reference_date_is_the_latest_event(small_shop):
    assert A.reference_date(small_shop) == REF


def test_reference_date_skips_empty_tables(small_shop):
    empty = replace(small_shop, user_logins=small_shop.user_logins.where("false"))
    assert A.reference_date(empty) == at("2025-06-29 13:00:00")


def test_churn_boundary_is_strict(small_shop):
    rows = by_user(user_features(small_shop, REF), "churn", "recency_days")
    assert rows[2] == (0, 90)          # exactly on the threshold
    assert rows[3] == (1, 90)          # a microsecond earlier
    assert rows[4] == (1, 10089)       # never bought
    assert rows[1] == (0, 0)           # 23 hours are no whole day


def test_user_features(small_shop):
    rows = by_user(
        user_features(small_shop, REF), "order_count", "total_spend", "avg_order_value",
        "avg_days_between_orders", "used_coupon", "login_count", "cart_count",
        "avg_cart_per_login", "category_diversity", "age", "age_group",
    )
    # gaps 2 (17th 11:00 to 20th 09:00), 0 (same day) and 9 (20th 10:00 to 29th 13:00)
    assert rows[1] == (4, 100.0, 25.0, pytest.approx(11 / 3), True, 1, 0, 0.0, 2, 25, "25-34")
    assert rows[2] == (1, 5.0, 5.0, None, False, 0, 0, 0.0, 0, 35, "35-44")
    assert rows[4] == (0, 0.0, 0.0, None, False, 2, 1, 0.5, 0, 24, "<25")
    assert rows[5][:3] == (0, 0.0, 0.0)


def test_cancelled_orders_count_unless_excluded(small_shop):
    rows = by_user(user_features(small_shop, REF, exclude_status=["CANCELLED"]), "order_count")
    assert rows[1] == (3,)


def test_without_products_diversity_is_zero(small_shop):
    rows = by_user(user_features(replace(small_shop, products=None), REF), "category_diversity")
    assert set(rows.values()) == {(0,)}


def test_extra_user_columns_are_kept(small_shop):
    users = small_shop.users.withColumn("signup_source", F.lit("ads"))
    rows = user_features(replace(small_shop, users=users), REF, keep=["gender", "signup_source"])
    assert {"signup_source", "gender"} <= set(rows.columns) and "age" not in rows.columns


def test_previous_order_breaks_ties_by_id(spark):
    orders = spark.createDataFrame(
        [(2, 1, "2025-01-01 10:00:00"), (1, 1, "2025-01-01 10:00:00"),
         (3, 1, "2025-01-03 09:00:00"), (4, 2, "2025-01-03 09:00:00")],
        "order_id BIGINT, user_id BIGINT, order_date STRING",
    ).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    rows = {r["order_id"]: (r["prev_order_date"], r["days_between"])
            for r in A.previous_order(orders).collect()}
    same = at("2025-01-01 10:00:00")
    assert rows == {1: (None, None), 2: (same, 0), 3: (same, 1), 4: (None, None)}


def test_snapshot_uses_history_only_and_labels_the_future(small_shop):
    ref = at("2025-04-01 12:00:00")
    rows = by_user(N.snapshot(small_shop, ref), *S.SNAPSHOT_COLUMNS[4:])
    assert rows[1][0] == 0 and rows[1][-1] == 0      # no history, buys later
    assert rows[2][0] == 1 and rows[2][-1] == 1      # an order at ref is history, not future
    assert set(rows) == {1, 2, 3, 4, 5}              # user 5 joins after ref and stays
    existing = by_user(N.snapshot(small_shop, ref, only_existing=True), "user_id")
    assert set(existing) == {1, 2, 3, 4}


def test_snapshot_columns_and_cohort(small_shop):
    rows = N.snapshot(small_shop, REF)
    assert tuple(rows.columns) == S.SNAPSHOT_COLUMNS
    # 1: MALE 25; 3: male 39; 4: M 24; 2 is female, 5 has no gender
    assert {r["user_id"] for r in N.cohort(rows).collect()} == {1, 3, 4}


def test_several_refs_equal_one_at_a_time(small_shop):
    refs = [at("2025-06-20 09:30:00"), at("2025-04-01 12:00:00"), REF]
    both = N.snapshots(small_shop, refs).collect()
    single = [r for ref in refs for r in N.snapshot(small_shop, ref).collect()]
    assert sorted(both, key=str) == sorted(single, key=str)


def test_future_label_equals_snapshot_label(small_shop):
    ref = at("2025-04-01 12:00:00")
    alone = by_user(N.future_label(small_shop.users, small_shop.orders, ref), "churn_90d")
    assert alone == by_user(N.snapshot(small_shop, ref), "churn_90d")


def test_inactivity_equals_future_label_at_the_threshold(small_shop):
    """Both labels agree unless a last order falls exactly on the threshold (user 2)."""
    inactive = by_user(user_features(small_shop, REF), "churn")
    future = by_user(N.snapshot(small_shop, REF - timedelta(days=90)), "churn_90d")
    assert {u for u in inactive if inactive[u] != future[u]} == {2}


def test_training_features(small_shop):
    rows = by_user(N.training_features(small_shop, at("2025-06-25 00:00:00")), *S.TRAINING_COLUMNS)
    one = dict(zip(S.TRAINING_COLUMNS, rows[1]))
    assert one["frequency_last_30d"] == 3 and one["coupon_usage_rate"] == pytest.approx(1 / 3)
    assert one["avg_items_per_order"] == pytest.approx(4 / 3)
    assert one["num_interests"] == 2 and one["churn"] == 0
    assert rows[4][S.TRAINING_COLUMNS.index("days_since_last_session")] == 23
    assert rows[2][S.TRAINING_COLUMNS.index("churn")] == 1


def test_survival_times(small_shop):
    rows = by_user(
        cox.survival_times(user_features(small_shop, REF), REF), "event", "duration"
    )
    assert rows[1] == (0, 456)       # active after the threshold: censored there
    assert rows[3] == (1, 456)       # ended before the threshold
    assert rows[5] == (1, 1)         # no activity at all


def test_bands_include_the_right_edge(spark):
    ages = spark.createDataFrame([(a,) for a in (0, 24, 25, 34, 44, 45, 200, 201)], "age INT")
    bands = [r[0] for r in ages.select(E.age_band(F.col("age"))).collect()]
    assert bands == ["<25", "<25", "25-34", "25-34", "35-44", "45+", "45+", None]
    sums = spark.createDataFrame([(s,) for s in (2, 3, 5, 6, 15, 16)], "s INT")
    assert [r[0] for r in sums.select(E.rfm_bucket(F.col("s"))).collect()] == [
        None, "Low(3-5)", "Low(3-5)", "Mid-Low(6-8)", "High(12-15)", None
    ]


def test_number_and_gender_cleaning(spark):
    rows = spark.createDataFrame(
        [(1, "1.5", " male\n"), (2, "x", "M"), (3, "inf", None), (4, "NaN", "MALE"),
         (5, None, "Female")], "id INT, v STRING, gender STRING",
    )
    out = C.clear_odd_numbers(C.coerce_numbers(rows, ["v"]), ["v"]).withColumn(
        "g", E.gender_bin(F.col("gender"))
    )
    assert [(r["v"], r["g"]) for r in out.orderBy("id").collect()] == [
        (1.5, 1), (0.0, 0), (0.0, 0), (0.0, 1), (0.0, 0)
    ]


def test_items_and_totals(small_shop):
    tables = small_shop
    assert C.valid_items(tables.order_items, tables.orders).count() == 4
    assert [r["order_id"] for r in C.orphan_items(tables.order_items, tables.orders).collect()] == [99]
    totals = {r["order_id"]: (r["items_total"], r["difference"])
              for r in C.order_totals(tables.orders, tables.order_items).collect()}
    assert totals[10] == (10.0, 0.0) and totals[12] == (30.0, 0.0) and totals[13] == (None, None)


def test_csv_with_byte_order_mark_and_extra_column(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_bytes(
        "﻿order_id,user_id,order_date,note,total_amount,status,used_coupon_code\n"
        "1,7,2025-01-02 03:04:05,a,1.25,PAID,\n2,8,2025-01-02 03:04:05.678901,b,2,PAID,X\n"
        .encode()
    )
    rows = IO.read_table(spark, str(path), "orders").orderBy("order_id").collect()
    assert rows[0]["order_id"] == 1 and rows[0]["used_coupon_code"] is None
    assert rows[0]["order_date"] == at("2025-01-02 03:04:05")
    assert rows[1]["order_date"] == at("2025-01-02 03:04:05.678901")
    assert rows[1]["total_amount"] == 2.0


def test_read_tables_with_missing_optional_ones(spark, tmp_path, small_shop):
    for name in S.REQUIRED_TABLES:
        IO.write_table(small_shop.present()[name], f"{tmp_path}/{name}.csv", "csv")
    tables = IO.read_tables(spark, str(tmp_path))
    assert tables.products is None and "products" not in tables.present()
    assert IO.or_empty(spark, tables.products, "products").count() == 0
    again = by_user(user_features(tables, REF), "order_count", "churn", "recency_days")
    assert again == by_user(user_features(small_shop, REF), "order_count", "churn", "recency_days")


def test_missing_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="tenure_days"):
        IO.require_columns(spark.createDataFrame([(1,)], "user_id INT"), S.TRAINING_COLUMNS)
