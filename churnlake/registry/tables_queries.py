"""Queries for scans, sinks, cleaning (S), projections and predicates (P) and joins (J)."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.operators import activity as A
from churnlake.operators import cleaning as C
from churnlake.operators import cox
from churnlake.operators import explore as X
from churnlake.operators import mlprep as M
from churnlake.operators import snapshot as N
from churnlake.operators.features import (
    ZERO_FILL, features_of_days, user_features, wide_assembly,
)
from churnlake.registry import star_tables as T
from churnlake.registry.base import b, longs, query, r6, rounded
from churnlake.registry.star_tables import HORIZON_DAYS as H
from churnlake.session import shared_folder, stage
from churnlake.sources import tables as IO
from churnlake.sources.user_days import write_user_days


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- S: scans, sinks, cleaning ------------------------------------------------------


@query("s1_csv_scan", """
SELECT order_id, user_id, order_date, round(total_amount, 2) AS total_amount, status,
       used_coupon_code FROM s_orders""")
def s1_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "orders-csv")
    IO.write_table(T.shop(spark, folder).orders, path, "csv")
    rows = IO.read_table(spark, path, "orders", "csv")
    return rounded(rows, ["total_amount"], 2)


@query("s2_optional_table", """
SELECT user_id, order_count, CAST(0 AS BIGINT) AS category_diversity FROM s_features""")
def s2_optional_table(spark: SparkSession, folder: str) -> DataFrame:
    absent = IO.read_optional(spark, f"{folder}/no_such_products.parquet", "products", "parquet")
    base = T.shop(spark, folder)
    tables = IO.ShopTables(base.users, base.orders, base.user_logins, base.cart_items,
                           base.order_items, products=absent)
    ref = A.reference_date(tables)
    return user_features(tables, ref, horizon_days=H).select(
        "user_id", "order_count", "category_diversity"
    )


@query("s3_required_columns", "SELECT count(*) AS n, CAST(17 AS BIGINT) AS n_columns FROM customer")
def s3_required_columns(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    ref = A.reference_date(tables) - timedelta(days=H)
    path = scratch(spark, "churn-features")
    IO.write_table(N.training_features(tables, ref, H), path)
    rows = IO.read_features(spark, path)
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "n_columns", F.lit(len(rows.columns)).cast("bigint")
    )


@query("s4_partition_rewrite", """
SELECT snapshot_ref_date, count(*) AS n, CAST(sum(order_count) AS BIGINT) AS orders_seen
FROM s_snapshots
WHERE order_count > 0 OR snapshot_ref_date = (SELECT min(snapshot_ref_date) FROM s_snapshots)
GROUP BY snapshot_ref_date""")
def s4_partition_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Two dates are written, the later one again without users who never bought."""
    tables = T.shop(spark, folder)
    latest = A.reference_date(tables)
    path = scratch(spark, "snapshots")
    refs = [latest - timedelta(days=2 * H), latest - timedelta(days=H)]
    made = N.snapshots(tables, refs, H)
    IO.write_partitions(made, path, ["snapshot_ref_date"])
    again = IO.read_partitions(spark, path, made.schema).filter(
        (F.col("snapshot_ref_date") == F.lit(refs[1])) & (F.col("order_count") > 0))
    IO.write_partitions(stage(again, "snapshot-again"), path, ["snapshot_ref_date"])
    return IO.read_partitions(spark, path, made.schema).groupBy("snapshot_ref_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_count").alias("orders_seen"))


@query("s4_partitioned_sink", f"""
SELECT snapshot_ref_date, count(*) AS n, CAST(sum(churn_90d) AS BIGINT) AS churned,
       CAST(sum(order_count) AS BIGINT) AS orders_seen
FROM s_snapshots GROUP BY snapshot_ref_date""")
def s4_partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    latest = A.reference_date(tables)
    path = scratch(spark, "snapshots")
    refs = [latest - timedelta(days=2 * H), latest - timedelta(days=H)]
    IO.write_table(N.snapshots(tables, refs, H), path, partition_by=["snapshot_ref_date"])
    return spark.read.parquet(path).groupBy(
        F.col("snapshot_ref_date").cast("timestamp_ntz").alias("snapshot_ref_date")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("churn_90d").alias("churned"),
        F.sum("order_count").alias("orders_seen"),
    )


@query("s5_numeric_coercion", """
SELECT o_orderkey AS order_id, TRY_CAST(
         CASE o_orderstatus WHEN 'F' THEN concat(o_orderkey, '.25')
                            WHEN 'O' THEN o_orderpriority END AS DOUBLE) AS amount
FROM orders""")
def s5_numeric_coercion(spark: SparkSession, folder: str) -> DataFrame:
    texts = T.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CASE o_orderstatus WHEN 'F' THEN concat(o_orderkey, '.25') "
        "WHEN 'O' THEN o_orderpriority END AS amount",
    )
    return C.coerce_numbers(texts, ["amount"])


@query("s6_odd_numbers", """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END AS amount
FROM orders""")
def s6_odd_numbers(spark: SparkSession, folder: str) -> DataFrame:
    odd = T.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CASE WHEN o_orderstatus = 'F' THEN o_totalprice "
        "WHEN o_orderpriority = '1-URGENT' THEN double('Infinity') "
        "WHEN o_orderpriority = '2-HIGH' THEN double('-Infinity') "
        "WHEN o_orderpriority = '5-LOW' THEN double('NaN') END AS amount",
    )
    return C.clear_odd_numbers(odd, ["amount"])


@query("s7_gender_flag", """
SELECT c_custkey AS user_id, CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
       THEN 1 ELSE 0 END AS INT) AS gender_bin FROM customer""")
def s7_gender_flag(spark: SparkSession, folder: str) -> DataFrame:
    people = T.table(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id",
        r"CASE c_mktsegment WHEN 'BUILDING' THEN ' male\n' WHEN 'MACHINERY' THEN 'MALE' "
        r"WHEN 'FURNITURE' THEN '\tMale ' WHEN 'AUTOMOBILE' THEN 'M' END AS gender",
    )
    return people.select("user_id", E.gender_bin(F.col("gender")).alias("gender_bin"))


@query("s8_table_shapes", """
SELECT 'users' AS table_name, count(*) AS n_rows, CAST(4 AS INT) AS n_columns FROM s_users
UNION ALL SELECT 'orders', count(*), 6 FROM s_orders
UNION ALL SELECT 'order_items', count(*), 5 FROM s_items
UNION ALL SELECT 'products', count(*), 4 FROM part
UNION ALL SELECT 'categories', count(*), 3 FROM s_categories
UNION ALL SELECT 'user_logins', count(*), 3 FROM s_logins
UNION ALL SELECT 'cart_items', count(*), 4 FROM s_carts
UNION ALL SELECT 'user_interests', count(*), 2 FROM s_interests""")
def s8_table_shapes(spark: SparkSession, folder: str) -> DataFrame:
    return X.table_shapes(T.shop(spark, folder))


@query("s9_valid_items", """
SELECT order_id, order_item_id, product_id, quantity, round(price_per_item, 8) AS price_per_item
FROM s_items
WHERE order_id IN (SELECT order_id FROM s_orders WHERE status <> 'P')""")
def s9_valid_items(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    kept_orders = tables.orders.where("status <> 'P'")
    return rounded(C.valid_items(tables.order_items, kept_orders), ["price_per_item"], 8)


@query("s9_orphan_items", """
SELECT order_id, count(*) AS n FROM s_items
WHERE order_id NOT IN (SELECT order_id FROM s_orders WHERE status <> 'P') GROUP BY order_id""")
def s9_orphan_items(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    kept_orders = tables.orders.where("status <> 'P'")
    return C.orphan_items(tables.order_items, kept_orders).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("s10_order_totals", """
SELECT order_id, round(total_amount, 4) AS total_amount, round(items_total, 4) AS items_total,
       round(total_amount - items_total, 4) AS difference
FROM s_orders LEFT JOIN (SELECT order_id, sum(quantity * price_per_item) AS items_total
                         FROM s_items GROUP BY order_id) USING (order_id)""")
def s10_order_totals(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    totals = C.order_totals(tables.orders, tables.order_items)
    return rounded(totals, ["total_amount", "items_total", "difference"], 4)


@query("s11_leaf_categories", """
SELECT c.category_id, c.category_name, CAST(c.parent_id AS BIGINT) AS parent_id,
       p.category_name AS parent_name
FROM s_categories c LEFT JOIN s_categories p ON c.parent_id = p.category_id
WHERE c.parent_id IS NOT NULL""")
def s11_leaf_categories(spark: SparkSession, folder: str) -> DataFrame:
    return C.leaf_categories(T.shop(spark, folder).categories)


# --- P: projections, filters, predicates --------------------------------------------


@query("p1_projection", "SELECT order_id, user_id, order_date AS last_order FROM s_orders")
def p1_projection(spark: SparkSession, folder: str) -> DataFrame:
    orders = T.shop(spark, folder).orders
    return orders.select("order_id", "user_id", F.col("order_date").alias("last_order"))


@query("p2_null_fill", f"""
SELECT user_id, coalesce(order_count, 0) AS order_count,
       coalesce(total_spend, 0.0) AS total_spend,
       round(avg_days_between_orders, 6) AS avg_days_between_orders,
       coalesce(login_count, 0) AS login_count, coalesce(used_coupon, FALSE) AS used_coupon
FROM s_users LEFT JOIN s_profile USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS login_count FROM s_logins GROUP BY user_id)
  USING (user_id)""")
def p2_null_fill(spark: SparkSession, folder: str) -> DataFrame:
    filled = wide_assembly(T.shop(spark, folder)).na.fill(ZERO_FILL)
    return rounded(filled, ["avg_days_between_orders"]).select(
        "user_id", "order_count", "total_spend", "avg_days_between_orders", "login_count",
        "used_coupon",
    )


@query("p3_inactivity_label", "SELECT user_id, last_purchase_date, churn FROM s_features")
def p3_inactivity_label(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    threshold = A.reference_date(tables) - timedelta(days=H)
    return (
        tables.users.select("user_id").join(A.last_purchase(tables.orders), "user_id", "left")
        .withColumn("churn", E.inactive(F.col("last_purchase_date"), threshold))
    )


@query("p3_inactivity_label_events", "SELECT user_id, churn FROM e_features")
def p3_inactivity_label_events(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    threshold = A.reference_date(tables) - timedelta(days=T.EVENT_HORIZON_DAYS)
    return (
        tables.users.select("user_id").join(A.last_purchase(tables.orders), "user_id", "left")
        .select("user_id", E.inactive(F.col("last_purchase_date"), threshold).alias("churn"))
    )


@query("p4_safe_ratio", "SELECT user_id, round(avg_cart_per_login, 6) AS avg_cart_per_login "
                        "FROM s_features")
def p4_safe_ratio(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    counts = (
        tables.users.select("user_id")
        .join(A.event_counts(tables.user_logins, "login_count"), "user_id", "left")
        .join(A.event_counts(tables.cart_items, "cart_count"), "user_id", "left")
        .na.fill(0, ["login_count", "cart_count"])
    )
    ratio = E.ratio_or_zero(F.col("cart_count"), F.col("login_count"))
    return counts.select("user_id", F.round(ratio, 6).alias("avg_cart_per_login"))


@query("p5_age_bands", "SELECT user_id, age_group FROM s_features")
def p5_age_bands(spark: SparkSession, folder: str) -> DataFrame:
    age = E.age_in(F.col("birthdate"), T.shop_ref(spark, folder).year)
    return T.shop(spark, folder).users.select("user_id", E.age_band(age).alias("age_group"))


@query("p6_age", "SELECT user_id, CAST(age AS INT) AS age FROM s_features")
def p6_age(spark: SparkSession, folder: str) -> DataFrame:
    year = T.shop_ref(spark, folder).year
    return T.shop(spark, folder).users.select(
        "user_id", E.age_in(F.col("birthdate"), year).alias("age")
    )


def _recency(tables: IO.ShopTables, horizon: int) -> DataFrame:
    ref = A.reference_date(tables)
    return (
        tables.users.select("user_id").join(A.last_purchase(tables.orders), "user_id", "left")
        .select("user_id", E.recency_days(F.col("last_purchase_date"), ref, horizon)
                .alias("recency_days"))
    )


@query("p7_recency_days", "SELECT user_id, CAST(recency_days AS BIGINT) AS recency_days "
                          "FROM s_features")
def p7_recency_days(spark: SparkSession, folder: str) -> DataFrame:
    return _recency(T.shop(spark, folder), H)


@query("p7_recency_days_events", "SELECT user_id, CAST(recency_days AS BIGINT) AS recency_days "
                                 "FROM e_features")
def p7_recency_days_events(spark: SparkSession, folder: str) -> DataFrame:
    return _recency(T.event_shop(spark, folder), T.EVENT_HORIZON_DAYS)


@query("p8_cohort_flag", """
SELECT user_id, CAST(CASE WHEN gender IN ('MALE', 'male', 'Male', 'M', 'm')
       AND age BETWEEN 20 AND 39 THEN 1 ELSE 0 END AS INT) AS is_male_20s30s,
       (age BETWEEN 20 AND 34) AND gender = 'MALE' AS in_model_cohort
FROM s_features""")
def p8_cohort_flag(spark: SparkSession, folder: str) -> DataFrame:
    age = E.age_in(F.col("birthdate"), T.shop_ref(spark, folder).year)
    gender = F.col("gender")
    return T.shop(spark, folder).users.select(
        "user_id", E.in_snapshot_cohort(gender, age).alias("is_male_20s30s"),
        E.in_model_cohort(age, E.gender_bin(gender)).alias("in_model_cohort"),
    )


def _two_refs(tables: IO.ShopTables, horizon: int):
    latest = A.reference_date(tables)
    return [latest - timedelta(days=2 * horizon), latest - timedelta(days=horizon)]


def _plain_snapshots(df: DataFrame) -> DataFrame:
    doubles = ["total_spend", "avg_order_value", "avg_days_between_orders", "avg_cart_per_login"]
    return longs(
        rounded(df, doubles), "order_count", "login_count", "cart_count", "age", "churn_90d",
        "is_male_20s30s",
    )


SNAPSHOT_SQL = f"""
SELECT user_id, birthdate, created_at, gender, last_order, age_group, snapshot_ref_date,
       {b('order_count', 'login_count', 'cart_count', 'age', 'churn_90d', 'is_male_20s30s')},
       {r6('total_spend', 'avg_order_value', 'avg_days_between_orders', 'avg_cart_per_login')}
"""


@query("p9_cohort_filter", SNAPSHOT_SQL + "FROM s_snapshots WHERE is_male_20s30s = 1")
def p9_cohort_filter(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return _plain_snapshots(N.cohort(N.snapshots(tables, _two_refs(tables, H), H)))


@query("p10_history_filter", f"""
SELECT user_id, count(*) AS n FROM s_orders, s_clock
WHERE order_date <= ref - INTERVAL {H} DAY GROUP BY user_id""")
def p10_history_filter(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    past = N.history(tables.orders, "order_date", _two_refs(tables, H)[1])
    return A.event_counts(past, "n")


@query("p11_future_window", f"""
SELECT order_id, user_id, order_date FROM s_orders, s_clock
WHERE order_date > ref - INTERVAL {2 * H} DAY AND order_date <= ref - INTERVAL {H} DAY""")
def p11_future_window(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    rows = N.future(tables.orders, "order_date", _two_refs(tables, H)[0], H)
    return rows.select("order_id", "user_id", "order_date")


@query("p12_drop_missing", """
SELECT order_id, user_id, used_coupon_code FROM s_orders WHERE used_coupon_code IS NOT NULL""")
def p12_drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    orders = T.shop(spark, folder).orders
    return orders.select("order_id", "user_id", "used_coupon_code").na.drop(
        subset=["user_id", "used_coupon_code"]
    )


LAST = "greatest(last_purchase_date, last_login_at, last_cart_at)"


@query("p13_last_activity", f"""
SELECT user_id, {LAST} AS last_activity_at, least({LAST}, threshold) AS until
FROM s_features, s_clock""")
def p13_last_activity(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    ref = A.reference_date(tables)
    features = user_features(tables, ref, horizon_days=H)
    last = F.greatest("last_purchase_date", "last_login_at", "last_cart_at")
    return features.select(
        "user_id", last.alias("last_activity_at"),
        F.least(last, E.ts(ref - timedelta(days=H))).alias("until"),
    )


@query("p14_clipped_duration", f"""
SELECT user_id, CAST(greatest(1, coalesce(datesub('day', created_at,
         least({LAST}, threshold)), 1)) AS INT) AS duration,
       CAST(CASE WHEN {LAST} IS NULL OR {LAST} < threshold THEN 1 ELSE 0 END AS INT) AS event
FROM e_features, e_clock""")
def p14_clipped_duration(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    ref = A.reference_date(tables)
    days = T.EVENT_HORIZON_DAYS
    features = user_features(tables, ref, horizon_days=days)
    return cox.survival_times(features, ref, days).select("user_id", "duration", "event")


@query("p15_dummy_columns", """
SELECT user_id, CASE WHEN gender = 'MALE' THEN 1.0::DOUBLE ELSE 0.0 END AS gender_MALE,
       CASE WHEN age_group = '35-44' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_35-44",
       CASE WHEN age_group = '45+' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_45+",
       CASE WHEN age_group = '<25' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_<25"
FROM s_features""")
def p15_dummy_columns(spark: SparkSession, folder: str) -> DataFrame:
    features = T.shop_features(spark, folder).select("user_id", "gender", "age_group")
    known = M.levels(features, ["gender", "age_group"])
    return M.one_hot(features, known, drop="first")[0].drop("gender", "age_group")


@query("p16_constant_stamp", "SELECT user_id, snapshot_ref_date FROM s_snapshots")
def p16_constant_stamp(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    rows = N.snapshots(tables, _two_refs(tables, H), H)
    return rows.select("user_id", "snapshot_ref_date")


# --- J: joins ------------------------------------------------------------------------

FEATURE_SQL = f"""
SELECT user_id, gender, birthdate, created_at, last_purchase_date, first_order_date,
       last_login_at, last_cart_at, used_coupon, age_group,
       {b('churn', 'recency_days', 'order_count', 'login_count', 'cart_count', 'age',
          'category_diversity')},
       {r6('total_spend', 'avg_order_value', 'avg_days_between_orders', 'avg_cart_per_login')}
"""


def _plain_features(df: DataFrame) -> DataFrame:
    doubles = ["total_spend", "avg_order_value", "avg_days_between_orders", "avg_cart_per_login"]
    return longs(
        rounded(df, doubles), "churn", "recency_days", "order_count", "login_count",
        "cart_count", "age", "category_diversity",
    )


@query("j1_feature_assembly", FEATURE_SQL + "FROM s_features")
def j1_feature_assembly(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return _plain_features(user_features(tables, A.reference_date(tables), horizon_days=H))


@query("j1_feature_assembly_of_days", FEATURE_SQL + "FROM s_features")
def j1_feature_assembly_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """The features again, from facts stored by user and day in buckets of users."""
    tables = T.shop(spark, folder)
    name = f"user_days_{uuid.uuid4().hex}"
    days = write_user_days(tables, f"{shared_folder(spark)}/{name}", name, 8)
    return _plain_features(features_of_days(days, A.reference_date(tables), horizon_days=H))


@query("j1_feature_assembly_events", FEATURE_SQL + "FROM e_features")
def j1_feature_assembly_events(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    ref = A.reference_date(tables)
    return _plain_features(user_features(tables, ref, horizon_days=T.EVENT_HORIZON_DAYS))


@query("j2_chained_enrichment", """
SELECT DISTINCT order_id, category_id, user_id FROM s_items
LEFT JOIN s_orders USING (order_id) LEFT JOIN s_products USING (product_id)
WHERE category_id IS NOT NULL""")
def j2_chained_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return A.item_categories(tables.order_items, tables.products).join(
        tables.orders.select("order_id", "user_id"), "order_id", "left"
    )


@query("j3_future_label", f"""
SELECT user_id, CAST(CASE WHEN user_id IN (
         SELECT user_id FROM s_orders, s_clock WHERE order_date > ref - INTERVAL {H} DAY
         AND order_date <= ref) THEN 0 ELSE 1 END AS INT) AS churn_90d
FROM s_users""")
def j3_future_label(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return N.future_label(tables.users, tables.orders, _two_refs(tables, H)[1], H)


@query("j4_snapshot_with_label", SNAPSHOT_SQL + "FROM s_snapshots")
def j4_snapshot_with_label(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return _plain_snapshots(N.snapshots(tables, _two_refs(tables, H), H))


@query("j4_snapshot_with_label_events", SNAPSHOT_SQL + "FROM e_snapshots")
def j4_snapshot_with_label_events(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    days = T.EVENT_HORIZON_DAYS
    return _plain_snapshots(N.snapshots(tables, _two_refs(tables, days), days))


@query("j4_snapshot_existing_users",
       SNAPSHOT_SQL + "FROM e_snapshots WHERE created_at <= snapshot_ref_date")
def j4_snapshot_existing_users(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    days = T.EVENT_HORIZON_DAYS
    return _plain_snapshots(N.snapshots(tables, _two_refs(tables, days), days, True))
