"""The shop tables as views over a star-schema data set (customer, orders, ...).

``shop`` maps the order history; ``event_shop`` maps the event stream, where most users
never buy and timestamps carry microseconds. Both are plain projections, so the
scans keep their column pruning and filters.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators.activity import reference_date
from churnlake.operators.features import user_features
from churnlake.operators.ranking import rfm_scores
from churnlake.session import stage
from churnlake.sources.tables import ShopTables

HORIZON_DAYS = 180
EVENT_HORIZON_DAYS = 3
LOGIN_SHIFT_DAYS = 8218      # moves the event dates onto the end of the order dates


# Columns the views read, so that a scan needs no look at the files to be planned.
STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_returnflag STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _users(customers: DataFrame, created: str) -> DataFrame:
    return customers.selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') "
        "THEN 'MALE' ELSE 'FEMALE' END AS gender",
        "make_date(cast(1941 + c_custkey % 41 AS INT), 1, 1) AS birthdate",
        f"{created} AS created_at",
    )


def shop(spark: SparkSession, folder: str) -> ShopTables:
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS user_id", "o_orderdate AS order_date",
        "o_totalprice AS total_amount", "o_orderstatus AS status",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'WELCOME10' "
        "WHEN '2-HIGH' THEN 'SUMMER25' END AS used_coupon_code",
    )
    items = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    events = table(spark, folder, "events")
    shifted = f"ts - INTERVAL '{LOGIN_SHIFT_DAYS}' DAY"
    regions = table(spark, folder, "region").selectExpr(
        "r_regionkey AS category_id", "r_name AS category_name",
        "cast(NULL AS DOUBLE) AS parent_id",
    )
    nations = table(spark, folder, "nation").selectExpr(
        "100 + n_nationkey AS category_id", "n_name AS category_name",
        "cast(n_regionkey AS DOUBLE) AS parent_id",
    )
    returned = items.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey")
    interests = (
        returned.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", F.col("p_type").alias("category_id")).distinct()
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("user_id"), "category_id").distinct()
    )
    return ShopTables(
        users=_users(
            table(spark, folder, "customer"),
            "TIMESTAMP_NTZ '1994-07-01 00:00:00' "
            "+ make_dt_interval(cast(c_custkey % 180 AS INT))",
        ),
        orders=orders,
        order_items=items.selectExpr(
            "l_orderkey * 10 + l_linenumber AS order_item_id", "l_orderkey AS order_id",
            "l_partkey AS product_id", "l_quantity AS quantity",
            "l_extendedprice / l_quantity AS price_per_item",
        ),
        products=parts.selectExpr(
            "p_partkey AS product_id", "p_type AS category_id", "p_name AS product_name",
            "p_retailprice AS price",
        ),
        categories=regions.unionByName(nations),
        user_logins=events.where("event_type = 'view'").selectExpr(
            "event_id AS login_id", "user_id", f"{shifted} AS login_at"
        ),
        cart_items=events.where("event_type = 'click'").selectExpr(
            "event_id AS cart_item_id", "user_id", "1 AS quantity", f"{shifted} AS added_at"
        ),
        user_interests=interests,
    )


def event_shop(spark: SparkSession, folder: str) -> ShopTables:
    events = table(spark, folder, "events")
    return ShopTables(
        users=_users(
            table(spark, folder, "customer"),
            "TIMESTAMP_NTZ '2023-12-01 00:00:00' "
            "+ make_dt_interval(cast(c_custkey % 60 AS INT))",
        ),
        orders=events.where("event_type = 'purchase'").selectExpr(
            "event_id AS order_id", "user_id", "ts AS order_date", "value AS total_amount",
            "'DONE' AS status",
            "CASE WHEN event_id % 5 = 0 THEN 'WELCOME10' END AS used_coupon_code",
        ),
        user_logins=events.where("event_type = 'view'").selectExpr(
            "event_id AS login_id", "user_id", "ts AS login_at"
        ),
        cart_items=events.where("event_type = 'click'").selectExpr(
            "event_id AS cart_item_id", "user_id", "1 AS quantity", "ts AS added_at"
        ),
    )


def shop_features(spark: SparkSession, folder: str) -> DataFrame:
    """User features at the shop's own reference date, staged for several passes."""
    tables = shop(spark, folder)
    ref = reference_date(tables)
    return stage(user_features(tables, ref, horizon_days=HORIZON_DAYS), "features")


def event_features(spark: SparkSession, folder: str) -> DataFrame:
    tables = event_shop(spark, folder)
    ref = reference_date(tables)
    return stage(user_features(tables, ref, horizon_days=EVENT_HORIZON_DAYS), "features")


def scored_features(spark: SparkSession, folder: str) -> DataFrame:
    return rfm_scores(shop_features(spark, folder))


def shop_ref(spark: SparkSession, folder: str) -> datetime:
    return reference_date(shop(spark, folder))


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed score formula over all orders, standing for three models."""
    models = F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(k).alias("k"))
        for name, k in (("good", 600), ("fair", 300), ("none", 0))
    ])
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey",
        F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("label"),
        F.inline(models),
    )
    spread = (F.col("id") * 7919) % 1000 + F.col("k") * F.col("label")
    return orders.select(
        "model", "id", "o_custkey", "label", (spread.cast("double") / 1600).alias("score")
    )
