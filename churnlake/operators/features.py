"""The user feature table: churn label, recency, spend and activity per user."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.operators import activity as A
from churnlake.sources.tables import ShopTables
from churnlake.sources.user_days import UserDays

ZERO_FILL = {
    "order_count": 0, "total_spend": 0.0, "avg_order_value": 0.0,
    "login_count": 0, "cart_count": 0, "used_coupon": False,
}


def user_features(tables: ShopTables, ref: datetime, as_of_year: int | None = None,
                  horizon_days: int = S.CHURN_DAYS, exclude_status: Sequence[str] = (),
                  keep: Sequence[str] = ("gender", "birthdate", "created_at"),
                  approximate_diversity: bool = False) -> DataFrame:
    """One row per user; users without activity stay, with zeros or NULLs.

    All inputs of the joins are one row per user and hash-partitioned by user, so
    the users table is shuffled once and no fact row is shuffled after its fold.
    ``keep`` names the users columns to carry, extra categorical ones included.
    """
    orders = tables.orders
    if exclude_status:
        orders = orders.where(~F.coalesce(F.col("status").isin(*exclude_status), F.lit(False)))
    logins = tables.user_logins.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("login_count"), F.max("login_at").alias("last_login_at")
    )
    carts = tables.cart_items.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("cart_count"), F.max("added_at").alias("last_cart_at")
    )
    diversity = None
    if tables.products is not None and tables.order_items is not None:
        diversity = A.category_diversity(
            orders, tables.order_items, tables.products, approximate_diversity
        )
    return _assembled(tables.users, A.order_profile(orders), logins, carts, diversity, ref,
                      as_of_year, horizon_days, keep)


def features_of_days(days: UserDays, ref: datetime, as_of_year: int | None = None,
                     horizon_days: int = S.CHURN_DAYS,
                     keep: Sequence[str] = ("gender", "birthdate", "created_at")) -> DataFrame:
    """``user_features`` from facts stored by user and day, without a shuffle.

    Orders to leave out by status are left out when the facts are stored.
    """
    profile = days.orders.groupBy("user_id").agg(
        *[c.alias(n) for n, c in A.order_profile_columns().items()])
    logins = days.logins.groupBy("user_id").agg(
        F.sum("n").alias("login_count"), F.max("last_at").alias("last_login_at"))
    carts = days.carts.groupBy("user_id").agg(
        F.sum("n").alias("cart_count"), F.max("last_at").alias("last_cart_at"))
    diversity = days.bought.groupBy("user_id").agg(
        F.count("category_id").alias("category_diversity"))
    return _assembled(days.users, profile, logins, carts, diversity, ref, as_of_year,
                      horizon_days, keep)


def _assembled(users: DataFrame, profile: DataFrame, logins: DataFrame, carts: DataFrame,
               diversity: DataFrame | None, ref: datetime, as_of_year: int | None,
               horizon_days: int, keep: Sequence[str]) -> DataFrame:
    threshold = ref - timedelta(days=horizon_days)
    joined = (
        users.select("user_id", *keep)
        .join(profile, "user_id", "left")
        .join(logins, "user_id", "left")
        .join(carts, "user_id", "left")
        .withColumnRenamed("last_order_date", "last_purchase_date")
    )
    if diversity is not None:
        joined = joined.join(diversity, "user_id", "left")
    else:
        joined = joined.withColumn("category_diversity", F.lit(None).cast("bigint"))
    last = F.col("last_purchase_date")
    filled = joined.na.fill({**ZERO_FILL, "category_diversity": 0})
    year = ref.year if as_of_year is None else as_of_year
    out = filled.withColumns({
        "churn": E.inactive(last, threshold),
        "recency_days": E.recency_days(last, ref, horizon_days),
        "avg_cart_per_login": E.ratio_or_zero(F.col("cart_count"), F.col("login_count")),
    })
    if "birthdate" in keep:
        out = out.withColumn("age", E.age_in(F.col("birthdate"), year))
        out = out.withColumn("age_group", E.age_band(F.col("age")))
    return out


def wide_assembly(tables: ShopTables) -> DataFrame:
    """Users with their raw per-user aggregates, before any fill."""
    return (
        tables.users.select("user_id")
        .join(A.order_profile(tables.orders), "user_id", "left")
        .join(A.event_counts(tables.user_logins, "login_count"), "user_id", "left")
        .join(A.event_counts(tables.cart_items, "cart_count"), "user_id", "left")
    )
