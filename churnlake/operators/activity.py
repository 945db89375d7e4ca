"""Per-user activity from the fact tables.

Every aggregate here combines on the map side before its shuffle, so one user with
a large share of all rows costs no more than any other. The mean gap between
orders, which needs neighbours in time, first folds orders to one row per user and
calendar day: two orders of one day are less than 24 hours apart and add a gap of
zero whole days, so only first and last order of each active day matter. A user's
window is then as long as the calendar at most, however many orders there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions.exact import exact_avg, exact_sum, limb_sums, refolded
from churnlake.functions.expressions import elapsed_days, ts
from churnlake.operators import ranking as R
from churnlake.operators.joins import lookup
from churnlake.sources.tables import ShopTables


def clock_candidates(tables: ShopTables) -> DataFrame:
    """Latest event time of each table that can set the reference date."""
    parts = [
        df.agg(F.max(column).alias("latest")).select(F.lit(name).alias("source"), "latest")
        for name, column in S.CLOCK_COLUMNS.items()
        if (df := tables.present().get(name)) is not None
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def reference_date_frame(tables: ShopTables, horizon_days: int = S.CHURN_DAYS) -> DataFrame:
    """One row: the reference date and the inactivity threshold before it."""
    return (
        clock_candidates(tables)
        .agg(F.max("latest").alias("reference_date"))
        .withColumn(
            "threshold", F.col("reference_date") - F.make_dt_interval(F.lit(horizon_days))
        )
    )


def reference_date(tables: ShopTables) -> datetime:
    """The latest event of all tables; empty tables do not count."""
    latest = clock_candidates(tables).agg(F.max("latest")).first()[0]
    if latest is None:
        raise ValueError("no events: give the reference date explicitly")
    return latest


def last_purchase(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(F.max("order_date").alias("last_purchase_date"))


def order_summary(orders: DataFrame) -> DataFrame:
    """Count, sum, mean and date range of each user's orders in one pass."""
    return orders.groupBy("user_id").agg(
        F.count("order_id").alias("order_count"),
        exact_sum(F.col("total_amount")).alias("total_spend"),
        exact_avg(F.col("total_amount")).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def coupon_users(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(
        F.bool_or(F.col("used_coupon_code").isNotNull()).alias("used_coupon")
    )


def event_counts(events: DataFrame, count_name: str) -> DataFrame:
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias(count_name))


def order_days(orders: DataFrame, refs: Sequence[datetime] = (),
               extra: Sequence[Column] = ()) -> DataFrame:
    """Orders folded to one row per user, calendar day and stretch between refs.

    ``stretch`` counts the refs that lie before an order, so rows with
    ``stretch <= j`` are exactly the orders up to the j-th ref. ``gap_days`` and
    ``gaps`` add up the whole-day gaps between consecutive orders that end in the row.
    """
    stretch = sum((F.col("order_date") > ts(r)).cast("int") for r in sorted(refs))
    days = (
        orders.withColumn("stretch", stretch if len(refs) else F.lit(0))
        .groupBy("user_id", "stretch", F.to_date("order_date").alias("day"))
        .agg(
            F.count("order_id").alias("n"),
            F.count("order_date").alias("n_dated"),
            F.count("total_amount").alias("n_priced"),
            *limb_sums(F.col("total_amount"), "amount"),
            F.min("order_date").alias("first_at"),
            F.max("order_date").alias("last_at"),
            F.bool_or(F.col("used_coupon_code").isNotNull()).alias("any_coupon"),
            *extra,
        )
    )
    by_user = Window.partitionBy("user_id").orderBy(
        F.col("day").asc_nulls_first(), F.col("stretch")
    )
    before = F.lag("last_at").over(by_user)
    return days.withColumn("before", before).select(
        "*",
        F.coalesce(elapsed_days(F.col("before"), F.col("first_at")), F.lit(0)).alias("gap_days"),
        F.when(
            F.col("n_dated") > 0,
            F.col("n_dated") - 1 + F.col("before").isNotNull().cast("int"),
        ).otherwise(0).alias("gaps"),
    ).drop("before")


def order_profile_columns(within: Column | None = None) -> dict[str, Column]:
    """Aggregates over ``order_days`` rows, all of them or those ``within`` a condition."""

    def only(name: str) -> Column:
        return F.col(name) if within is None else F.when(within, F.col(name))

    return {
        "order_count": F.coalesce(F.sum(only("n")), F.lit(0)),
        "total_spend": refolded("amount", within),
        "first_order_date": F.min(only("first_at")),
        "last_order_date": F.max(only("last_at")),
        "avg_order_value": F.try_divide(refolded("amount", within), F.sum(only("n_priced"))),
        "avg_days_between_orders": F.try_divide(F.sum(only("gap_days")), F.sum(only("gaps"))),
        "used_coupon": F.coalesce(F.bool_or(only("any_coupon")), F.lit(False)),
    }


def order_profile(orders: DataFrame) -> DataFrame:
    """Everything the features need from a user's orders, from one scan."""
    columns = order_profile_columns()
    return (
        order_days(orders).groupBy("user_id").agg(*[c.alias(n) for n, c in columns.items()])
    )


def order_gaps(orders: DataFrame) -> DataFrame:
    """Mean whole-day gap between consecutive orders; NULL after a single order."""
    return order_profile(orders).select("user_id", "avg_days_between_orders")


def previous_order(orders: DataFrame) -> DataFrame:
    """Each order with the date of the user's previous order, ties by order id.

    The window runs per user and cell, where cells cut all orders into time ranges of
    equal size, so that even a user with most of the orders is spread over all of
    them. The first order of a cell takes its neighbour from the table of the user's
    cells, which has at most one row per cell.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                              F.col("order_date"))
    rows = R.ordered_cells(
        orders.select("order_id", "user_id", "order_date"), micros, "order_id"
    )
    inside = Window.partitionBy("user_id", *R.CELL).orderBy("order_date", "order_id")
    by_user = Window.partitionBy("user_id").orderBy(*R.CELL)
    carried = (
        rows.groupBy("user_id", *R.CELL).agg(F.max("order_date").alias("cell_end"))
        .select("user_id", *R.CELL, F.lag("cell_end").over(by_user).alias("carried"))
    )
    return (
        rows.withColumn("in_cell", F.lag("order_date").over(inside))
        .join(carried, ["user_id", *R.CELL], "left")
        .select(
            "order_id", "user_id", "order_date",
            F.coalesce("in_cell", "carried").alias("prev_order_date"),
        )
        .withColumn("days_between", elapsed_days(F.col("prev_order_date"), F.col("order_date")))
    )


def item_categories(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct (order, category) pairs of the sold items.

    Folding to pairs right after the product lookup combines on the map side, so an
    order with very many lines is small before the join with orders.
    """
    return (
        lookup(order_items.select("order_id", "product_id"),
               products.select("product_id", "category_id"), "product_id")
        .where(F.col("category_id").isNotNull())
        .select("order_id", "category_id")
        .distinct()
    )


def bought_categories(orders: DataFrame, order_items: DataFrame,
                      products: DataFrame) -> DataFrame:
    """Distinct (user, category) pairs of the sold items."""
    return _bought(orders, order_items, products).select("user_id", "category_id").distinct()


def _bought(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    return item_categories(order_items, products).join(
        orders.select("order_id", "user_id"), "order_id", "left"
    ).where(F.col("user_id").isNotNull())


def category_diversity(orders: DataFrame, order_items: DataFrame, products: DataFrame,
                       approximate: bool = False) -> DataFrame:
    """Number of distinct categories each user bought from."""
    if approximate:
        count = F.approx_count_distinct("category_id")
        return _bought(orders, order_items, products).groupBy("user_id").agg(
            count.alias("category_diversity"))
    return bought_categories(orders, order_items, products).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("category_diversity"))
