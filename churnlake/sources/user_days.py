"""Facts folded to user and day, stored in buckets of users.

Orders, logins and carts become one row per user and day, so a user has at most as many rows as
the calendar has days, however dominant. All tables have the same number of buckets by
``user_id``, so that folding and joining them by user needs no shuffle: whatever reads them pays
the exchange of the facts once, when they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators import activity as A
from churnlake.session import small_frame
from churnlake.sources.tables import ShopTables

BUCKETS = 200
TABLES = ("users", "orders", "logins", "carts", "bought")


@dataclass(frozen=True)
class UserDays:
    """Users; orders, logins and carts by user and day; distinct categories bought by user."""

    users: DataFrame
    orders: DataFrame
    logins: DataFrame
    carts: DataFrame
    bought: DataFrame


def event_days(events: DataFrame, at: str) -> DataFrame:
    """Events folded to one row per user and day; those without a time share a null day."""
    return events.groupBy("user_id", F.to_date(at).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max(at).alias("last_at"))


def user_days(tables: ShopTables) -> UserDays:
    """The folded facts, not yet stored. Without items or products nothing counts as bought."""
    if tables.products is not None and tables.order_items is not None:
        bought = A.bought_categories(tables.orders, tables.order_items, tables.products)
    else:
        bought = tables.users.select("user_id", F.lit(None).cast("int").alias("category_id"))
        bought = bought.limit(0)
    return UserDays(
        tables.users, A.order_days(tables.orders).drop("stretch"),
        event_days(tables.user_logins, "login_at"), event_days(tables.cart_items, "added_at"),
        bought,
    )


def _place(folder: str, name: str, buckets: int) -> str:
    return f"{folder.rstrip('/')}/{buckets}_buckets/{name}"


def write_user_days(tables: ShopTables, folder: str, prefix: str = "user_days",
                    buckets: int = BUCKETS) -> UserDays:
    """Fold, write one file per bucket and table, and open what was written."""
    made, spark, lines = user_days(tables), tables.users.sparkSession, []
    for name in TABLES:
        rows = getattr(made, name)
        (
            rows.repartition(buckets, "user_id").write.mode("overwrite")
            .format("parquet").bucketBy(buckets, "user_id").sortBy("user_id")
            .option("path", _place(folder, name, buckets)).saveAsTable(f"{prefix}_{name}")
        )
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        lines.append((name, columns))
    small_frame(spark, lines, "name STRING, columns STRING").coalesce(1).write.mode(
        "overwrite").parquet(_place(folder, "columns", buckets))
    return open_user_days(spark, folder, prefix, buckets)


def open_user_days(spark: SparkSession, folder: str, prefix: str = "user_days",
                   buckets: int = BUCKETS) -> UserDays:
    """Stored tables under session names ``prefix_...``; a session that did not write them too.

    The columns' types are stored last, so a store that was not finished cannot be opened. The
    number of buckets is part of the path, so a wrong one fails instead of reading wrongly.
    """
    found = {}
    for name, columns in spark.read.parquet(_place(folder, "columns", buckets)).collect():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{prefix}_{name}` ({columns}) USING parquet "
                  f"CLUSTERED BY (user_id) SORTED BY (user_id) INTO {buckets} BUCKETS "
                  f"LOCATION '{_place(folder, name, buckets)}'")
        found[name] = spark.table(f"`{prefix}_{name}`")
    return UserDays(**found)
