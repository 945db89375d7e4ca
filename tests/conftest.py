from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlake.session import local_session  # noqa: E402
from churnlake.sources.tables import ShopTables  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 8, "churnlake-tests")


@pytest.fixture()
def clean_cache(spark):
    yield
    spark.catalog.clearCache()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


REF = at("2025-06-30 12:00:00")


@pytest.fixture(scope="session")
def small_shop(spark) -> ShopTables:
    """Hand-made users around the boundaries; reference date 2025-06-30 12:00."""
    users = spark.createDataFrame(
        [
            (1, "MALE", "2000-05-01", "2024-01-01 00:00:00"),    # buys a lot
            (2, "FEMALE", "1990-05-01", "2024-01-01 00:00:00"),  # last order on the threshold
            (3, "male", "1986-05-01", "2024-01-01 00:00:00"),    # one microsecond before it
            (4, "M", "2001-05-01", "2024-01-01 00:00:00"),       # never bought, logs in
            (5, None, "1980-05-01", "2025-06-29 00:00:00"),      # never active, joined late
        ],
        "user_id BIGINT, gender STRING, birthdate STRING, created_at STRING",
    ).selectExpr("user_id", "gender", "cast(birthdate AS DATE) AS birthdate",
                 "cast(created_at AS TIMESTAMP_NTZ) AS created_at")
    orders = spark.createDataFrame(
        [
            (10, 1, "2025-06-29 13:00:00", 10.0, "PAID", None),
            (11, 1, "2025-06-20 10:00:00", 20.0, "PAID", "WELCOME10"),
            (12, 1, "2025-06-20 09:00:00", 30.0, "CANCELLED", None),
            (13, 1, "2025-06-17 11:00:00", 40.0, "PAID", None),
            (20, 2, "2025-04-01 12:00:00", 5.0, "PAID", None),
            (30, 3, "2025-04-01 11:59:59.999999", 7.0, "PAID", None),
        ],
        "order_id BIGINT, user_id BIGINT, order_date STRING, total_amount DOUBLE, "
        "status STRING, used_coupon_code STRING",
    ).withColumn("order_date", _ts("order_date"))
    items = spark.createDataFrame(
        [(1, 10, 100, 2, 5.0), (2, 11, 101, 1, 20.0), (3, 12, 100, 3, 10.0), (4, 20, 102, 1, 5.0),
         (5, 99, 100, 1, 1.0)],
        "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
        "price_per_item DOUBLE",
    )
    products = spark.createDataFrame(
        [(100, 1), (101, 2), (102, None)], "product_id BIGINT, category_id INT"
    )
    logins = spark.createDataFrame(
        [(1, 1, "2025-06-30 12:00:00"), (2, 4, "2025-06-01 00:00:00"),
         (3, 4, "2025-06-02 00:00:00")],
        "login_id BIGINT, user_id BIGINT, login_at STRING",
    ).withColumn("login_at", _ts("login_at"))
    carts = spark.createDataFrame(
        [(1, 4, 100, 7, "2025-06-02 00:00:00")],
        "cart_item_id BIGINT, user_id BIGINT, product_id BIGINT, quantity INT, added_at STRING",
    ).withColumn("added_at", _ts("added_at"))
    interests = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "user_id BIGINT, category_id INT")
    return ShopTables(users, orders, logins, carts, items, products, None, interests)


def _ts(column: str):
    from pyspark.sql import functions as F

    return F.col(column).cast("timestamp_ntz")
