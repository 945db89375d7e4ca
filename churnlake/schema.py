"""Table schemas, label dimensions and fixed parameters of the shop data model."""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# These must stay as they are for results to be comparable with published
# figures: column names and types of the shop tables, band edges and labels,
# cohort definitions, horizons and threshold grids.

TABLE_SCHEMAS = {
    "users": (
        "user_id BIGINT, email STRING, password_hash STRING, user_name STRING, "
        "gender STRING, birthdate DATE, phone_number STRING, created_at TIMESTAMP_NTZ"
    ),
    "orders": (
        "order_id BIGINT, user_id BIGINT, order_date TIMESTAMP_NTZ, total_amount DOUBLE, "
        "status STRING, shipping_address STRING, used_coupon_code STRING"
    ),
    "order_items": (
        "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
        "price_per_item DOUBLE"
    ),
    "user_logins": "login_id BIGINT, user_id BIGINT, login_at TIMESTAMP_NTZ",
    "cart_items": (
        "cart_item_id BIGINT, user_id BIGINT, product_id BIGINT, quantity INT, "
        "added_at TIMESTAMP_NTZ"
    ),
    "products": (
        "product_id BIGINT, category_id INT, product_name STRING, description STRING, "
        "price DOUBLE, stock_quantity INT, created_at TIMESTAMP_NTZ"
    ),
    "categories": "category_id INT, category_name STRING, parent_id DOUBLE",
    "user_interests": "user_id BIGINT, category_id INT",
}
REQUIRED_TABLES = ("users", "orders", "user_logins", "cart_items")
OPTIONAL_TABLES = ("order_items", "products", "categories", "user_interests")

# Event-time column of each table that can set the reference date.
CLOCK_COLUMNS = {
    "orders": "order_date",
    "user_logins": "login_at",
    "cart_items": "added_at",
    "users": "created_at",
}

CHURN_DAYS = 90
NEVER_BOUGHT_EXTRA_DAYS = 9999

AGE_EDGES = (0, 24, 34, 44, 200)
AGE_LABELS = ("<25", "25-34", "35-44", "45+")
RFM_EDGES = (2, 5, 8, 11, 15)
RFM_LABELS = ("Low(3-5)", "Mid-Low(6-8)", "Mid-High(9-11)", "High(12-15)")

SNAPSHOT_COHORT_GENDERS = ("MALE", "male", "Male", "M", "m")
SNAPSHOT_COHORT_AGES = (20, 39)
MODEL_COHORT_AGES = (20, 34)

NUMERIC_PROFILE = (
    "order_count", "total_spend", "avg_order_value", "avg_days_between_orders",
    "login_count", "cart_count", "recency_days", "RFM_sum", "age",
)
CATEGORICAL_PROFILE = ("gender", "age_group", "used_coupon")
BOX_VARIABLES = (
    "login_count", "total_spend", "order_count", "avg_order_value", "recency_days",
)
DRIVER_NUMERIC = (
    "order_count", "total_spend", "avg_order_value", "avg_days_between_orders",
    "login_count", "cart_count", "avg_cart_per_login", "category_diversity", "age",
)
SEGMENT_FEATURES = (
    "login_count", "order_count", "avg_cart_per_login", "category_diversity",
)
SNAPSHOT_COLUMNS = (
    "user_id", "birthdate", "created_at", "gender", "order_count", "total_spend",
    "last_order", "avg_order_value", "avg_days_between_orders", "login_count",
    "cart_count", "age", "age_group", "avg_cart_per_login", "is_male_20s30s",
    "snapshot_ref_date", "churn_90d",
)
SNAPSHOT_MEDIANS = (
    "order_count", "login_count", "avg_days_between_orders", "total_spend", "age",
)
TRAINING_COLUMNS = (
    "user_id", "age", "gender", "tenure_days", "num_interests", "recency_score",
    "frequency_score", "monetary_score", "monetary_avg_order", "avg_items_per_order",
    "frequency_last_30d", "frequency_last_90d", "days_between_orders",
    "coupon_usage_rate", "days_since_last_session", "cart_additions_last_30d", "churn",
)
TRAINING_NUMERIC = tuple(
    c for c in TRAINING_COLUMNS if c not in ("user_id", "gender", "churn")
) + ("gender_bin",)

FULL_GRID = (0.0, 1.0, 2001)     # thresholds searched by the driver analysis
TRAIN_GRID = (0.05, 0.95, 181)   # thresholds searched by model training
# --- end of fixed values ----------------------------------------------------
