"""Queries for aggregations (A), windows (W), sort and top-k (T) and scalar functions (F)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.operators import activity as A
from churnlake.operators import evaluate as V
from churnlake.operators import explore as X
from churnlake.operators import mlprep as M
from churnlake.operators import ranking as R
from churnlake.operators import segment as G
from churnlake.operators import sketches as K
from churnlake.operators import snapshot as N
from churnlake.operators.joins import lookup
from churnlake.registry import star_tables as T
from churnlake.registry.base import b, longs, query, r6, rounded
from churnlake.registry.sql import CENTRES, CTES, NUMERIC, exact_avg, exact_sum
from churnlake.registry.star_tables import HORIZON_DAYS as H
from churnlake.session import keep, stage

SEGMENT = list(S.SEGMENT_FEATURES)


# --- A: aggregations -----------------------------------------------------------------


@query("a1_reference_date", "SELECT ref AS reference_date, threshold FROM s_clock")
def a1_reference_date(spark: SparkSession, folder: str) -> DataFrame:
    return A.reference_date_frame(T.shop(spark, folder), H)


@query("a2_last_purchase", """
SELECT user_id, max(order_date) AS last_purchase_date FROM s_orders GROUP BY user_id""")
def a2_last_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return A.last_purchase(T.shop(spark, folder).orders)


@query("a3_order_summary", f"""
SELECT user_id, count(order_id) AS order_count, {exact_sum('total_amount')} AS total_spend,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM s_orders GROUP BY user_id""")
def a3_order_summary(spark: SparkSession, folder: str) -> DataFrame:
    return A.order_summary(T.shop(spark, folder).orders).drop("avg_order_value")


@query("a4_average_order_value", """
SELECT user_id, avg_order_value FROM s_profile""")
def a4_average_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return A.order_profile(T.shop(spark, folder).orders).select("user_id", "avg_order_value")


@query("a5_activity_counts", """
SELECT user_id, coalesce(login_count, 0) AS login_count, coalesce(cart_count, 0) AS cart_count
FROM (SELECT user_id, count(*) AS login_count FROM s_logins GROUP BY user_id)
FULL JOIN (SELECT user_id, count(*) AS cart_count FROM s_carts GROUP BY user_id)
  USING (user_id)""")
def a5_activity_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    logins = A.event_counts(tables.user_logins, "login_count")
    return logins.join(A.event_counts(tables.cart_items, "cart_count"), "user_id", "full").na.fill(
        0, ["login_count", "cart_count"]
    )


@query("a6_any_coupon", """
SELECT user_id, bool_or(used_coupon_code IS NOT NULL) AS used_coupon FROM s_orders
GROUP BY user_id""")
def a6_any_coupon(spark: SparkSession, folder: str) -> DataFrame:
    return A.coupon_users(T.shop(spark, folder).orders)


@query("a7_last_activity_dates", """
SELECT user_id, last_login_at, last_cart_at
FROM (SELECT user_id, max(login_at) AS last_login_at FROM s_logins GROUP BY user_id)
FULL JOIN (SELECT user_id, max(added_at) AS last_cart_at FROM s_carts GROUP BY user_id)
  USING (user_id)""")
def a7_last_activity_dates(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    logins = tables.user_logins.groupBy("user_id").agg(F.max("login_at").alias("last_login_at"))
    carts = tables.cart_items.groupBy("user_id").agg(F.max("added_at").alias("last_cart_at"))
    return logins.join(carts, "user_id", "full")


@query("a8_category_diversity", "SELECT user_id, category_diversity FROM s_diversity")
def a8_category_diversity(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    return A.category_diversity(tables.orders, tables.order_items, tables.products)


def _bands(labels: tuple[str, ...], key: str, source: str) -> str:
    values = ", ".join(f"('{label}', {i})" for i, label in enumerate(labels))
    return f"""
SELECT {key}, CAST(position AS INT) AS position, round(avg(churn), 6) AS churn_rate,
       count(churn) AS n
FROM (VALUES {values}) AS d({key}, position) LEFT JOIN {source} USING ({key})
GROUP BY {key}, position"""


@query("a9_rate_by_gender", """
SELECT gender, round(avg(churn), 6) AS churn_rate, count(*) AS n FROM s_features
GROUP BY gender""")
def a9_rate_by_gender(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.group_rate(T.shop_features(spark, folder), "gender"), ["churn_rate"])


@query("a9_rate_by_age_group", _bands(S.AGE_LABELS, "age_group", "s_features"))
def a9_rate_by_age_group(spark: SparkSession, folder: str) -> DataFrame:
    rates = X.group_rate(T.shop_features(spark, folder), "age_group", labels=S.AGE_LABELS)
    return rounded(rates, ["churn_rate"])


@query("a9_rate_by_coupon", """
SELECT used_coupon, round(avg(churn), 6) AS churn_rate, count(*) AS n FROM s_features
GROUP BY used_coupon""")
def a9_rate_by_coupon(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.group_rate(T.shop_features(spark, folder), "used_coupon"), ["churn_rate"])


@query("a10_rate_by_rfm_bucket", _bands(S.RFM_LABELS, "RFM_bucket", "s_scored"))
def a10_rate_by_rfm_bucket(spark: SparkSession, folder: str) -> DataFrame:
    rates = X.group_rate(T.scored_features(spark, folder), "RFM_bucket", labels=S.RFM_LABELS)
    return rounded(rates, ["churn_rate"])


PROFILE_MEANS = ["order_count_mean", "login_count_mean", "recency_days_mean", "churn_rate"]


@query("a11_rfm_profile", f"""
SELECT d.RFM_bucket, CAST(position AS INT) AS position, count(churn) AS n,
       round(avg(order_count), 4) AS order_count_mean,
       {exact_avg('total_spend')} AS total_spend_mean,
       round(avg(login_count), 4) AS login_count_mean,
       round(avg(recency_days), 4) AS recency_days_mean, round(avg(churn), 4) AS churn_rate
FROM (VALUES {', '.join(f"('{v}', {i})" for i, v in enumerate(S.RFM_LABELS))})
     AS d(RFM_bucket, position) LEFT JOIN s_scored USING (RFM_bucket)
GROUP BY ALL""")
def a11_rfm_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.rfm_profile(T.scored_features(spark, folder)), PROFILE_MEANS, 4)


@query("a12_overall_rate", "SELECT round(avg(churn), 6) AS churn_rate, count(*) AS n "
                           "FROM s_features")
def a12_overall_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.overall_rate(T.shop_features(spark, folder)), ["churn_rate"])


@query("a13_describe", f"""
SELECT variable, count(value) AS count, {exact_avg('value')} AS mean,
       round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
       round(max(value), 4) AS max, round(quantile_cont(value, 0.25), 4) AS q1,
       round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3
FROM long_numeric GROUP BY variable""")
def a13_describe(spark: SparkSession, folder: str) -> DataFrame:
    table = X.describe(T.scored_features(spark, folder), list(NUMERIC))
    return rounded(table, ["std", "min", "max", "q1", "median", "q3"], 4)


@query("a13_merged_sketches", """
SELECT gender, count(*) AS n, count(DISTINCT user_id) AS buyers, TRUE AS buyers_close,
       TRUE AS ranks_close
FROM s_orders JOIN s_users USING (user_id) GROUP BY gender""")
def a13_merged_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sketches merged over all days, held against exact counts and ranks of all rows."""
    tables = T.shop(spark, folder)
    rows = keep(lookup(tables.orders.select("user_id", "order_date", "total_amount"),
                       tables.users.select("user_id", "gender"), "user_id", "inner"))
    days = K.daily_sketches(rows, "order_date", ["gender"], ["user_id"], ["total_amount"])
    found = K.sketch_summary(K.merged_sketches(stage(days, "day-sketches"), ["gender"]))
    found = found.select("gender", F.col("n").alias("kept"), "user_id_distinct",
                         "total_amount_quantiles")
    below = [F.count_if(F.col("total_amount") <= F.col("total_amount_quantiles")[i]) / F.count("*")
             for i in range(3)]
    exact = rows.join(F.broadcast(found), "gender").groupBy("gender").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("buyers"),
        F.max("kept").alias("kept"), F.max("user_id_distinct").alias("estimate"),
        F.greatest(*[F.abs(b - p) for b, p in zip(below, (0.25, 0.5, 0.75))]).alias("off"))
    return exact.select(
        "gender", "n", "buyers",
        (F.abs(F.col("estimate") / F.col("buyers") - 1) < 0.05).alias("buyers_close"),
        ((F.col("off") < 0.03) & (F.col("kept") == F.col("n"))).alias("ranks_close"))


@query("a14_missing", """
SELECT variable, count(*) FILTER (value IS NULL) AS missing_count,
       round(avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END), 4) AS missing_ratio
FROM (SELECT variable, CAST(value AS VARCHAR) AS value FROM long_numeric
      UNION ALL SELECT variable, level FROM long_levels
      UNION ALL SELECT 'churn', CAST(churn AS VARCHAR) FROM s_features
      UNION ALL SELECT 'last_login_at', CAST(last_login_at AS VARCHAR) FROM s_features)
GROUP BY variable""")
def a14_missing(spark: SparkSession, folder: str) -> DataFrame:
    columns = [*NUMERIC, *S.CATEGORICAL_PROFILE, "churn", "last_login_at"]
    return X.missing(T.scored_features(spark, folder), columns)


OUTLIER_SQL = """
SELECT variable, count(*) FILTER (value < low OR value > high) AS outlier_count,
       round(avg(CASE WHEN value < low OR value > high THEN 1 ELSE 0 END), 4) AS outlier_ratio,
       round(any_value(low), 3) AS lower_bound, round(any_value(high), 3) AS upper_bound
FROM (SELECT user_id, variable, value FROM long_numeric WHERE value IS NOT NULL)
JOIN (SELECT variable, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
      FROM (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
            FROM long_numeric GROUP BY variable)) USING (variable)
GROUP BY variable"""


@query("a15_iqr_outliers", OUTLIER_SQL)
def a15_iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return X.outliers(T.scored_features(spark, folder), list(NUMERIC))


CTES["corr_pairs"] = "\nUNION ALL ".join(
    f"SELECT '{x}' AS variable_a, '{y}' AS variable_b, round(corr({x}, {y}), 6) AS corr "
    "FROM s_scored" for x in NUMERIC for y in NUMERIC
)


@query("a16_correlations", "SELECT * FROM corr_pairs")
def a16_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.correlations(T.scored_features(spark, folder), list(NUMERIC)), ["corr"])


@query("a17_crosstab", """
SELECT variable, level, count(*) FILTER (churn = 0) AS n_active,
       count(*) FILTER (churn = 1) AS n_churned
FROM long_levels WHERE level IS NOT NULL GROUP BY variable, level""")
def a17_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return X.crosstab(T.shop_features(spark, folder), S.CATEGORICAL_PROFILE)


@query("a18_class_centres", f"""
SELECT variable, CAST(churn AS INT) AS churn, count(value) AS n, {exact_avg('value')} AS mean,
       round(median(value), 4) AS median
FROM long_numeric GROUP BY variable, churn""")
def a18_class_centres(spark: SparkSession, folder: str) -> DataFrame:
    table = X.class_centres(T.scored_features(spark, folder), list(NUMERIC))
    return rounded(table, ["median"], 4)


@query("a19_cohort_summary", f"""
SELECT snapshot_ref_date, part, count(*) AS n_rows, CAST(17 AS INT) AS n_columns,
       round(avg(churn_90d), 6) AS label_rate,
       round(count(*)::DOUBLE / any_value(n_full), 6) AS share,
       {', '.join(f'round(median({c}), 4) AS median_{c}' for c in S.SNAPSHOT_MEDIANS)}
FROM (SELECT *, 'full' AS part FROM s_snapshots
      UNION ALL SELECT *, 'cohort' FROM s_snapshots WHERE is_male_20s30s = 1)
JOIN (SELECT snapshot_ref_date, count(*) AS n_full FROM s_snapshots GROUP BY 1)
  USING (snapshot_ref_date)
GROUP BY snapshot_ref_date, part""")
def a19_cohort_summary(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    latest = A.reference_date(tables)
    refs = [latest - timedelta(days=2 * H), latest - timedelta(days=H)]
    table = X.cohort_summary(keep(N.snapshots(tables, refs, H)))
    medians = [f"median_{c}" for c in S.SNAPSHOT_MEDIANS]
    return rounded(rounded(table, ["label_rate", "share"]), medians, 4)


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Users with the nearest of four fixed centres in the scaled feature space."""
    vectors = G.scaled_vectors(T.shop_features(spark, folder), SEGMENT)
    z = [F.col(f"z_{c}") for c in SEGMENT]
    return vectors.withColumn("cluster", G.nearest_centre(z, CENTRES))


@query("a20_cluster_summary", f"""
SELECT CAST(cluster AS INT) AS cluster, count(*) AS size, round(avg(churn), 4) AS churn_rate,
       {', '.join(f'{exact_avg(c)} AS {c}_mean' for c in SEGMENT)},
       {', '.join(f'round(median({c}), 4) AS {c}_median' for c in SEGMENT)}
FROM seg_assigned GROUP BY cluster""")
def a20_cluster_summary(spark: SparkSession, folder: str) -> DataFrame:
    table = X.cluster_summary(keep(assigned(spark, folder)), "cluster", SEGMENT)
    return rounded(table, [*[f"{c}_median" for c in SEGMENT], "churn_rate"], 4)


@query("a21_cluster_z", f"""
SELECT cluster, {', '.join(f'round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}' for c in SEGMENT)}
FROM (SELECT CAST(cluster AS INT) AS cluster, {', '.join(f'{exact_avg(c)} AS {c}' for c in SEGMENT)}
      FROM seg_assigned GROUP BY 1)""")
def a21_cluster_z(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(X.cluster_z(assigned(spark, folder), "cluster", SEGMENT), SEGMENT)


@query("a22_histogram", """
SELECT variable, CAST(bin AS INT) AS bin, round(lo + bin * ((hi - lo) / 30), 4) AS bin_start,
       count(value) AS n
FROM (SELECT variable, min(value) AS lo, max(value) AS hi FROM long_numeric GROUP BY variable)
CROSS JOIN (SELECT unnest(range(30)) AS bin)
LEFT JOIN (SELECT variable, value, least(floor((value - lo) / (hi - lo) * 30), 29) AS bin
           FROM long_numeric
           JOIN (SELECT variable, min(value) AS lo, max(value) AS hi FROM long_numeric
                 GROUP BY variable) USING (variable) WHERE value IS NOT NULL)
  USING (variable, bin)
GROUP BY variable, bin, lo, hi""")
def a22_histogram(spark: SparkSession, folder: str) -> DataFrame:
    table = X.histogram(T.scored_features(spark, folder), list(NUMERIC))
    return rounded(table, ["bin_start"], 4)


@query("a23_value_counts", """
SELECT variable, coalesce(level, 'nan') AS level, count(*) AS n
FROM (SELECT variable, level FROM long_levels
      UNION ALL SELECT 'last_login_day', CAST(CAST(last_login_at AS DATE) AS VARCHAR)
      FROM s_features)
GROUP BY ALL""")
def a23_value_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = T.shop_features(spark, folder).withColumn("last_login_day", F.to_date("last_login_at"))
    return X.value_counts(rows, [*S.CATEGORICAL_PROFILE, "last_login_day"])


@query("a24_box_summary", f"""
SELECT churn, variable, round(q1, 4) AS q1, round(mid, 4) AS median, round(q3, 4) AS q3,
       round(min(value) FILTER (value >= q1 - (q3 - q1) * 1.5), 4) AS whisker_low,
       round(max(value) FILTER (value <= q3 + (q3 - q1) * 1.5), 4) AS whisker_high,
       count(*) FILTER (value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5) AS fliers
FROM (SELECT CAST(churn AS INT) AS churn, variable, value FROM long_numeric
      WHERE value IS NOT NULL AND variable IN {S.BOX_VARIABLES})
JOIN (SELECT churn, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS mid,
             quantile_cont(value, 0.75) AS q3 FROM long_numeric GROUP BY churn, variable)
  USING (churn, variable)
GROUP BY churn, variable, q1, mid, q3""")
def a24_box_summary(spark: SparkSession, folder: str) -> DataFrame:
    table = X.box_summary(T.scored_features(spark, folder), S.BOX_VARIABLES)
    return rounded(table, ["q1", "median", "q3", "whisker_low", "whisker_high"], 4)


SPLIT_SQL = """CASE WHEN CAST(('0x' || substr(md5(concat(user_id, ':42')), 1, 13)) AS BIGINT)
  < CAST(floor({share} * 4503599627370496) AS BIGINT) THEN 'test' ELSE 'train' END"""


@query("a25_split_summary", f"""
SELECT split, count(*) AS size, round(avg(churn), 6) AS label_rate
FROM (SELECT churn, {SPLIT_SQL.format(share=0.25)} AS split FROM s_features) GROUP BY split""")
def a25_split_summary(spark: SparkSession, folder: str) -> DataFrame:
    marked = M.split(T.shop_features(spark, folder), "user_id", "churn", 0.25)
    return rounded(M.split_summary(marked, "churn"), ["label_rate"])


# --- W: windows ----------------------------------------------------------------------


@query("w1_previous_order", """
SELECT order_id, user_id, order_date, prev_order_date,
       datesub('day', prev_order_date, order_date) AS days_between
FROM (SELECT *, lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date, order_id)
        AS prev_order_date FROM s_orders)""")
def w1_previous_order(spark: SparkSession, folder: str) -> DataFrame:
    return A.previous_order(T.shop(spark, folder).orders)


@query("w1_previous_order_events", """
SELECT order_id, user_id, order_date, prev_order_date,
       datesub('day', prev_order_date, order_date) AS days_between
FROM (SELECT *, lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date, order_id)
        AS prev_order_date FROM e_orders)""")
def w1_previous_order_events(spark: SparkSession, folder: str) -> DataFrame:
    return A.previous_order(T.event_shop(spark, folder).orders)


@query("w2_mean_order_gap", """
SELECT user_id, round(avg_days_between_orders, 6) AS avg_days_between_orders FROM s_profile""")
def w2_mean_order_gap(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.order_gaps(T.shop(spark, folder).orders), ["avg_days_between_orders"])


@query("w2_mean_order_gap_events", """
SELECT user_id, round(avg_days_between_orders, 6) AS avg_days_between_orders FROM e_profile""")
def w2_mean_order_gap_events(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.order_gaps(T.event_shop(spark, folder).orders), ["avg_days_between_orders"])


@query("w3_stable_rank", """
SELECT order_id, total_amount, row_number() OVER (ORDER BY total_amount, order_id) AS rank
FROM s_orders""")
def w3_stable_rank(spark: SparkSession, folder: str) -> DataFrame:
    return R.global_rank(T.shop(spark, folder).orders, "total_amount", "order_id").select(
        "order_id", "total_amount", "rank"
    )


@query("w3_stable_rank_ties", """
SELECT order_id, amount, row_number() OVER (ORDER BY amount, order_id) AS rank
FROM (SELECT order_id, CASE WHEN total_amount < 150000 THEN 0.0 ELSE
        CAST(floor(total_amount / 1000) AS DOUBLE) END AS amount FROM s_orders)""")
def w3_stable_rank_ties(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all rows share one value."""
    rows = T.shop(spark, folder).orders.selectExpr(
        "order_id",
        "CASE WHEN total_amount < 150000 THEN 0.0D "
        "ELSE cast(floor(total_amount / 1000) AS DOUBLE) END AS amount",
    )
    return R.global_rank(rows, "amount", "order_id").select("order_id", "amount", "rank")


@query("w4_quantile_score", """
SELECT user_id, CAST(M_score AS INT) AS score, total_spend_r AS total_spend FROM
(SELECT *, round(total_spend, 4) AS total_spend_r FROM s_scored)""")
def w4_quantile_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = R.quantile_score(T.shop_features(spark, folder), "total_spend", "score")
    return rounded(scored.select("user_id", "score", "total_spend"), ["total_spend"], 4)


@query("w4_quantile_score_few_values", """
SELECT user_id, CAST(greatest(1, ((row_number() OVER (ORDER BY gender_bin, user_id) - 1) * 2
         + count(*) OVER () - 2) // (count(*) OVER () - 1)) AS INT) AS score
FROM (SELECT user_id, CASE WHEN gender = 'MALE' THEN 1 ELSE 0 END AS gender_bin FROM s_users)""")
def w4_quantile_score_few_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = T.shop(spark, folder).users.select(
        "user_id", E.gender_bin(F.col("gender")).alias("gender_bin")
    )
    return R.quantile_score(rows, "gender_bin", "score").select("user_id", "score")


@query("w5_rfm_scores", """
SELECT user_id, CAST(R_score AS INT) AS R_score, CAST(F_score AS INT) AS F_score,
       CAST(M_score AS INT) AS M_score, CAST(RFM_sum AS INT) AS RFM_sum, RFM_bucket
FROM s_scored""")
def w5_rfm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return T.scored_features(spark, folder).select(
        "user_id", "R_score", "F_score", "M_score", "RFM_sum", "RFM_bucket"
    )


@query("w5_rfm_scores_recent_high", """
SELECT user_id, CAST(6 - greatest(1, ((row_number() OVER (ORDER BY recency_days, user_id) - 1) * 5
         + count(*) OVER () - 2) // (count(*) OVER () - 1)) AS INT) AS R_score,
       CAST(F_score AS INT) AS F_score, CAST(M_score AS INT) AS M_score
FROM s_scored""")
def w5_rfm_scores_recent_high(spark: SparkSession, folder: str) -> DataFrame:
    scored = R.rfm_scores(T.shop_features(spark, folder), r_mode="recent_high")
    return scored.select("user_id", "R_score", "F_score", "M_score")


@query("w6_average_rank", """
SELECT recency_days, count(*) AS n, avg(place) AS avg_rank
FROM (SELECT CAST(recency_days AS BIGINT) AS recency_days,
             row_number() OVER (ORDER BY recency_days) AS place FROM s_features)
GROUP BY recency_days""")
def w6_average_rank(spark: SparkSession, folder: str) -> DataFrame:
    return R.average_rank(T.shop_features(spark, folder), "recency_days")


# --- T: sort, top-k, arg-max ----------------------------------------------------------


@query("t1_sorted_outliers", OUTLIER_SQL + " ORDER BY outlier_count DESC, variable")
def t1_sorted_outliers(spark: SparkSession, folder: str) -> DataFrame:
    table = X.outliers(T.scored_features(spark, folder), list(NUMERIC))
    return table.orderBy(F.col("outlier_count").desc(), "variable")


@query("t2_top_users", """
SELECT user_id, round(total_spend, 4) AS total_spend FROM s_features
ORDER BY s_features.total_spend DESC, user_id LIMIT 15""")
def t2_top_users(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.order_summary(T.shop(spark, folder).orders).select("user_id", "total_spend")
    top = rows.orderBy(F.col("total_spend").desc(), "user_id").limit(15)
    return rounded(top, ["total_spend"], 4)



@query("t3_best_row", """
SELECT model, id, score FROM (SELECT *, row_number() OVER (
  PARTITION BY model ORDER BY score DESC, id) AS place FROM scores) WHERE place = 1""")
def t3_best_row(spark: SparkSession, folder: str) -> DataFrame:
    best = F.max_by(F.struct("id", "score"), F.struct(F.col("score"), -F.col("id")))
    return T.model_scores(spark, folder).groupBy("model").agg(best.alias("row")).select(
        "model", "row.*"
    )


@query("t4_nearest_row", """
SELECT model, id, score FROM (SELECT *, row_number() OVER (
  PARTITION BY model ORDER BY abs(score - 0.5), id) AS place FROM scores) WHERE place = 1""")
def t4_nearest_row(spark: SparkSession, folder: str) -> DataFrame:
    near = F.min_by(
        F.struct("id", "score"), F.struct(F.abs(F.col("score") - 0.5), F.col("id"))
    )
    return T.model_scores(spark, folder).groupBy("model").agg(near.alias("row")).select(
        "model", "row.*"
    )


@query("t5_top_and_bottom", """
SELECT * FROM (SELECT user_id, round(total_spend, 4) AS total_spend, 'top' AS part
  FROM s_profile ORDER BY s_profile.total_spend DESC, user_id LIMIT 15)
UNION ALL
SELECT * FROM (SELECT user_id, round(total_spend, 4), 'bottom' FROM s_profile
  ORDER BY s_profile.total_spend, user_id DESC LIMIT 15)""")
def t5_top_and_bottom(spark: SparkSession, folder: str) -> DataFrame:
    rows = A.order_summary(T.shop(spark, folder).orders).select("user_id", "total_spend")
    return rounded(X.bottom_and_top(rows, "total_spend", "user_id", 15), ["total_spend"], 4)


# --- F: scalar functions and the training feature table --------------------------------


@query("f1_f4_date_and_odds", """
SELECT order_id, CAST(year(order_date) AS INT) AS order_year,
       datesub('day', order_date, TIMESTAMP '2001-08-01 00:00:00') AS days_ago,
       order_date + INTERVAL 90 DAY AS plus_90, order_date - INTERVAL 90 DAY AS minus_90,
       round(exp(total_amount / 1000000), 6) AS odds
FROM s_orders""")
def f1_f4_date_and_odds(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("order_date")
    fixed = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    span = F.make_dt_interval(F.lit(90))
    return T.shop(spark, folder).orders.select(
        "order_id", F.year(at).alias("order_year"), E.elapsed_days(at, fixed).alias("days_ago"),
        (at + span).alias("plus_90"), (at - span).alias("minus_90"),
        F.round(F.exp(F.col("total_amount") / 1000000), 6).alias("odds"),
    )


@query("f5_f11_conditions", """
SELECT order_id, round(1 / (1 + exp(-(total_amount - 250000) / 100000)), 6) AS probability,
       round(abs(total_amount - 250000), 2) AS gap, upper(trim(status)) AS status_key,
       used_coupon_code IS NULL AS no_coupon,
       status IN ('F', 'O') AND total_amount BETWEEN 100000 AND 200000 AS in_range,
       CAST(used_coupon_code IS NOT NULL AS INT) AS coupon_flag,
       CASE WHEN total_amount > 250000 THEN 'high' ELSE 'low' END AS size_label
FROM s_orders""")
def f5_f11_conditions(spark: SparkSession, folder: str) -> DataFrame:
    amount, code = F.col("total_amount"), F.col("used_coupon_code")
    return T.shop(spark, folder).orders.select(
        "order_id",
        F.round(E.sigmoid((amount - 250000) / 100000), 6).alias("probability"),
        F.round(F.abs(amount - 250000), 2).alias("gap"),
        F.upper(F.btrim("status")).alias("status_key"),
        code.isNull().alias("no_coupon"),
        (F.col("status").isin("F", "O") & amount.between(100000, 200000)).alias("in_range"),
        code.isNotNull().cast("int").alias("coupon_flag"),
        F.when(amount > 250000, "high").otherwise("low").alias("size_label"),
    )


@query("f12_rate_text", """
SELECT user_id, printf('%.2f%%', share * 100) AS share_text,
       printf('%+.2fpp', (share - 0.5) * 100) AS points_text
FROM (SELECT user_id, count(*) FILTER (status = 'F')::DOUBLE / count(*) AS share
      FROM s_orders GROUP BY user_id)""")
def f12_rate_text(spark: SparkSession, folder: str) -> DataFrame:
    share = F.count_if(F.col("status") == "F").cast("double") / F.count(F.lit(1))
    return T.shop(spark, folder).orders.groupBy("user_id").agg(share.alias("share")).select(
        "user_id", E.percent_text(F.col("share")).alias("share_text"),
        E.signed_points_text((F.col("share") - 0.5) * 100).alias("points_text"),
    )


def _training_sql(p: str, horizon: int) -> str:
    ref = f"(SELECT ref - INTERVAL {horizon} DAY FROM {p}_clock)"
    past = f"order_date <= {ref}"

    def bin_of(order: str) -> str:
        rank = f"row_number() OVER (ORDER BY {order}, user_id)"
        return (
            f"greatest(1, (({rank} - 1) * 5 + count(*) OVER () - 2) // (count(*) OVER () - 1))"
        )

    return f"""
SELECT user_id, year({ref}) - year(birthdate) AS age, gender,
       datesub('day', created_at, {ref}) AS tenure_days,
       coalesce(num_interests, 0) AS num_interests,
       6 - {bin_of('recency_days')} AS recency_score, {bin_of('order_count')} AS frequency_score,
       {bin_of('total_spend')} AS monetary_score,
       CASE WHEN order_count > 0 THEN total_spend / order_count ELSE 0.0 END
         AS monetary_avg_order,
       CASE WHEN order_count > 0 THEN coalesce(units, 0) / order_count ELSE 0.0 END
         AS avg_items_per_order,
       n30 AS frequency_last_30d, n90 AS frequency_last_90d,
       avg_days_between_orders AS days_between_orders,
       CASE WHEN order_count > 0 THEN n_coupon::DOUBLE / order_count ELSE 0.0 END
         AS coupon_usage_rate,
       datesub('day', last_login, {ref}) AS days_since_last_session,
       coalesce(carts, 0) AS cart_additions_last_30d, churn
FROM (SELECT u.*, coalesce(order_count, 0) AS order_count, n_coupon, avg_days_between_orders,
             coalesce(total_spend, 0.0) AS total_spend, coalesce(n30, 0) AS n30,
             coalesce(n90, 0) AS n90,
             coalesce(datesub('day', last_at, {ref}), {horizon + 9999}) AS recency_days,
             CASE WHEN f.user_id IS NULL THEN 1 ELSE 0 END AS churn
      FROM {p}_users u
      LEFT JOIN (SELECT user_id, count(*) AS order_count, count(used_coupon_code) AS n_coupon,
                        {exact_sum('total_amount')} AS total_spend, max(order_date) AS last_at,
                        CAST(sum(gap) AS DOUBLE) / count(gap) AS avg_days_between_orders,
                        count(*) FILTER (order_date > {ref} - INTERVAL 30 DAY) AS n30,
                        count(*) FILTER (order_date > {ref} - INTERVAL 90 DAY) AS n90
                 FROM (SELECT *, datesub('day', lag(order_date) OVER (
                         PARTITION BY user_id ORDER BY order_date, order_id), order_date) AS gap
                       FROM {p}_orders WHERE {past}) GROUP BY user_id) USING (user_id)
      LEFT JOIN (SELECT DISTINCT user_id FROM {p}_orders WHERE order_date > {ref}
                 AND order_date <= {ref} + INTERVAL {horizon} DAY) f ON f.user_id = u.user_id)
LEFT JOIN (SELECT user_id, sum(quantity) AS units FROM {p}_items JOIN {p}_orders USING (order_id)
           WHERE {past} GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS num_interests FROM {p}_interests GROUP BY user_id)
  USING (user_id)
LEFT JOIN (SELECT user_id, max(login_at) AS last_login FROM {p}_logins WHERE login_at <= {ref}
           GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS carts FROM {p}_carts WHERE added_at <= {ref}
           AND added_at > {ref} - INTERVAL 30 DAY GROUP BY user_id) USING (user_id)"""


CTES["s_training"] = _training_sql("s", H)
TRAINING_WHOLE = ("age", "tenure_days", "num_interests", "recency_score", "frequency_score",
                  "monetary_score", "frequency_last_30d", "frequency_last_90d",
                  "days_since_last_session", "cart_additions_last_30d", "churn")
TRAINING_REAL = ("monetary_avg_order", "avg_items_per_order", "days_between_orders",
                 "coupon_usage_rate")


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.shop(spark, folder)
    ref = A.reference_date(tables) - timedelta(days=H)
    return N.training_features(tables, ref, H)


@query("f14_training_features", f"""
SELECT user_id, gender, {b(*TRAINING_WHOLE)}, {r6(*TRAINING_REAL)} FROM s_training""")
def f14_training_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = training_rows(spark, folder)
    return longs(rounded(rows, TRAINING_REAL), *TRAINING_WHOLE)
