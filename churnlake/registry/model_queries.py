"""Queries for tests (H), ML preparation (M), models (L) and evaluation (E)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.operators import activity as A
from churnlake.operators import cleaning as C
from churnlake.operators import cox
from churnlake.operators import evaluate as V
from churnlake.operators import hypothesis as Y
from churnlake.operators import mlprep as M
from churnlake.operators import models as L
from churnlake.operators import segment as G
from churnlake.operators.features import user_features
from churnlake.operators.moments import time_sums
from churnlake.registry import star_tables as T
from churnlake.registry.base import query, r6, rounded
from churnlake.registry.profile_queries import SEGMENT, SPLIT_SQL, assigned, training_rows
from churnlake.registry.sql import CTES, NUMERIC, exact_avg
from churnlake.registry.star_tables import EVENT_HORIZON_DAYS, HORIZON_DAYS
from churnlake.operators.silhouette import euclidean_silhouette
from churnlake.session import keep, stage

# --- H: hypothesis tests --------------------------------------------------------------


@query("h1_chi_square", """
SELECT variable, round(sum(greatest(abs(o - e) - CASE WHEN n_rows = 2 THEN 0.5 ELSE 0 END, 0) ** 2
         / e), 6) AS chi2, n_rows - 1 AS dof, n_rows, CAST(2 AS INT) AS n_columns
FROM (SELECT variable, n_rows, o,
             CAST(sum(o) OVER (PARTITION BY variable, level) AS DOUBLE)
             * sum(o) OVER (PARTITION BY variable, side) / sum(o) OVER (PARTITION BY variable)
               AS e
      FROM (SELECT variable, level, side, o, count(*) OVER (PARTITION BY variable, side) AS n_rows
            FROM (SELECT variable, level, side, count(*) FILTER (churn = side) AS o
                  FROM long_levels CROSS JOIN (VALUES (0), (1)) AS v(side)
                  WHERE level IS NOT NULL GROUP BY variable, level, side)))
GROUP BY variable, n_rows HAVING n_rows > 1""")
def h1_chi_square(spark: SparkSession, folder: str) -> DataFrame:
    table = Y.chi_square(T.shop_features(spark, folder), S.CATEGORICAL_PROFILE)
    return rounded(table.drop("p_value"), ["chi2"])


@query("h2_welch", """
SELECT variable, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t,
       round((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)), 4)
         AS dof, round(ma, 4) AS mean_active, round(mb, 4) AS mean_churned
FROM (SELECT variable, count(value) FILTER (churn = 0) AS na, count(value) FILTER (churn = 1) AS nb,
             avg(value) FILTER (churn = 0) AS ma, avg(value) FILTER (churn = 1) AS mb,
             var_samp(value) FILTER (churn = 0) AS va, var_samp(value) FILTER (churn = 1) AS vb
      FROM long_numeric GROUP BY variable) WHERE na > 1 AND nb > 1""")
def h2_welch(spark: SparkSession, folder: str) -> DataFrame:
    table = Y.welch(T.scored_features(spark, folder), list(NUMERIC)).drop("p_value")
    return rounded(rounded(table, ["t"]), ["dof", "mean_active", "mean_churned"], 4)


@query("h3_mann_whitney", """
SELECT variable, r1 - n1 * (n1 + 1) / 2 AS u,
       round((greatest(r1 - n1 * (n1 + 1) / 2, n1 * n2 - (r1 - n1 * (n1 + 1) / 2))
              - n1 * n2 / 2 - 0.5)
             / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z,
       CAST(n1 AS BIGINT) AS n_active, CAST(n2 AS BIGINT) AS n_churned,
       round(med_a, 4) AS median_active, round(med_b, 4) AS median_churned
FROM (SELECT variable, CAST(sum(a) AS DOUBLE) AS n1, CAST(sum(t) - sum(a) AS DOUBLE) AS n2,
             sum(a * (upto - (t - 1) / 2.0)::DOUBLE) AS r1,
             sum(t::DOUBLE ** 3 - t) AS ties
      FROM (SELECT variable, value, a, t, sum(t) OVER (PARTITION BY variable ORDER BY value) AS upto
            FROM (SELECT variable, value, count(*) FILTER (churn = 0) AS a, count(*) AS t
                  FROM long_numeric WHERE value IS NOT NULL GROUP BY variable, value))
      GROUP BY variable)
JOIN (SELECT variable, median(value) FILTER (churn = 0) AS med_a,
             median(value) FILTER (churn = 1) AS med_b FROM long_numeric GROUP BY variable)
  USING (variable)""")
def h3_mann_whitney(spark: SparkSession, folder: str) -> DataFrame:
    table = Y.mann_whitney(T.scored_features(spark, folder), list(NUMERIC)).drop("p_value")
    return rounded(rounded(table, ["z"]), ["median_active", "median_churned"], 4)


@query("h_p_values")
def h_p_values(spark: SparkSession, folder: str) -> DataFrame:
    features = T.scored_features(spark, folder)
    numeric = list(NUMERIC)
    tables = {
        "chi_square": Y.chi_square(features, S.CATEGORICAL_PROFILE),
        "welch": Y.welch(features, numeric), "mann_whitney": Y.mann_whitney(features, numeric),
    }
    parts = [t.select(F.lit(n).alias("test"), "variable", "p_value") for n, t in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- M: preparation --------------------------------------------------------------------


@query("m1_hash_split", f"""
SELECT user_id, {SPLIT_SQL.format(share=0.2)} AS split FROM s_features""")
def m1_hash_split(spark: SparkSession, folder: str) -> DataFrame:
    users = T.shop(spark, folder).users.select("user_id", F.lit(0).alias("churn"))
    return M.split(users, "user_id", "churn", 0.2).select("user_id", "split")


@query("m1_exact_split", """
SELECT user_id, CASE WHEN place <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT user_id, row_number() OVER (PARTITION BY churn ORDER BY h) AS place,
             count(*) OVER (PARTITION BY churn) AS n
      FROM (SELECT user_id, churn,
                   CAST(('0x' || substr(md5(concat(user_id, ':42')), 1, 13)) AS BIGINT) AS h
            FROM s_features))""")
def m1_exact_split(spark: SparkSession, folder: str) -> DataFrame:
    marked = M.split(T.shop_features(spark, folder), "user_id", "churn", 0.2, exact=True)
    return marked.select("user_id", "split")


@query("m2_standardise", f"""
SELECT user_id, {', '.join(f'round(z{i + 1}, 6) AS {c}' for i, c in enumerate(SEGMENT))}
FROM seg_scaled""")
def m2_standardise(spark: SparkSession, folder: str) -> DataFrame:
    features = T.shop_features(spark, folder)
    scaled = M.fit_scaler(features, SEGMENT).apply(features.select("user_id", *SEGMENT))
    return rounded(scaled, SEGMENT)


@query("m3_one_hot", """
SELECT user_id, CASE WHEN gender = 'MALE' THEN 1.0::DOUBLE ELSE 0.0 END AS gender_MALE,
       CASE WHEN age_group = '25-34' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_25-34",
       CASE WHEN age_group = '35-44' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_35-44",
       CASE WHEN age_group = '45+' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_45+",
       CASE WHEN age_group = '<25' THEN 1.0::DOUBLE ELSE 0.0 END AS "age_group_<25",
       CASE WHEN used_coupon THEN 1.0::DOUBLE ELSE 0.0 END AS used_coupon_True
FROM s_features""")
def m3_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows = T.shop_features(spark, folder).select("user_id", *S.CATEGORICAL_PROFILE)
    known = M.levels(rows, S.CATEGORICAL_PROFILE)
    return M.one_hot(rows, known)[0].drop(*S.CATEGORICAL_PROFILE)


@query("m4_balanced_weights", """
SELECT CAST(churn AS INT) AS churn, count(*) AS n,
       round((SELECT count(*) FROM s_features)::DOUBLE
             / (count(*) * (SELECT count(DISTINCT churn) FROM s_features)), 6) AS weight
FROM s_features GROUP BY churn""")
def m4_balanced_weights(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(M.balanced_weights(T.shop_features(spark, folder), "churn"), ["weight"])


@query("m5_median_impute", """
SELECT user_id, round(coalesce(avg_days_between_orders,
         (SELECT median(avg_days_between_orders) FROM e_features)), 6) AS avg_days_between_orders
FROM e_features""")
def m5_median_impute(spark: SparkSession, folder: str) -> DataFrame:
    rows = T.event_features(spark, folder).select("user_id", "avg_days_between_orders")
    filled = M.impute_medians(rows, ["avg_days_between_orders"])
    return rounded(filled, ["avg_days_between_orders"])


@query("m6_seeded_sample", """
SELECT user_id, created_at FROM s_users
ORDER BY CAST(('0x' || substr(md5(concat(user_id, ':42')), 1, 13)) AS BIGINT), user_id LIMIT 800""")
def m6_seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    users = T.shop(spark, folder).users.select("user_id", "created_at")
    return M.seeded_sample(users, "user_id", 800)


@query("m7_model_input", f"""
SELECT user_id, CAST(churn AS INT) AS churn,
       {', '.join(f'round(coalesce(CAST({c} AS DOUBLE), 0.0), 6) AS {c}'
                  for c in S.TRAINING_NUMERIC if c != 'gender_bin')},
       CASE WHEN gender = 'MALE' THEN 1.0::DOUBLE ELSE 0.0 END AS gender_bin
FROM s_training""")
def m7_model_input(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.model_input(training_rows(spark, folder)).drop("gender")
    return rounded(rows, S.TRAINING_NUMERIC)


# --- L: models ---------------------------------------------------------------------------

Specs = dict[str, L.Spec]


def fitted_drivers(spark: SparkSession, folder: str, *names: str,
                   specs: Specs = L.DRIVER_MODELS) -> L.Fitted:
    prepared, design = L.driver_design(T.shop_features(spark, folder))
    return L.fit_models(
        stage(prepared, "prepared"), design, {n: specs[n] for n in names}, "user_id"
    )


def fitted_training(spark: SparkSession, folder: str,
                    specs: Specs = L.TRAINING_MODELS) -> L.Fitted:
    rows = stage(C.model_input(training_rows(spark, folder)), "model-input")
    prepared, design = L.training_design(rows)
    return L.fit_models(
        stage(prepared, "prepared"), design, specs, "user_id", carry=["age", "gender_bin"]
    )


@query("l1_logistic_scores")
def l1_logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return fitted_drivers(spark, folder, "logistic").scores


def _zeros(key: str, names: Sequence[str], value: str) -> str:
    return f"SELECT unnest({list(names)}) AS {key}, CAST(0 AS DOUBLE) AS {value}"


DRIVER_COLUMNS = [*S.DRIVER_NUMERIC, "gender_MALE", "age_group_25-34", "age_group_35-44",
                  "age_group_45+", "age_group_<25", "used_coupon_True"]


@query("l1_gradient", _zeros("feature", DRIVER_COLUMNS, "gradient"))
def l1_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """Zero slope of the penalised loss: the fit is the minimum."""
    prepared, design = L.driver_design(T.shop_features(spark, folder))
    rows, spec = stage(prepared, "prepared"), L.DRIVER_MODELS["logistic"]
    fitted = L.fit_models(rows, design, {"logistic": spec}, "user_id")
    slopes = L.logistic_gradient(fitted, rows.where("split = 'train'"), spec)
    return slopes.select("feature", F.round(F.abs("gradient"), 3).alias("gradient"))


@query("l2_coefficients")
def l2_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    table = L.coefficients(fitted_drivers(spark, folder, "logistic"))
    return table.orderBy(F.col("coef").desc(), "feature")


@query("l3_forest_scores")
def l3_forest_scores(spark: SparkSession, folder: str,
                     specs: Specs = L.DRIVER_MODELS) -> DataFrame:
    return fitted_drivers(spark, folder, "rf", specs=specs).scores


@query("l4_boosting_scores")
def l4_boosting_scores(spark: SparkSession, folder: str,
                       specs: Specs = L.DRIVER_MODELS) -> DataFrame:
    return fitted_drivers(spark, folder, "gbt", specs=specs).scores


@query("l5_feature_importance")
def l5_feature_importance(spark: SparkSession, folder: str,
                          specs: Specs = L.DRIVER_MODELS) -> DataFrame:
    return L.top_importances(fitted_drivers(spark, folder, "rf", specs=specs), "rf")


LAST = "greatest(last_purchase_date, last_login_at, last_cart_at)"


def _cox_sql(p: str) -> str:
    gap = "avg_days_between_orders"
    return f"""
SELECT user_id, CAST(greatest(1, coalesce(datesub('day', created_at, least({LAST}, threshold)), 1))
         AS INT) AS duration,
       CAST(CASE WHEN {LAST} IS NULL OR {LAST} < threshold THEN 1 ELSE 0 END AS INT) AS event,
       {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in
                  ('order_count', 'login_count', 'cart_count', 'category_diversity', 'age'))},
       {r6('total_spend', 'avg_order_value', 'avg_cart_per_login')},
       round(coalesce({gap}, (SELECT median({gap}) FROM {p}_features)), 6) AS {gap},
       CASE WHEN gender = 'MALE' THEN 1.0::DOUBLE ELSE 0.0 END AS gender_MALE,
       CASE WHEN used_coupon THEN 1.0::DOUBLE ELSE 0.0 END AS used_coupon
FROM {p}_features, {p}_clock"""


COX_REAL = ["total_spend", "avg_order_value", "avg_cart_per_login", "avg_days_between_orders"]


@query("l6_cox_frame", _cox_sql("s"))
def l6_cox_frame(spark: SparkSession, folder: str) -> DataFrame:
    ref = T.shop_ref(spark, folder)
    rows, _ = cox.cox_frame(T.shop_features(spark, folder), ref, HORIZON_DAYS)
    return rounded(rows, COX_REAL)


@query("l6_cox_frame_events", _cox_sql("e"))
def l6_cox_frame_events(spark: SparkSession, folder: str) -> DataFrame:
    tables = T.event_shop(spark, folder)
    ref = A.reference_date(tables)
    features = keep(user_features(tables, ref, horizon_days=EVENT_HORIZON_DAYS))
    rows, _ = cox.cox_frame(features, ref, EVENT_HORIZON_DAYS)
    return rounded(rows, COX_REAL)


COX_COUNTS = ["order_count", "login_count", "age"]


@query("l6_duration_sums", f"""
SELECT CAST(duration AS BIGINT) AS duration, CAST(event AS BIGINT) AS event, count(*) AS n,
       {', '.join(f'sum({c}) AS x{i}' for i, c in enumerate(COX_COUNTS))},
       count(*)::DOUBLE AS w, {', '.join(f'sum({c}) AS wx{i}' for i, c in enumerate(COX_COUNTS))},
       {', '.join(f'sum({a} * {b}) AS wx{i}_{j}' for i, a in enumerate(COX_COUNTS)
                  for j, b in enumerate(COX_COUNTS) if j >= i)}
FROM ({_cox_sql("s")}) GROUP BY duration, event""")
def l6_duration_sums(spark: SparkSession, folder: str) -> DataFrame:
    """What the first Newton step adds up, with plain covariates (mean 0, scale 1)."""
    ref = T.shop_ref(spark, folder)
    rows, _ = cox.cox_frame(T.shop_features(spark, folder), ref, HORIZON_DAYS)
    return time_sums(rows, "duration", "event", COX_COUNTS, [0.0] * 3, [1.0] * 3, [0.0] * 3)


@query("l6_cox_model")
def l6_cox_model(spark: SparkSession, folder: str) -> DataFrame:
    ref = T.shop_ref(spark, folder)
    rows, covariates = cox.cox_frame(T.shop_features(spark, folder), ref, HORIZON_DAYS)
    return cox.cox_fit(rows, covariates)


@query("l6_gradient", _zeros("covariate", [*S.DRIVER_NUMERIC, "gender_MALE", "used_coupon"],
                             "gradient"))
def l6_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """Zero slope of the partial likelihood: the fit is the maximum."""
    ref = T.shop_ref(spark, folder)
    frame, covariates = cox.cox_frame(T.shop_features(spark, folder), ref, HORIZON_DAYS)
    rows = stage(frame, "cox-frame")
    slopes = cox.cox_gradient(rows, cox.cox_fit(rows, covariates))
    return slopes.select("covariate", F.round(F.abs("gradient"), 4).alias("gradient"))


def segment_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return keep(G.scaled_vectors(T.shop_features(spark, folder), SEGMENT))


@query("l7_kmeans")
def l7_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = G.kmeans(segment_vectors(spark, folder), 4)
    return rows.select("user_id", "kmeans_cluster")


@query("l7_centres", f"""
SELECT CAST(unnest(range(4)) AS INT) AS cluster, CAST(0 AS DOUBLE) AS gap, count(*) AS total
FROM s_features""")
def l7_centres(spark: SparkSession, folder: str) -> DataFrame:
    """Centres are the means of their members, and the members are all rows."""
    rows, model = G.kmeans(segment_vectors(spark, folder), 4)
    gaps = G.centre_gaps(rows, model, "kmeans_cluster")
    every = Window.partitionBy(F.lit(0))     # one line per cluster
    return gaps.select("cluster", F.round("gap", 3).alias("gap"),
                       F.sum("n").over(every).alias("total"))


@query("l7_nearest_centre", "SELECT user_id, CAST(cluster AS INT) AS cluster FROM seg_assigned")
def l7_nearest_centre(spark: SparkSession, folder: str) -> DataFrame:
    return assigned(spark, folder).select("user_id", "cluster")


@query("l8_silhouette", """
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0
                      ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n
FROM (SELECT user_id, max(d) FILTER (cluster = other) AS a,
             min(d) FILTER (cluster <> other) AS b
      FROM (SELECT r.user_id, r.cluster, p.cluster AS other,
                   avg((r.z1 - p.z1) ** 2 + (r.z2 - p.z2) ** 2 + (r.z3 - p.z3) ** 2
                       + (r.z4 - p.z4) ** 2) FILTER (r.user_id <> p.user_id) AS d
            FROM seg_assigned r CROSS JOIN seg_assigned p
            GROUP BY r.user_id, r.cluster, p.cluster)
      GROUP BY user_id)""")
def l8_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """All rows against all rows, in linear time."""
    rows = stage(assigned(spark, folder).select("cluster", "features"), "assigned")
    return rounded(G.silhouette(rows, "cluster"), ["silhouette"])


@query("l8_euclidean_silhouette", """
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0
                      ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS n
FROM (SELECT user_id, max(d) FILTER (cluster = other) AS a,
             min(d) FILTER (cluster <> other) AS b
      FROM (SELECT r.user_id, r.cluster, p.cluster AS other,
                   avg(sqrt((r.z1 - p.z1) ** 2 + (r.z2 - p.z2) ** 2 + (r.z3 - p.z3) ** 2
                            + (r.z4 - p.z4) ** 2)) FILTER (r.user_id <> p.user_id) AS d
            FROM seg_assigned r CROSS JOIN seg_assigned p
            GROUP BY r.user_id, r.cluster, p.cluster)
      GROUP BY user_id)""")
def l8_euclidean_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    """All rows against cells of rows; equal to all pairs while the distinct points are cells."""
    rows = euclidean_silhouette(assigned(spark, folder).select("cluster", "features"), "cluster")
    return rounded(rows.select("silhouette", "n"), ["silhouette"])


@query("l8_silhouette_by_k")
def l8_silhouette_by_k(spark: SparkSession, folder: str) -> DataFrame:
    return G.silhouettes_by_k(segment_vectors(spark, folder))


@query("l9_ward_groups")
def l9_ward_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = G.ward(segment_vectors(spark, folder), 4)
    return rows.select("user_id", "hclust_cluster")


@query("l10_merge_table")
def l10_merge_table(spark: SparkSession, folder: str) -> DataFrame:
    """Ward's merges of the cells that all rows are folded into."""
    return G.ward(segment_vectors(spark, folder))[1]


@query("l11_pca")
def l11_pca(spark: SparkSession, folder: str) -> DataFrame:
    return G.pca_coordinates(segment_vectors(spark, folder))[0]


@query("l11_covariance", "\nUNION ALL\n".join(
    f"SELECT {i} AS i, {j} AS j, round(coalesce(covar_samp(z{i + 1}, z{j + 1}), 0) "
    "/ (var_samp(z1) + var_samp(z2) + var_samp(z3) + var_samp(z4)), 6) AS share "
    "FROM seg_scaled" for i in range(4) for j in range(4)))
def l11_covariance(spark: SparkSession, folder: str) -> DataFrame:
    """All components' loadings and shares rebuild the covariance, as shares of all variance."""
    table = G.pca_coordinates(segment_vectors(spark, folder), 4)[1]
    left = table.select("component", F.col("feature").alias("i"),
                        (F.col("loading") * F.col("explained")).alias("a"))
    right = table.select("component", F.col("feature").alias("j"), F.col("loading").alias("b"))
    share = F.round(F.sum(F.col("a") * F.col("b")), 6) + F.lit(0.0)
    return left.join(right, "component").groupBy("i", "j").agg(share.alias("share"))


@query("l12_multi_model")
def l12_multi_model(spark: SparkSession, folder: str,
                    specs: Specs = L.TRAINING_MODELS) -> DataFrame:
    scores = keep(fitted_training(spark, folder, specs).scores)
    return V.compare_models(scores)


# --- E: evaluation ------------------------------------------------------------------------

MODEL = ["model"]
COUNTS_AT = """count(*) FILTER (score >= {t} AND label = 1) AS tp,
       count(*) FILTER (score >= {t} AND label = 0) AS fp,
       count(*) FILTER (score < {t} AND label = 0) AS tn,
       count(*) FILTER (score < {t} AND label = 1) AS fn"""

# Metrics over columns tp, fp, tn, fn; 0 where a denominator is 0.
METRIC_SQL = """
       coalesce((tp + tn)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0) AS accuracy,
       (coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)
        + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
       coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
       coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn)
                / nullif(sqrt(tp + fp::DOUBLE) * sqrt(tp + fn::DOUBLE) * sqrt(tn + fp::DOUBLE)
                         * sqrt(tn + fn::DOUBLE), 0), 0) AS mcc,
       coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS tpr,
       coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS tnr,
       coalesce(fp::DOUBLE / nullif(tn + fp, 0), 0) AS fpr,
       coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)
         - coalesce(fp::DOUBLE / nullif(tn + fp, 0), 0) AS youden_j,
       coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
       coalesce((tp + fp)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0) AS pred_rate,
       coalesce((tp + fn)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0) AS actual_rate,
       (coalesce((tp + fp)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0)
        - coalesce((tp + fn)::DOUBLE / nullif(tp + fp + tn + fn, 0), 0)) * 100 AS rate_diff_pp"""

CTES["at_half"] = f"SELECT model, {COUNTS_AT.format(t=0.5)} FROM scores GROUP BY model"
CTES["half_metrics"] = f"SELECT *, {METRIC_SQL} FROM at_half"
CTES["auc_by_model"] = """
SELECT model, sum(CASE WHEN label = 1 THEN place END) AS rank_sum,
       (sum(CASE WHEN label = 1 THEN place END)
        - count(*) FILTER (label = 1)::DOUBLE * (count(*) FILTER (label = 1) + 1) / 2)
       / (count(*) FILTER (label = 1)::DOUBLE * count(*) FILTER (label = 0)) AS roc_auc
FROM (SELECT model, label, (rank() OVER (PARTITION BY model ORDER BY score)
        + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0)::DOUBLE AS place FROM scores)
GROUP BY model"""


def _sweep(lo: float, hi: float, steps: int) -> str:
    return f"""
SELECT model, threshold, {COUNTS_AT.format(t='threshold')}
FROM scores CROSS JOIN (SELECT i * (({hi}::DOUBLE - {lo}::DOUBLE) / {steps - 1}) + {lo}::DOUBLE
                          AS threshold FROM (SELECT unnest(range({steps})) AS i))
GROUP BY model, threshold"""


CTES["full_sweep"] = f"SELECT *, {METRIC_SQL} FROM ({_sweep(0.0, 1.0, 2001)})"
CTES["train_sweep"] = f"SELECT *, {METRIC_SQL} FROM ({_sweep(0.05, 0.95, 181)})"


def _metrics(names: tuple[str, ...]) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


@query("e1_confusion", "SELECT * FROM at_half")
def e1_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return V.confusion(T.model_scores(spark, folder), 0.5, MODEL)


@query("e2_metric_set", f"""
SELECT model, tp, fp, tn, fn, CAST(0.5 AS DOUBLE) AS threshold, {_metrics(V.DRIVER_METRICS)}
FROM half_metrics""")
def e2_metric_set(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(V.metrics_at(T.model_scores(spark, folder), 0.5, MODEL), V.DRIVER_METRICS)


@query("e3_metric_set_with_rates", f"""
SELECT model, tp, fp, tn, fn, CAST(0.5 AS DOUBLE) AS threshold, round(roc_auc, 6) AS roc_auc,
       {_metrics(V.TRAIN_METRICS)} FROM half_metrics JOIN auc_by_model USING (model)""")
def e3_metric_set_with_rates(spark: SparkSession, folder: str) -> DataFrame:
    table = V.full_metrics(T.model_scores(spark, folder), 0.5, MODEL)
    return rounded(table, [*V.TRAIN_METRICS, "roc_auc"])


@query("e4_threshold_sweep", f"""
SELECT model, round(threshold, 6) AS threshold, tp, fp, tn, fn, {_metrics(V.DRIVER_METRICS)}
FROM full_sweep""")
def e4_threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    sweep = V.threshold_sweep(T.model_scores(spark, folder), S.FULL_GRID, MODEL)
    return rounded(sweep, ["threshold", *V.DRIVER_METRICS])


@query("e5_threshold_sweep_training", f"""
SELECT model, round(threshold, 6) AS threshold, tp, fp, tn, fn, {_metrics(V.TRAIN_METRICS)}
FROM train_sweep""")
def e5_threshold_sweep_training(spark: SparkSession, folder: str) -> DataFrame:
    scores = T.model_scores(spark, folder)
    sweep = V.threshold_sweep(scores, S.TRAIN_GRID, MODEL, V.TRAIN_METRICS)
    return rounded(sweep, ["threshold", *V.TRAIN_METRICS])


def _best(source: str, criteria: tuple[str, ...]) -> str:
    picks = [
        f"SELECT *, '{c}' AS criterion FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY model ORDER BY {c} DESC, threshold) = 1" for c in criteria
    ]
    picks.append(
        f"SELECT *, 'default' AS criterion FROM {source} QUALIFY row_number() OVER "
        "(PARTITION BY model ORDER BY abs(threshold - 0.5), threshold) = 1"
    )
    return " UNION ALL ".join(f"({p})" for p in picks)


@query("e6_best_thresholds", f"""
SELECT model, criterion, round(threshold, 6) AS threshold, tp, fp, tn, fn,
       {_metrics(V.DRIVER_METRICS)}
FROM ({_best('full_sweep', ('balanced_accuracy', 'youden_j', 'mcc', 'f1', 'accuracy'))})""")
def e6_best_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    sweep = V.threshold_sweep(T.model_scores(spark, folder), S.FULL_GRID, MODEL)
    return rounded(V.best_thresholds(sweep, MODEL), ["threshold", *V.DRIVER_METRICS])


@query("e7_threshold_summary", f"""
SELECT model, criterion, round(threshold, 4) AS threshold, tp, fp, tn, fn,
       {', '.join(f'round({c}, 3) AS {c}' for c in ('accuracy', 'balanced_accuracy', 'f1', 'mcc', 'tpr', 'tnr'))},
       printf('%.2f%%', pred_rate * 100) AS pred_rate,
       printf('%.2f%%', actual_rate * 100) AS actual_rate,
       printf('%+.2fpp', rate_diff_pp) AS difference
FROM ({_best('train_sweep', ('balanced_accuracy', 'mcc', 'accuracy'))})""")
def e7_threshold_summary(spark: SparkSession, folder: str) -> DataFrame:
    return V.threshold_summary(T.model_scores(spark, folder), MODEL)


CTES["score_steps"] = """
SELECT model, score, sum(sum(label)) OVER down AS tp, sum(count(*) - sum(label)) OVER down AS fp,
       sum(sum(label)) OVER whole AS p, sum(count(*) - sum(label)) OVER whole AS n,
       sum(label) AS hits
FROM scores GROUP BY model, score
WINDOW down AS (PARTITION BY model ORDER BY score DESC), whole AS (PARTITION BY model)"""


@query("e8_roc_points", """
SELECT model, score AS threshold, round(fp::DOUBLE / n, 6) AS fpr, round(tp::DOUBLE / p, 6) AS tpr
FROM score_steps
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scores""")
def e8_roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(V.roc_points(T.model_scores(spark, folder), MODEL), ["fpr", "tpr"])


@query("e8_roc_points_grid", """
SELECT model, threshold, round(sum(sum(1 - label)) OVER down / sum(sum(1 - label)) OVER whole, 6)
         AS fpr, round(sum(sum(label)) OVER down / sum(sum(label)) OVER whole, 6) AS tpr
FROM (SELECT model, CAST(label AS DOUBLE) AS label, floor(score * 100) / 100 AS threshold
      FROM scores) GROUP BY model, threshold
WINDOW down AS (PARTITION BY model ORDER BY threshold DESC), whole AS (PARTITION BY model)
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM scores""")
def e8_roc_points_grid(spark: SparkSession, folder: str) -> DataFrame:
    points = V.roc_points(T.model_scores(spark, folder), MODEL, grid=100)
    return rounded(points, ["fpr", "tpr"])


@query("e9_pr_points", """
SELECT model, score AS threshold, round(tp::DOUBLE / p, 6) AS recall,
       round(tp::DOUBLE / (tp + fp), 6) AS precision FROM score_steps
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE FROM scores""")
def e9_pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(V.pr_points(T.model_scores(spark, folder), MODEL), ["recall", "precision"])


@query("e10_roc_auc", "SELECT model, round(roc_auc, 8) AS roc_auc FROM auc_by_model")
def e10_roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(V.auc(T.model_scores(spark, folder), MODEL), ["roc_auc"], 8)


@query("e11_average_precision", """
SELECT model, round(sum(hits::DOUBLE * tp / (tp + fp)) / any_value(p), 8) AS average_precision
FROM score_steps GROUP BY model""")
def e11_average_precision(spark: SparkSession, folder: str) -> DataFrame:
    table = V.average_precision(T.model_scores(spark, folder), MODEL)
    return rounded(table, ["average_precision"], 8)


@query("e12_brier", f"""
SELECT model, {exact_avg('(score - label) * (score - label)')} AS brier FROM scores
GROUP BY model""")
def e12_brier(spark: SparkSession, folder: str) -> DataFrame:
    return V.brier(T.model_scores(spark, folder), MODEL)


@query("e13_reliability", f"""
SELECT model, CAST(bin AS INT) AS bin, {exact_avg('score')} AS mean_score,
       avg(label) AS positive_share, count(score) AS n
FROM (SELECT DISTINCT model FROM scores) CROSS JOIN (SELECT unnest(range(10)) AS bin)
LEFT JOIN (SELECT model, score, label, bin FROM scores
           JOIN (SELECT unnest(range(10)) AS bin)
             ON score >= bin * 0.1::DOUBLE AND score < (bin + 1) * 0.1::DOUBLE)
  USING (model, bin) GROUP BY model, bin""")
def e13_reliability(spark: SparkSession, folder: str) -> DataFrame:
    return V.reliability(T.model_scores(spark, folder), 10, MODEL)


CTES["cohort_scores"] = """
SELECT model, label, score FROM scores JOIN s_features ON user_id = o_custkey
WHERE age BETWEEN 20 AND 34 AND gender = 'MALE'"""


@query("e14_segment_metrics", f"""
SELECT model, tp, fp, tn, fn, CAST(0.5 AS DOUBLE) AS threshold, round(roc_auc, 6) AS roc_auc,
       {_metrics(V.TRAIN_METRICS)}
FROM (SELECT *, {METRIC_SQL} FROM (
  SELECT model, {COUNTS_AT.format(t=0.5)} FROM cohort_scores GROUP BY model))
JOIN (SELECT model, (sum(CASE WHEN label = 1 THEN place END)
        - count(*) FILTER (label = 1)::DOUBLE * (count(*) FILTER (label = 1) + 1) / 2)
       / (count(*) FILTER (label = 1)::DOUBLE * count(*) FILTER (label = 0)) AS roc_auc
      FROM (SELECT model, label, (rank() OVER (PARTITION BY model ORDER BY score)
              + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0)::DOUBLE AS place
            FROM cohort_scores) GROUP BY model) USING (model)""")
def e14_segment_metrics(spark: SparkSession, folder: str) -> DataFrame:
    year = T.shop_ref(spark, folder).year
    users = T.shop(spark, folder).users.select(
        F.col("user_id").alias("o_custkey"),
        E.age_in(F.col("birthdate"), year).alias("age"),
        E.gender_bin(F.col("gender")).alias("gender_bin"),
    )
    rows = T.model_scores(spark, folder).join(users, "o_custkey")
    return rounded(V.segment_metrics(rows, by=MODEL), [*V.TRAIN_METRICS, "roc_auc"])


@query("e15_model_comparison", f"""
SELECT model, round(roc_auc, 6) AS roc_auc,
       {_metrics(('accuracy', 'f1', 'tpr', 'tnr', 'pred_rate', 'actual_rate'))},
       brier
FROM half_metrics JOIN auc_by_model USING (model)
JOIN (SELECT model, {exact_avg('(score - label) * (score - label)')} AS brier FROM scores GROUP BY model)
  USING (model)""")
def e15_model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    table = V.compare_models(T.model_scores(spark, folder))
    columns = ["roc_auc", "accuracy", "f1", "tpr", "tnr", "pred_rate", "actual_rate"]
    return rounded(table, columns).orderBy(F.col("roc_auc").desc(), "model")


@query("e16_pr_marker", f"""
SELECT model, CAST(0.62 AS DOUBLE) AS threshold,
       round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall
FROM (SELECT model, {COUNTS_AT.format(t='0.62::DOUBLE')} FROM scores GROUP BY model)""")
def e16_pr_marker(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(V.pr_marker(T.model_scores(spark, folder), 0.62, MODEL),
                   ["precision", "recall"])


CTES["picked"] = """
SELECT model, criterion, threshold FROM (SELECT DISTINCT model FROM scores)
CROSS JOIN (VALUES ('low', 0.25::DOUBLE), ('high', 0.75::DOUBLE), ('none', 2.0::DOUBLE))
  AS v(criterion, threshold)"""


@query("e16_pr_markers", """
SELECT model, criterion, threshold,
       coalesce(count(*) FILTER (score >= threshold AND label = 1)::DOUBLE
                / nullif(count(*) FILTER (score >= threshold), 0), 0) AS precision,
       coalesce(count(*) FILTER (score >= threshold AND label = 1)::DOUBLE
                / nullif(count(*) FILTER (label = 1), 0), 0) AS recall
FROM scores JOIN picked USING (model) GROUP BY model, criterion, threshold""")
def e16_pr_markers(spark: SparkSession, folder: str) -> DataFrame:
    scores = T.model_scores(spark, folder)
    marks = F.array(*[F.struct(F.lit(c).alias("criterion"), F.lit(t).alias("threshold"))
                      for c, t in (("low", 0.25), ("high", 0.75), ("none", 2.0))])
    picks = scores.select("model").distinct().select("model", F.inline(marks))
    return V.pr_markers(scores, picks, MODEL)


WIDE_GRID = (-0.25, 1.25, 13)     # eighths, beyond both ends


@query("f13_clipped_grid", f"""
SELECT model, threshold, {COUNTS_AT.format(t='threshold')}
FROM scores CROSS JOIN (SELECT DISTINCT least(greatest(-0.25::DOUBLE + i * 0.125::DOUBLE, 0), 1)
                          AS threshold FROM (SELECT unnest(range(13)) AS i))
GROUP BY model, threshold""")
def f13_clipped_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Counts at every point of a grid that is clipped to [0, 1], each point once."""
    return V.threshold_sweep(T.model_scores(spark, folder), WIDE_GRID, MODEL, ())
