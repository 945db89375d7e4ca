"""The product's end-to-end jobs: each reads shop tables and writes its result tables.

The heavy scans and folds over the fact tables run once per job: their one-row-per-user
result is written to the job's output folder, and everything after reads that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.operators import activity as A
from churnlake.operators import cleaning as C
from churnlake.operators import cox
from churnlake.operators import evaluate as V
from churnlake.operators import explore as X
from churnlake.operators import hypothesis as H
from churnlake.operators import models as L
from churnlake.operators import ranking as R
from churnlake.operators import segment as G
from churnlake.operators.features import user_features
from churnlake.operators.snapshot import cohort, snapshots, training_features
from churnlake.session import kept
from churnlake.sources.tables import ShopTables, read_partitions, write_partitions, write_table


def _stage(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def _write_all(results: dict[str, DataFrame], out: str) -> dict[str, str]:
    paths = {}
    for name, df in results.items():
        paths[name] = f"{out}/{name}"
        write_table(df, paths[name])
    return paths


def feature_table(tables: ShopTables, out: str, ref: datetime | None = None,
                  horizon_days: int = S.CHURN_DAYS) -> tuple[DataFrame, datetime]:
    """User features with RFM scores, written once and read back."""
    ref = ref or A.reference_date(tables)
    base = _stage(user_features(tables, ref, horizon_days=horizon_days), f"{out}/user_activity")
    return _stage(R.rfm_scores(base), f"{out}/user_features"), ref


def exploration(tables: ShopTables, out: str, ref: datetime | None = None,
                horizon_days: int = S.CHURN_DAYS,
                extra_categories: Sequence[str] = ()) -> dict[str, str]:
    """Shapes, statistics, rates, tests and chart data of the exploratory report."""
    features, _ = feature_table(tables, out, ref, horizon_days)
    numeric = list(S.NUMERIC_PROFILE)
    categories = [*S.CATEGORICAL_PROFILE, *extra_categories]
    with kept(features) as f:
        return _write_all({
            "table_shapes": X.table_shapes(tables),
            "overall_rate": X.overall_rate(f),
            "describe": X.describe(f, numeric),
            "missing": X.missing(f, [*numeric, *categories, "churn"]),
            "outliers": X.outliers(f, numeric),
            "rate_by_gender": X.group_rate(f, "gender"),
            "rate_by_age_group": X.group_rate(f, "age_group", labels=S.AGE_LABELS),
            "rate_by_coupon": X.group_rate(f, "used_coupon"),
            "rate_by_rfm": X.group_rate(f, "RFM_bucket", labels=S.RFM_LABELS),
            "chi_square": H.chi_square(f, categories),
            "welch": H.welch(f, numeric),
            "mann_whitney": H.mann_whitney(f, numeric),
            "correlations": X.correlations(f, numeric),
            "histograms": X.histogram(f, numeric),
            "value_counts": X.value_counts(f, categories),
            "box_by_churn": X.box_summary(f, S.BOX_VARIABLES),
        }, out)


def snapshot_build(tables: ShopTables, out: str, latest: datetime | None = None,
                   horizon_days: int = S.CHURN_DAYS) -> dict[str, str]:
    """Train and test snapshots two and one horizons before the end, and their summary.

    Snapshots of other dates that the folder already holds stay.
    """
    latest = latest or A.reference_date(tables)
    refs = [latest - timedelta(days=n * horizon_days) for n in (2, 1)]
    made = snapshots(tables, refs, horizon_days)
    write_partitions(made, f"{out}/snapshots", ["snapshot_ref_date"])
    rows = read_partitions(tables.users.sparkSession, f"{out}/snapshots", made.schema).filter(
        F.col("snapshot_ref_date").isin(refs))
    with kept(rows) as held:
        paths = _write_all({
            "cohort": cohort(held), "summary": X.cohort_summary(held),
            "cohort_histograms": X.histogram(
                cohort(held),
                ["order_count", "login_count", "avg_days_between_orders", "age"],
            ),
            "full_histograms": X.histogram(
                held, ["order_count", "login_count", "avg_days_between_orders", "age"]
            ),
        }, out)
    return {"snapshots": f"{out}/snapshots", **paths}


def segmentation(tables: ShopTables, out: str, ref: datetime | None = None,
                 horizon_days: int = S.CHURN_DAYS, k: int = 4) -> dict[str, str]:
    """RFM buckets, k-means and Ward segments with their profiles, silhouettes and PCA."""
    features, _ = feature_table(tables, out, ref, horizon_days)
    names = list(S.SEGMENT_FEATURES)
    with kept(G.scaled_vectors(features, names)) as vectors:
        by_kmeans, _ = G.kmeans(vectors, k)
        by_ward, merges = G.ward(vectors, k)
        plane, loadings = G.pca_coordinates(vectors)
        with kept(by_kmeans) as km, kept(by_ward) as wd:
            return _write_all({
                "rfm_profile": X.rfm_profile(features),
                "silhouettes": G.silhouettes_by_k(vectors),
                "kmeans_summary": X.cluster_summary(km, "kmeans_cluster", names),
                "kmeans_profiles": X.cluster_z(km, "kmeans_cluster", names),
                "ward_summary": X.cluster_summary(wd, "hclust_cluster", names),
                "ward_merges": merges,
                "dendrogram_sample": G.ward_sample_merges(vectors),
                "pca": plane,
                "pca_loadings": loadings,
                "segments": km.select("user_id", "kmeans_cluster").join(
                    wd.select("user_id", "hclust_cluster"), "user_id"
                ),
            }, out)


def drivers(tables: ShopTables, out: str, ref: datetime | None = None,
            horizon_days: int = S.CHURN_DAYS,
            specs: dict[str, L.Spec] | None = None) -> dict[str, str]:
    """Churn drivers: models with tuned thresholds, importances and the Cox table."""
    features, ref = feature_table(tables, out, ref, horizon_days)
    prepared, design = L.driver_design(features)
    specs = specs or L.DRIVER_MODELS
    fitted = L.fit_models(_stage(prepared, f"{out}/prepared"), design, specs, "user_id")
    scores = _stage(fitted.scores, f"{out}/scores")
    sweep = V.threshold_sweep(scores, S.FULL_GRID, ["model"])
    best = V.best_thresholds(sweep, ["model"])
    results = {
        "auc": V.auc(scores, ["model"]),
        "average_precision": V.average_precision(scores, ["model"]),
        "threshold_sweep": sweep,
        "best_thresholds": best,
        "pr_markers": V.pr_markers(scores, best, ["model"]),
        "roc": V.roc_points(scores, ["model"]),
        "pr": V.pr_points(scores, ["model"]),
    }
    for name, spec in specs.items():
        if isinstance(spec, L.Logistic):
            ranked = L.coefficients(fitted, name)
            results[f"coefficients_{name}"] = X.bottom_and_top(ranked, "coef", "feature", 15)
        else:
            results[f"importance_{name}"] = L.top_importances(fitted, name)
    survival, covariates = cox.cox_frame(features, ref, horizon_days)
    results["cox"] = cox.cox_fit(survival, covariates)
    return _write_all(results, out)


def training(features: DataFrame, out: str, specs: dict[str, L.Spec] | None = None,
             seed: int = 42) -> dict[str, str]:
    """Train and compare models on the training feature table."""
    specs = specs or L.TRAINING_MODELS
    prepared, design = L.training_design(C.model_input(features), seed)
    rows = _stage(prepared, f"{out}/prepared")
    fitted = L.fit_models(rows, design, specs, "user_id", seed, carry=["age", "gender_bin"])
    scores = _stage(fitted.scores, f"{out}/scores")
    results = {
        "model_compare": V.compare_models(scores),
        "threshold_summary": V.threshold_summary(scores, ["model"]),
        "threshold_sweep": V.threshold_sweep(scores, S.TRAIN_GRID, ["model"], V.TRAIN_METRICS),
        "segment_metrics": V.segment_metrics(scores, by=["model"]),
        "reliability": V.reliability(scores, by=["model"]),
        "roc": V.roc_points(scores, ["model"]),
        "pr": V.pr_points(scores, ["model"]),
        "split_summary": L.M.split_summary(rows, "label"),
    }
    for name, spec in specs.items():
        if not isinstance(spec, L.Logistic):
            results[f"feature_importance_{name}"] = L.importances(fitted, name)
    return _write_all(results, out)


def training_table(tables: ShopTables, ref: datetime, out: str,
                   horizon_days: int = S.CHURN_DAYS) -> DataFrame:
    """The training feature table, written for ``training``."""
    return _stage(training_features(tables, ref, horizon_days), f"{out}/churn_features")
