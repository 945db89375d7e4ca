"""The end-to-end jobs write complete result tables, and plans hold at scale."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest

from churnlake import schema as S
from churnlake.operators import activity as A
from churnlake.operators import evaluate as V
from churnlake.operators import models as L
from churnlake.operators import order_stats as O
from churnlake.operators import ranking as R
from churnlake.operators import snapshot as N
from churnlake.operators.features import user_features
from churnlake.plans import jobs
from churnlake.registry import star_tables as T
from tests.conftest import TESTDATA

SMALL = {"logistic": L.Logistic(max_iter=50), "rf": L.Forest(5, 2), "gbt": L.Boosting(3, 3)}


@pytest.fixture(scope="module")
def tables(spark):
    return T.shop(spark, TESTDATA)


def count(spark, path):
    return spark.read.parquet(path).count()


def test_exploration(spark, tables, tmp_path):
    paths = jobs.exploration(tables, str(tmp_path), horizon_days=T.HORIZON_DAYS)
    assert count(spark, paths["describe"]) == len(S.NUMERIC_PROFILE)
    assert count(spark, paths["rate_by_rfm"]) == 4
    assert count(spark, paths["correlations"]) == len(S.NUMERIC_PROFILE) ** 2
    assert count(spark, paths["histograms"]) == 30 * len(S.NUMERIC_PROFILE)


def test_snapshot_build(spark, tables, tmp_path):
    paths = jobs.snapshot_build(tables, str(tmp_path), horizon_days=T.HORIZON_DAYS)
    users = tables.users.count()
    assert count(spark, paths["snapshots"]) == 2 * users
    assert count(spark, paths["summary"]) == 4


def test_segmentation(spark, tables, tmp_path):
    paths = jobs.segmentation(tables, str(tmp_path), horizon_days=T.HORIZON_DAYS)
    assert count(spark, paths["segments"]) == tables.users.count()
    assert count(spark, paths["silhouettes"]) == 4


def test_drivers(spark, tables, tmp_path):
    paths = jobs.drivers(tables, str(tmp_path), horizon_days=T.HORIZON_DAYS, specs=SMALL)
    assert count(spark, paths["best_thresholds"]) == 18
    assert count(spark, paths["cox"]) == 11
    assert "importance_rf" in paths and "coefficients_logistic" in paths


def test_training(spark, tables, tmp_path):
    ref = A.reference_date(tables) - timedelta(days=T.HORIZON_DAYS)
    features = jobs.training_table(tables, ref, str(tmp_path), T.HORIZON_DAYS)
    assert tuple(features.columns) == S.TRAINING_COLUMNS
    paths = jobs.training(features, str(tmp_path), SMALL)
    table = spark.read.parquet(paths["model_compare"]).collect()
    assert {r["model"] for r in table} == set(SMALL)
    assert count(spark, paths["threshold_summary"]) == 12


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_scans_are_pruned_and_filtered(tables):
    ref = A.reference_date(tables) - timedelta(days=360)
    text = plan(N.snapshot(tables, ref, 180))
    scan = next(line for line in text.splitlines() if "orders.parquet" in line)
    assert "LessThanOrEqual(o_orderdate" in scan
    schema = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert "o_orderstatus" not in schema


def single_partition_inputs(text: str) -> list[str]:
    """The operator below each exchange into one partition."""
    lines = text.splitlines()
    return [lines[i + 1].strip(" :+-*()0123456789") for i, line in enumerate(lines)
            if "Exchange SinglePartition" in line]


def test_row_scale_data_never_meets_in_one_partition(spark, tables):
    scores = T.model_scores(spark, TESTDATA)
    ref = A.reference_date(tables)
    checked = {
        "features": user_features(tables, ref),
        "snapshots": N.snapshots(tables, [ref - timedelta(days=d) for d in (360, 180)], 180),
        "rank": R.global_rank(tables.orders, "total_amount", "order_id"),
        "previous": A.previous_order(tables.orders),
        "roc": V.roc_points(scores, ["model"]),
        "sweep": V.threshold_sweep(scores, by=["model"]),
        "quantiles": O.quantiles(scores, ["score", "id"], [0.25, 0.5], by="label"),
        "medians": O.quantiles(scores, ["score", "id"], [0.5]),
    }
    for name, df in checked.items():
        for below in single_partition_inputs(plan(df)):
            # only counts per cell (already aggregated) may be put in one place
            assert below.startswith("HashAggregate"), (name, below)
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoop" not in plan(df)
