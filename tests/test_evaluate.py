"""Evaluation on a small score table, with its edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from churnlake import schema as S
from churnlake.operators import evaluate as V


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(8)
    score = np.round(rng.random(500), 2)
    score[:3] = [1.0, 0.0, 0.3]
    label = (rng.random(500) < score).astype(int)
    rows = [(int(y), float(s)) for y, s in zip(label, score)]
    return label, score, spark.createDataFrame(rows, "label INT, score DOUBLE")


def test_sweep_equals_a_count_per_threshold(scored):
    label, score, df = scored
    rows = V.threshold_sweep(df, S.FULL_GRID).orderBy("threshold").collect()
    grid = np.linspace(0, 1, 2001)
    assert [r["threshold"] for r in rows] == grid.tolist()
    for r in rows[::37] + rows[-1:]:
        hit = score >= r["threshold"]
        assert (r["tp"], r["fp"]) == ((hit & (label == 1)).sum(), (hit & (label == 0)).sum())
        assert r["tp"] + r["fn"] == label.sum()


def test_best_threshold_is_the_lowest_among_equals(scored):
    _, _, df = scored
    sweep = V.threshold_sweep(df, S.TRAIN_GRID).toPandas().sort_values("threshold", ignore_index=True)
    best = {r["criterion"]: r for r in V.best_thresholds(V.threshold_sweep(df, S.TRAIN_GRID)).collect()}
    for metric in ("balanced_accuracy", "mcc", "f1", "accuracy", "youden_j"):
        assert best[metric]["threshold"] == sweep.loc[sweep[metric].idxmax(), "threshold"]
    assert best["default"]["threshold"] == pytest.approx(0.5)


def test_auc_counts_pairs(scored):
    label, score, df = scored
    a, b = score[label == 1], score[label == 0]
    pairs = (a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()
    assert V.auc(df).first()["roc_auc"] == pytest.approx(pairs / len(a) / len(b))


def test_auc_equals_the_area_under_the_points(scored):
    _, _, df = scored
    points = V.roc_points(df).toPandas().sort_values(["fpr", "tpr"])
    area = np.trapezoid(points["tpr"], points["fpr"])
    assert V.auc(df).first()["roc_auc"] == pytest.approx(area)


def test_average_precision(scored):
    label, score, df = scored
    total, last = 0.0, 0.0
    for s in sorted(set(score), reverse=True):
        hit = score >= s
        recall = label[hit].sum() / label.sum()
        total += (recall - last) * label[hit].mean()
        last = recall
    assert V.average_precision(df).first()["average_precision"] == pytest.approx(total)


def test_reliability_drops_a_score_of_one_and_keeps_empty_bins(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.95), (0, 0.3), (0, 0.05)], "label INT, score DOUBLE")
    rows = {r["bin"]: (r["mean_score"], r["positive_share"], r["n"])
            for r in V.reliability(df).collect()}
    assert rows[9] == (0.95, 1.0, 1) and rows[5] == (None, None, 0) and len(rows) == 10
    assert rows[2] == (0.3, 0.0, 1)      # the edge is 0.30000000000000004


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label INT, score DOUBLE")
    row = V.full_metrics(df).first()
    assert (row["f1"], row["mcc"], row["tpr"], row["precision"]) == (0.0, 0.0, 0.0, 0.0)
    assert row["tnr"] == 1.0 and row["roc_auc"] is None


def test_empty_segment_gives_no_row(spark):
    df = spark.createDataFrame([(1, 0.9, 50, 1)], "label INT, score DOUBLE, age INT, gender_bin INT")
    assert V.segment_metrics(df).count() == 0


def test_threshold_summary_text(scored):
    _, _, df = scored
    rows = V.threshold_summary(df).collect()
    assert {r["criterion"] for r in rows} == {"default", "balanced_accuracy", "mcc", "accuracy"}
    assert all(r["pred_rate"].endswith("%") and r["difference"][0] in "+-" for r in rows)


def test_models_do_not_mix(scored, spark):
    label, score, df = scored
    from pyspark.sql import functions as F

    both = df.withColumn("model", F.lit("a")).unionByName(
        df.select("label", (1 - F.col("score")).alias("score"), F.lit("b").alias("model"))
    )
    areas = {r["model"]: r["roc_auc"] for r in V.auc(both, ["model"]).collect()}
    assert areas["a"] + areas["b"] == pytest.approx(1.0)
    table = V.compare_models(both).orderBy(F.col("roc_auc").desc()).collect()
    assert [r["model"] for r in table] == ["a", "b"]


def test_markers_at_picked_thresholds(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.6), ("a", 1, 0.5), ("b", 0, 0.7), ("b", 1, None)]
    scores = spark.createDataFrame(rows, "model STRING, label INT, score DOUBLE")
    picks = spark.createDataFrame(
        [("a", "f1", 0.5), ("a", "accuracy", 0.9), ("b", "f1", 0.7), ("b", "accuracy", 2.0)],
        "model STRING, criterion STRING, threshold DOUBLE")
    found = {(r["model"], r["criterion"]): (r["precision"], r["recall"])
             for r in V.pr_markers(scores, picks, ["model"]).collect()}
    assert found == {("a", "f1"): (2 / 3, 1.0), ("a", "accuracy"): (1.0, 0.5),
                     ("b", "f1"): (0.0, 0.0), ("b", "accuracy"): (0.0, 0.0)}
    whole = V.pr_markers(scores, picks.where("model = 'a'").drop("model")).collect()
    assert {r["criterion"]: r["recall"] for r in whole} == {"f1": 2 / 3, "accuracy": 1 / 3}
