"""Evaluation of scored rows: ``label`` 0/1, ``score`` double, optional group columns.

Threshold tables come from one count of labels per grid cell and a running sum over
the grid, not from one pass per threshold. Curves and ranking metrics work on counts
per distinct score, placed by range-partitioned running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.functions.exact import exact_avg
from churnlake.operators import ranking as R
from churnlake.session import small_frame

COUNTS = ("tp", "fp", "tn", "fn")


def _div(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def metric_columns() -> dict[str, Column]:
    """Metrics of a row with tp, fp, tn, fn; 0 where a metric is undefined."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in COUNTS)
    total = tp + fp + tn + fn
    tpr, tnr, fpr = _div(tp, tp + fn), _div(tn, tn + fp), _div(fp, tn + fp)
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "accuracy": _div(tp + tn, total),
        "balanced_accuracy": (tpr + tnr) / 2,
        "f1": _div(2 * tp, 2 * tp + fp + fn),
        "mcc": _div(tp * tn - fp * fn, spread),
        "tpr": tpr,
        "tnr": tnr,
        "fpr": fpr,
        "youden_j": tpr - fpr,
        "precision": _div(tp, tp + fp),
        "pred_rate": _div(tp + fp, total),
        "actual_rate": _div(tp + fn, total),
        "rate_diff_pp": (_div(tp + fp, total) - _div(tp + fn, total)) * 100,
    }


DRIVER_METRICS = ("accuracy", "balanced_accuracy", "f1", "mcc", "tpr", "tnr", "fpr", "youden_j")
TRAIN_METRICS = ("accuracy", "balanced_accuracy", "f1", "mcc", "tpr", "tnr", "precision",
                 "pred_rate", "actual_rate", "rate_diff_pp")


def with_metrics(counts: DataFrame, names: Sequence[str] = DRIVER_METRICS) -> DataFrame:
    columns = metric_columns()
    return counts.withColumns({n: columns[n] for n in names})


def confusion(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, tn, fn with a score at the threshold counted as positive."""
    hit = F.col("score") >= threshold
    pos = F.col("label") == 1
    return scores.groupBy(*by).agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & ~pos).alias("tn"), F.count_if(~hit & pos).alias("fn"),
    )


def metrics_at(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = (),
               names: Sequence[str] = DRIVER_METRICS) -> DataFrame:
    return with_metrics(confusion(scores, threshold, by), names).withColumn(
        "threshold", F.lit(float(threshold))
    )


def full_metrics(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """The training metric set, with the rank-based AUC of the scores."""
    key = list(by) or ["__all"]
    rows = scores if by else scores.withColumn("__all", F.lit(1))
    out = metrics_at(rows, threshold, key, TRAIN_METRICS).join(auc(rows, key), key)
    return out if by else out.drop("__all")


def grid_points(grid: tuple[float, float, int]) -> list[float]:
    """Even thresholds of (first, last, count), clipped to [0, 1], each once."""
    return np.unique(np.clip(np.linspace(*grid), 0.0, 1.0)).tolist()


def threshold_sweep(scores: DataFrame, grid: tuple[float, float, int] = S.FULL_GRID,
                    by: Sequence[str] = (), names: Sequence[str] = DRIVER_METRICS) -> DataFrame:
    """Confusion counts and metrics at every grid threshold.

    The counts are per (group, grid cell), so the running sums see one short row set
    per group whatever the number of scores.
    """
    points = grid_points(grid)
    cell = Bucketizer(
        inputCol="score", outputCol="cell", splits=[-np.inf, *points, np.inf],
        handleInvalid="skip",
    )
    counts = cell.transform(scores.where(F.col("score").isNotNull())).groupBy(*by, "cell").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") != 1).alias("neg"),
    )
    # Every group gets every threshold: a grid row without scores counts zero.
    zeros = counts.groupBy(*by).agg(F.lit(0).alias("pos"), F.lit(0).alias("neg")).withColumn(
        "cell", F.explode(F.sequence(F.lit(1), F.lit(len(points))))
    ).withColumn("cell", F.col("cell").cast("double"))
    cells = counts.unionByName(zeros).groupBy(*by, "cell").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    group = Window.partitionBy(*by)
    from_here = group.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    hits = cells.withColumns({
        "tp": F.sum("pos").over(from_here), "fp": F.sum("neg").over(from_here),
        "p": F.sum("pos").over(group), "n": F.sum("neg").over(group),
    })
    frame = small_frame(
        scores.sparkSession, [(i + 1.0, p) for i, p in enumerate(points)],
        "cell DOUBLE, threshold DOUBLE",
    )
    table = hits.join(F.broadcast(frame), "cell").select(
        *by, "threshold", "tp", "fp",
        (F.col("n") - F.col("fp")).alias("tn"), (F.col("p") - F.col("tp")).alias("fn"),
    )
    return with_metrics(table, names)


def pick_rows(sweep: DataFrame, criteria: dict[str, str], default: float | None = 0.5,
              by: Sequence[str] = ()) -> DataFrame:
    """The sweep row that maximises each criterion, the lowest threshold among equals,
    and the row nearest to a default threshold."""
    row = F.struct(*[F.col(c) for c in sweep.columns if c not in by])
    picks = [
        F.struct(
            F.lit(label).alias("criterion"),
            F.max_by(row, F.struct(F.col(metric), -F.col("threshold"))).alias("row"),
        )
        for label, metric in criteria.items()
    ]
    if default is not None:
        nearest = F.struct(F.abs(F.col("threshold") - default), F.col("threshold"))
        picks.insert(0, F.struct(
            F.lit("default").alias("criterion"), F.min_by(row, nearest).alias("row")
        ))
    chosen = sweep.groupBy(*by).agg(F.array(*picks).alias("picks"))
    return chosen.select(*by, F.inline("picks")).select(*by, "criterion", "row.*")


def best_thresholds(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pick_rows(sweep, {
        m: m for m in ("balanced_accuracy", "youden_j", "mcc", "f1", "accuracy")
    }, 0.5, by)


def threshold_summary(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four recommended thresholds of model training, rounded for reading."""
    sweep = threshold_sweep(scores, S.TRAIN_GRID, by, TRAIN_METRICS)
    rows = pick_rows(sweep, {
        "balanced_accuracy": "balanced_accuracy", "mcc": "mcc", "accuracy": "accuracy",
    }, 0.5, by)
    return rows.select(
        *by, "criterion", F.round("threshold", 4).alias("threshold"),
        *[F.round(c, 3).alias(c)
          for c in ("accuracy", "balanced_accuracy", "f1", "mcc", "tpr", "tnr")],
        E.percent_text(F.col("pred_rate")).alias("pred_rate"),
        E.percent_text(F.col("actual_rate")).alias("actual_rate"),
        E.signed_points_text(F.col("rate_diff_pp")).alias("difference"),
        *COUNTS,
    )


def _distinct_scores(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    return scores.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") != 1).alias("neg"),
    )


def _curve_counts(scores: DataFrame, by: Sequence[str], grid: int | None = None) -> DataFrame:
    """Per distinct score (or grid cell): hits at or above it, and the class totals."""
    rows = scores.where(F.col("score").isNotNull())
    if grid:
        step = F.floor(F.col("score") * grid) / grid
        rows = rows.withColumn("score", step)
    (points,) = R.split_points(rows, "score")
    cum = R.running_sums(
        _distinct_scores(rows, by), "score", ["pos", "neg"], points, by, descending=True
    )
    totals = rows.groupBy(*by).agg(
        F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") != 1).alias("n"),
    )
    if by:
        return cum.join(totals, list(by))
    p, n = totals.first()
    return cum.withColumns({"p": F.lit(p), "n": F.lit(n)})


def roc_points(scores: DataFrame, by: Sequence[str] = (), grid: int | None = None) -> DataFrame:
    """(fpr, tpr) at every distinct score, with the origin as a point without threshold.

    ``grid`` bounds the number of points by flooring scores to that many steps.
    """
    counts = _curve_counts(scores, by, grid)
    points = counts.select(
        *by, F.col("score").alias("threshold"),
        _div(F.col("cum_neg"), F.col("n")).alias("fpr"),
        _div(F.col("cum_pos"), F.col("p")).alias("tpr"),
    )
    start = scores.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def pr_points(scores: DataFrame, by: Sequence[str] = (), grid: int | None = None) -> DataFrame:
    """(recall, precision) at every distinct score, with the end point (0, 1)."""
    counts = _curve_counts(scores, by, grid)
    points = counts.select(
        *by, F.col("score").alias("threshold"),
        _div(F.col("cum_pos"), F.col("p")).alias("recall"),
        _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
    )
    end = scores.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"),
    )
    return points.unionByName(end)


def auc(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve in its rank form: ties count half."""
    counts = _curve_counts(scores, by)
    # negatives strictly below a score, plus half of those that share it
    beaten = (F.col("n") - F.col("cum_neg")) + F.col("neg") / 2
    won = F.sum(F.col("pos") * beaten)
    pairs = F.max("p").cast("double") * F.max("n").cast("double")
    return counts.groupBy(*by).agg(F.try_divide(won, pairs).alias("roc_auc"))


def average_precision(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of precision times the recall gained at each distinct score."""
    counts = _curve_counts(scores, by)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    gained = F.sum(F.col("pos") * precision)
    return counts.groupBy(*by).agg(
        F.try_divide(gained, F.max("p").cast("double")).alias("average_precision")
    )


def brier(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    gap = F.col("score") - F.col("label")
    return scores.groupBy(*by).agg(exact_avg(gap * gap).alias("brier"))


def reliability(scores: DataFrame, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean score and positive share per bin ``[lo, hi)``; empty bins stay.

    A score of exactly 1 lies outside all bins, as in the published calibration.
    """
    edges = np.linspace(0.0, 1.0, bins + 1).tolist()
    place = Bucketizer(
        inputCol="score", outputCol="bin", splits=[-np.inf, *edges, np.inf], handleInvalid="skip"
    )
    rows = place.transform(scores.where(F.col("score").isNotNull())).withColumn(
        "bin", F.col("bin").cast("int") - 1
    )
    per_bin = rows.groupBy(*by, "bin").agg(F.struct(
        exact_avg(F.col("score")).alias("mean_score"), F.avg("label").alias("positive_share"),
        F.count(F.lit(1)).alias("n")).alias("found"))
    # A map of a group's bins (those outside as well) keeps the empty ones without a join.
    held = per_bin.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "found"))).alias("bins"))
    every = held.select(*by, "bins", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    found = F.try_element_at("bins", "bin")
    return every.select(*by, "bin", found["mean_score"].alias("mean_score"),
                        found["positive_share"].alias("positive_share"),
                        F.coalesce(found["n"], F.lit(0).cast("bigint")).alias("n"))


def segment_metrics(scored_rows: DataFrame, age: str = "age", gender_flag: str = "gender_bin",
                    threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """The training metrics on the model cohort; no row for an empty cohort."""
    inside = scored_rows.where(E.in_model_cohort(E.col(age), E.col(gender_flag)))
    return full_metrics(inside, threshold, by).where("tp + fp + tn + fn > 0")


def compare_models(scores: DataFrame, model: str = "model", threshold: float = 0.5) -> DataFrame:
    """One row per model; order by ``roc_auc`` descending to read it."""
    table = full_metrics(scores, threshold, [model]).join(brier(scores, [model]), model)
    return table.select(
        model, "roc_auc", "accuracy", "f1", "tpr", "tnr", "pred_rate", "actual_rate", "brier"
    )


def pr_marker(scores: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at one threshold, to mark on the curve."""
    rows = metrics_at(scores, threshold, by, ("precision", "tpr"))
    return rows.select(*by, "threshold", "precision", F.col("tpr").alias("recall"))


def pr_markers(scores: DataFrame, picks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each picked threshold of a group, to mark on its curve.

    ``picks`` holds ``by``, ``criterion`` and ``threshold``: a line per group and criterion, as
    ``best_thresholds`` returns. Precision is 0 where nothing reaches the threshold.
    """
    key = list(by) or ["__all"]
    every = [df if by else df.withColumn("__all", F.lit(1)) for df in (scores, picks)]
    wanted = every[1].groupBy(*key).agg(
        F.collect_list(F.struct("criterion", "threshold")).alias("picks"))
    rows = every[0].join(F.broadcast(wanted), key)
    hit, pos = F.col("score") >= F.col("pick.threshold"), F.col("label") == 1
    sums = rows.select(*by, "score", "label", F.explode("picks").alias("pick")).groupBy(
        *by, F.col("pick.criterion").alias("criterion"), F.col("pick.threshold").alias("threshold")
    ).agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit).alias("hits"),
          F.count_if(pos).alias("p"))
    share = {"precision": F.try_divide("tp", "hits"), "recall": F.try_divide("tp", "p")}
    return sums.select(*by, "criterion", "threshold",
                       *[F.coalesce(v, F.lit(0.0)).alias(n) for n, v in share.items()])
