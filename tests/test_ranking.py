"""Exact ranks, scores, running sums and quantiles, also on their large-data paths."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlake.operators import mlprep as M
from churnlake.operators import order_stats as O
from churnlake.operators import ranking as R


def frame(spark, values, ids=None):
    ids = ids or range(1, len(values) + 1)
    rows = [(int(i), None if v is None else float(v)) for i, v in zip(ids, values)]
    return spark.createDataFrame(rows, "user_id BIGINT, v DOUBLE")


def skewed(n: int, seed: int = 7) -> list[float]:
    """A third of all rows share one value."""
    rng = np.random.default_rng(seed)
    return np.where(rng.random(n) < 0.34, 5.0, rng.integers(0, 400, n).astype(float)).tolist()


@pytest.mark.parametrize("values", [
    [3, 1, 2], [1] * 50, list(range(200)), skewed(3000), [1, None, 2, None, 1]
], ids=["few", "constant", "distinct", "skewed", "missing"])
def test_global_rank(spark, values):
    df = frame(spark, values)
    got = {r["user_id"]: r["rank"] for r in R.global_rank(df, "v", "user_id").collect()}
    order = sorted(
        range(len(values)), key=lambda i: (values[i] is None, values[i] or 0.0, i)
    )
    assert got == {i + 1: place for place, i in enumerate(order, 1)}


def test_frequent_value_is_split_over_ranges(spark):
    df = frame(spark, skewed(4000))
    edges, frequent = R._edges(*R.split_points(df, "v"))
    assert frequent == {5.0} and 5.0 in edges


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    values = sorted(set(skewed(2000)))
    df = frame(spark, values)
    out = R.running_sums(df, "v", ["user_id"], *R.split_points(df, "v"), descending=descending)
    pdf = out.toPandas().sort_values("v", ascending=not descending)
    assert (pdf["cum_user_id"] == pdf["user_id"].cumsum()).all()


def test_average_rank(spark):
    values = skewed(900)
    got = {r["v"]: r["avg_rank"] for r in R.average_rank(frame(spark, values), "v").collect()}
    expected = pd.Series(values).rank().groupby(pd.Series(values)).first()
    assert got == expected.to_dict()


def pandas_score(values, labels, descending=False):
    s = pd.Series(values, dtype=float)
    k = min(5, s.nunique())
    if s.nunique() < 5:
        return pd.qcut(s.rank(method="first"), k, labels=labels[:k]).astype(int).tolist()
    return pd.qcut((-s if descending else s).rank(method="first"), 5, labels=labels).astype(int).tolist()


SETS = {
    "n7": [5, 3, 8, 1, 9, 2, 7], "n11": [4, 4, 4, 1, 9, 2, 7, 7, 7, 7, 3],
    "stale": [1, 2, 3, 50, 100], "two_levels": [1, 1, 50, 50, 100, 100],
    "constant": [3, 3, 3, 3], "skewed": skewed(1234), "distinct": list(range(1001)),
}


@pytest.mark.parametrize("name", SETS)
@pytest.mark.parametrize("descending", [False, True])
def test_quantile_score_equals_ranked_cut(spark, name, descending):
    values = SETS[name]
    labels = [5, 4, 3, 2, 1] if descending else [1, 2, 3, 4, 5]
    scored = R.quantile_score(frame(spark, values), "v", "s", labels=labels, descending=descending)
    got = [r["s"] for r in scored.orderBy("user_id").collect()]
    assert got == pandas_score(values, labels, descending)


def test_score_of_the_stalest_user_in_both_modes(spark):
    df = spark.createDataFrame(
        [(i, r, 1 + i % 7, float(i)) for i, r in enumerate([1, 2, 3, 50, 100], 1)],
        "user_id BIGINT, recency_days BIGINT, order_count BIGINT, total_spend DOUBLE",
    )
    reference = [r["R_score"] for r in R.rfm_scores(df).orderBy("user_id").collect()]
    recent = [r["R_score"] for r in
              R.rfm_scores(df, r_mode="recent_high").orderBy("user_id").collect()]
    assert reference == [1, 2, 3, 4, 5] and recent == [5, 4, 3, 2, 1]


def test_scores_with_less_values_than_bins_ignore_the_direction(spark):
    values = [1, 1, 50, 50, 100, 100]
    scored = R.quantile_score(
        frame(spark, values), "v", "s", labels=[5, 4, 3, 2, 1], descending=True
    )
    assert [r["s"] for r in scored.orderBy("user_id").collect()] == [5, 5, 4, 4, 3, 3]


def test_missing_values_get_no_score(spark):
    scored = R.quantile_score(frame(spark, [1, None, 2, 3, 4, 5, 6]), "v", "s")
    assert [r["s"] for r in scored.orderBy("user_id").collect()][1] is None


@pytest.fixture()
def coarse_sketch(monkeypatch):
    """Forces the bracketed path, with brackets of a few percent of the rows."""
    monkeypatch.setattr(O, "WHOLE_RANGE_ROWS", 10)
    monkeypatch.setattr(O, "SKETCH_ACCURACY", 100)


@pytest.mark.parametrize("values", [skewed(5000), np.random.default_rng(1).normal(size=5000)])
def test_quantiles_through_brackets(spark, coarse_sketch, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["quantile"] for r in
           O.quantiles(frame(spark, values), ["v"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_scores_through_brackets(spark, coarse_sketch):
    values = skewed(5000)
    got = [r["s"] for r in
           R.quantile_score(frame(spark, values), "v", "s").orderBy("user_id").collect()]
    assert got == pandas_score(values, [1, 2, 3, 4, 5])


def test_quantiles_by_group_with_missing_values(spark):
    df = frame(spark, [1, 2, None, 10, 20, 40]).withColumn("g", (F.col("user_id") > 3).cast("int"))
    got = {r["grp"]: (r["n"], r["quantile"]) for r in
           O.quantiles(df, ["v"], [0.5], by="g").collect()}
    assert got == {0: (2, 1.5), 1: (3, 20.0)}


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_GROUPS", 3)
    with pytest.raises(ValueError, match="groups"):
        O.quantiles(frame(spark, range(10)).withColumn("g", F.col("user_id")), ["v"], [0.5], by="g")


def test_exact_split_gives_each_class_its_share(spark):
    df = spark.range(1, 1004).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    counts = {(r["label"], r["split"]): r["n"] for r in
              M.split(df, "id", "label", 0.2, exact=True).groupBy("label", "split")
              .agg(F.count("*").alias("n")).collect()}
    assert counts[0, "test"] == round(0.2 * 669) and counts[1, "test"] == round(0.2 * 334)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("label", F.lit(0))
    a = M.split(df, "id", "label", 0.3).orderBy("id").collect()
    b = M.split(df.repartition(7), "id", "label", 0.3).orderBy("id").collect()
    assert a == b


def test_previous_order_with_a_dominant_user_and_instant(spark):
    """A third of all orders belong to one user, and many share one instant."""
    from churnlake.operators import activity as A

    rng = np.random.default_rng(6)
    n = 3000
    user = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 60, n))
    minute = np.where(rng.random(n) < 0.4, 5000, rng.integers(0, 40000, n))
    pdf = pd.DataFrame({
        "order_id": rng.permutation(n), "user_id": user,
        "order_date": pd.Timestamp("2025-01-01") + pd.to_timedelta(minute, unit="min"),
    })
    orders = spark.createDataFrame(pdf).withColumn(
        "order_date", F.col("order_date").cast("timestamp_ntz")
    )
    ordered = pdf.sort_values(["user_id", "order_date", "order_id"])
    ordered["prev"] = ordered.groupby("user_id")["order_date"].shift(1)
    expected = {r.order_id: None if pd.isna(r.prev) else r.prev.to_pydatetime()
                for r in ordered.itertuples()}
    got = {r["order_id"]: r["prev_order_date"] for r in A.previous_order(orders).collect()}
    assert got == expected
    cells = R.ordered_cells(orders, F.unix_timestamp("order_date"), "order_id")
    largest = cells.groupBy(*R.CELL).count().agg(F.max("count")).first()[0]
    assert largest < n / 4        # 8 ranges; no cell keeps a dominant share
