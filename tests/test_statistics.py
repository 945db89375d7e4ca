"""Statistics and tests against small computations of our own."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import pvalues as P
from churnlake.operators import explore as X
from churnlake.operators import hypothesis as H


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(3)
    n = 400
    churn = (rng.random(n) < 0.4).astype(int)
    pdf = pd.DataFrame({
        "user_id": np.arange(n), "churn": churn,
        "x": rng.normal(size=n) + churn, "k": rng.integers(0, 5, n) + churn,
        "two": np.where(rng.random(n) < 0.5 + 0.2 * churn, "a", "b"),
        "three": rng.choice(["p", "q", "r"], n), "one": "same",
    })
    return pdf, spark.createDataFrame(pdf)


def test_tail_probabilities():
    assert P.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert P.chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert P.chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05)
    assert P.student_two_sided(2.2281388519649385, 10) == pytest.approx(0.05)
    assert P.student_two_sided(1.0, 1.0) == pytest.approx(0.5)
    assert P.student_two_sided(0.0, 5.0) == pytest.approx(1.0)
    assert P.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert P.student_two_sided(1.959963984540054, 1e7) == pytest.approx(0.05, rel=1e-5)


def chi2(pdf, column, yates):
    o = pd.crosstab(pdf[column], pdf["churn"]).to_numpy(dtype=float)
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    d = np.abs(o - e)
    if yates:
        d -= np.minimum(0.5, d)
    return (d**2 / e).sum()


def test_chi_square(people):
    pdf, df = people
    got = {r["variable"]: r for r in H.chi_square(df, ["two", "three", "one"]).collect()}
    assert set(got) == {"two", "three"}              # one level: no test
    assert got["two"]["chi2"] == pytest.approx(chi2(pdf, "two", True))
    assert got["two"]["dof"] == 1
    assert got["three"]["chi2"] == pytest.approx(chi2(pdf, "three", False))
    assert got["three"]["dof"] == 2


def test_chi_square_needs_both_classes(people):
    _, df = people
    assert H.chi_square(df.where("churn = 0"), ["two"]).count() == 0


def test_welch(people):
    pdf, df = people
    a, b = pdf[pdf.churn == 0]["x"], pdf[pdf.churn == 1]["x"]
    va, vb = a.var() / len(a), b.var() / len(b)
    row = H.welch(df, ["x"]).first()
    assert row["t"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb))
    dof = (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))
    assert row["dof"] == pytest.approx(dof)
    assert 0 < row["p_value"] < 1e-6


def test_mann_whitney_counts_pairs(people):
    pdf, df = people
    for column in ("x", "k"):
        a = pdf[pdf.churn == 0][column].to_numpy()
        b = pdf[pdf.churn == 1][column].to_numpy()
        u = (a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()
        row = H.mann_whitney(df, [column]).first()
        assert row["u"] == pytest.approx(u)
        assert row["median_active"] == np.median(a)
        ties = pd.Series(np.concatenate([a, b])).value_counts()
        n = len(pdf)
        sd = math.sqrt(len(a) * len(b) / 12 * ((n + 1) - (ties**3 - ties).sum() / (n * (n - 1))))
        big = max(u, len(a) * len(b) - u)
        assert row["z"] == pytest.approx((big - len(a) * len(b) / 2 - 0.5) / sd)


def test_empty_groups_stay(spark):
    df = spark.createDataFrame([("<25", 1), ("<25", 0), ("45+", 1)], "age_group STRING, churn INT")
    rows = X.group_rate(df, "age_group", labels=S.AGE_LABELS).orderBy("position").collect()
    assert [(r["age_group"], r["churn_rate"], r["n"]) for r in rows] == [
        ("<25", 0.5, 2), ("25-34", None, 0), ("35-44", None, 0), ("45+", 1.0, 1)
    ]


def test_histogram_closes_the_last_bin(spark):
    values = [0.0, 1.0, 2.9, 3.0, 10.0, 30.0, 30.0]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    rows = X.histogram(df, ["v"]).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())
    one = spark.createDataFrame([(4.0,), (4.0,)], "v DOUBLE")
    assert X.histogram(one, ["v"]).agg(F.sum("n")).first()[0] == 2


def test_correlation_skips_missing_and_constant_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 1.0, 5.0)],
        "a DOUBLE, b DOUBLE, c DOUBLE",
    )
    got = {(r[0], r[1]): r[2] for r in X.correlations(df, ["a", "b", "c"]).collect()}
    expected = df.toPandas().corr()
    assert got["a", "b"] == got["b", "a"] == pytest.approx(expected.loc["a", "b"])
    assert got["a", "c"] is None and got["a", "a"] == pytest.approx(1.0)


def test_outliers_and_missing_on_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None)] * 9 + [(100.0, None)], "a DOUBLE, b DOUBLE")
    rows = {r["variable"]: r for r in X.outliers(df, ["a", "b"]).collect()}
    assert rows["a"]["outlier_count"] == 1 and rows["a"]["outlier_ratio"] == 0.1
    assert rows["b"]["outlier_count"] == 0 and rows["b"]["lower_bound"] is None
    gaps = {r["variable"]: r["missing_ratio"] for r in X.missing(df, ["a", "b"]).collect()}
    assert gaps == {"a": 0.0, "b": 1.0}


def test_value_counts_show_missing_as_nan(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "g STRING")
    assert {(r["level"], r["n"]) for r in X.value_counts(df, ["g"]).collect()} == {
        ("a", 1), ("nan", 2)
    }


def test_exact_rank_test_counts_all_orders(spark):
    from itertools import combinations

    from churnlake.functions.pvalues import mann_whitney_exact
    from churnlake.operators.hypothesis import mann_whitney

    for n1, n2 in ((1, 1), (2, 3), (5, 4), (1, 6), (6, 6)):
        us = [sum(x - i for i, x in enumerate(c)) for c in combinations(range(n1 + n2), n1)]
        for u in range(n1 * n2 + 1):
            out = sum(x >= max(u, n1 * n2 - u) for x in us)
            assert abs(mann_whitney_exact(u, n1, n2) - min(1.0, 2 * out / len(us))) < 1e-12
    rows = [(0, 1.0, 1.0), (0, 2.0, 2.0), (0, 7.0, 7.0), (1, 3.0, 2.0), (1, 4.0, 4.0),
            (1, 5.0, 5.0), (1, 6.0, 6.0), (1, 8.0, 8.0)]
    frame = spark.createDataFrame(rows, "churn INT, x DOUBLE, tied DOUBLE")
    got = {r["variable"]: r for r in mann_whitney(frame, ["x", "tied"]).collect()}
    assert got["x"]["u"] == 4.0 and abs(got["x"]["p_value"] - 22 / 56) < 1e-12
    assert abs(got["tied"]["p_value"] - 22 / 56) > 1e-3          # ties: the normal law
