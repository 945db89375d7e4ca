"""Sums of products of many columns equal those of plain numpy, whatever the partitions."""

from __future__ import annotations

import numpy as np
import pytest

from churnlake.operators import explore as X
from churnlake.operators.moments import pair_sums, time_sums


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(500):
        a, b = (float(v) for v in rng.integers(-9, 9, 2))
        rows.append((i, a if i % 7 else None, b if i % 5 else None, 4.0, None))
    return spark.createDataFrame(rows, "id INT, a DOUBLE, `b.x` DOUBLE, flat DOUBLE, none DOUBLE")


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_pair_sums_over_rows_that_have_both(gappy, parts):
    names = ["a", "b.x", "none"]
    sums = pair_sums(gappy.repartition(parts), names, [1.0, 0.0, 0.0])
    rows = [(r["a"], r["b.x"], r["none"]) for r in gappy.collect()]
    shift = [1.0, 0.0, 0.0]
    for i in range(3):
        for j in range(3):
            both = [(r[i] - shift[i], r[j] - shift[j]) for r in rows
                    if r[i] is not None and r[j] is not None]
            assert sums["n"][i, j] == len(both)
            assert sums["x"][i, j] == sum(x for x, _ in both)
            assert sums["xx"][i, j] == sum(x * x for x, _ in both)
            assert sums["xy"][i, j] == sum(x * y for x, y in both)


def test_correlations_equal_pandas_and_constants_have_none(gappy):
    names = ["a", "b.x", "flat", "none"]
    got = {(r["variable_a"], r["variable_b"]): r["corr"]
           for r in X.correlations(gappy, names).collect()}
    want = gappy.toPandas()[names].corr()
    assert len(got) == 16
    for a in names:
        for b in names:
            if {a, b} & {"flat", "none"}:
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-12)


def test_correlations_of_an_empty_table(gappy):
    rows = X.correlations(gappy.limit(0), ["a", "b.x"]).collect()
    assert [r["corr"] for r in rows] == [None] * 4


@pytest.mark.parametrize("parts", [1, 4])
def test_time_sums_per_duration(spark, parts):
    rng = np.random.default_rng(5)
    rows = [(int(d), int(e), float(a), float(b)) for d, e, a, b in
            zip(rng.integers(1, 9, 300), rng.integers(0, 2, 300),
                rng.integers(0, 5, 300), rng.integers(0, 5, 300))]
    df = spark.createDataFrame(rows + [(3, 1, None, 1.0), (None, 1, 1.0, 1.0)],
                               "days INT, died INT, a DOUBLE, b DOUBLE").repartition(parts)
    beta, means, scales = [0.25, -0.5], [1.0, 2.0], [2.0, 4.0]
    got = {(r["duration"], r["event"]): r
           for r in time_sums(df, "days", "died", ["a", "b"], means, scales, beta).collect()}
    assert len(got) == len({r[:2] for r in rows})
    for key, line in got.items():
        x = (np.array([r[2:] for r in rows if r[:2] == key]) - means) / scales
        w = np.exp(x @ beta)
        assert line["n"] == len(x)
        assert [line["x0"], line["x1"], line["w"]] == pytest.approx([*x.sum(axis=0), w.sum()])
        assert [line["wx0"], line["wx1"]] == pytest.approx((w[:, None] * x).sum(axis=0))
        want = (w[:, None] * x).T @ x
        assert [line["wx0_0"], line["wx0_1"], line["wx1_1"]] == pytest.approx(
            [want[0, 0], want[0, 1], want[1, 1]])


def test_time_sums_of_nothing(spark):
    df = spark.createDataFrame([], "d INT, e INT, a DOUBLE")
    assert time_sums(df, "d", "e", ["a"], [0.0], [1.0], [0.0]).collect() == []
