"""Euclidean silhouettes against all pairs, and the error they promise."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from churnlake.operators import segment as G
from churnlake.operators import silhouette as E


def exact(x: np.ndarray, tag: np.ndarray) -> float:
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        same = (tag == tag[i]) & (np.arange(len(x)) != i)
        others = [gaps[i, tag == g].mean() for g in set(tag) - {tag[i]}]
        a, b = (gaps[i, same].mean() if same.any() else 0.0), min(others, default=0.0)
        out.append((b - a) / max(a, b) if same.any() and others and max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def frame(spark, x, tag, kind="INT"):
    rows = [(t, *map(float, p)) for t, p in zip(tag, x)]
    names = [f"x{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame(rows, f"tag {kind}, " + ", ".join(f"{n} DOUBLE" for n in names))
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


@pytest.fixture(scope="module")
def clouds():
    rng = np.random.default_rng(4)
    tag = np.repeat([0, 1, 2], [500, 250, 50])
    x = np.array([[0, 0, 0], [4, 0, 1], [0, 6, 2]])[tag] + rng.normal(size=(800, 3))
    x[:200] = x[0]                                  # a group of equal points
    x[799] = 1e6                                    # a point far from all
    return x, tag


def test_points_as_cells_are_exact(spark, clouds):
    x, tag = clouds
    got = E.euclidean_silhouette(frame(spark, x, tag.tolist()), "tag").first()
    assert (got["n"], got["cells"], got["error"]) == (800, 601, 0.0)
    assert got["silhouette"] == pytest.approx(exact(x, tag), abs=1e-9)


@pytest.mark.parametrize("cells", [3, 20, 150])
def test_true_value_lies_within_the_error(spark, clouds, cells):
    x, tag = clouds
    got = E.euclidean_silhouette(frame(spark, x, tag.tolist()), "tag", max_cells=cells).first()
    assert got["cells"] <= cells
    assert abs(got["silhouette"] - exact(x, tag)) <= got["error"] + 1e-9
    if cells == 150:
        assert got["error"] < 0.05


def test_lone_rows_single_clusters_null_tags_and_nothing(spark):
    x = np.array([[0.0, 0.0], [0.0, 0.0], [1.0, 0.0], [5.0, 5.0], [5.0, 4.0], [6.0, 4.0]])
    tag = ["a", "a", "a", "b", None, None]
    want = exact(x, np.array(["a", "a", "a", "b", "none", "none"]))
    got = E.euclidean_silhouette(frame(spark, x, tag, "STRING"), "tag").first()
    assert got["silhouette"] == pytest.approx(want) and got["n"] == 6
    assert E.euclidean_silhouette(frame(spark, x[:3], [1, 1, 1]), "tag").first()[0] == 0.0
    none = E.euclidean_silhouette(frame(spark, x, [1] * 6).limit(0), "tag").first()
    assert (none["silhouette"], none["n"], none["cells"]) == (None, 0, 0)
    with pytest.raises(ValueError):
        E.euclidean_silhouette(frame(spark, x, range(6)), "tag", max_cells=5)


def test_a_cut_never_leaves_an_empty_part():
    tree = E.CellTree(1)
    a = 1.0
    b = float(np.nextafter(a, 2))                   # no double lies between them
    tree.split(np.array([0]), np.array([[a, 0.0]]), np.array([[b, 0.0]]))
    node = tree.find(np.array([0, 0]), np.array([[a, 0.0], [b, 0.0]]))
    assert node.tolist() == [1, 2] and tree.root.tolist() == [0, 0, 0]


def ward_partition(x: np.ndarray, groups: int) -> set[frozenset[int]]:
    """Ward over rows by plain search of the cheapest merge."""
    held = [[i] for i in range(len(x))]
    while len(held) > groups:
        best = min(((len(a) * len(b) / (len(a) + len(b))
                     * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j)
                    for i, a in enumerate(held) for j, b in enumerate(held) if i < j))
        held[best[1]] += held.pop(best[2])
    return {frozenset(h) for h in held}


def test_ward_equals_ward_over_rows(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(30, 2)), rng.normal(size=(25, 2)) + 3,
                        np.repeat([[1.0, 7.0]], 6, axis=0)])
    rows, merges = G.ward(frame(spark, x, range(len(x))), 5)
    got = {}
    for r in rows.select("tag", "hclust_cluster").collect():
        got.setdefault(r[1], set()).add(r[0])
    assert {frozenset(g) for g in got.values()} == ward_partition(x, 5)
    assert merges.count() == 55 and merges.orderBy("step").collect()[-1]["size"] == 61
    heights = [r["height"] for r in merges.orderBy("step").collect()]
    assert heights == sorted(heights)
    few, table = G.ward(frame(spark, x, range(len(x))), 3, micro=12)
    assert table.count() == 11 and few.select("hclust_cluster").distinct().count() == 3
    none, table = G.ward(frame(spark, x, range(len(x))).limit(0), 3)
    assert none.count() == 0 and table.count() == 0


def test_rows_with_much_work_are_spread(spark, monkeypatch):
    """A file of narrow rows was one task, however many rows met all cells in it."""
    from churnlake.operators import silhouette
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    rows = spark.range(0, 70_000, 1, 1).select(
        (F.col("id") % 2).cast("int").alias("cluster"),
        array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"))
    held, plain = [], silhouette.stage
    monkeypatch.setattr(silhouette, "stage", lambda df, name: held.append(df) or plain(df, name))
    got = silhouette.euclidean_silhouette(rows, "cluster").first()
    assert got["n"] == 70_000 and got["error"] == 0
    assert held[0].rdd.getNumPartitions() == 3
    few = silhouette.euclidean_silhouette(rows.limit(1000), "cluster").first()
    assert few["n"] == 1000 and held[2].rdd.getNumPartitions() == 1
