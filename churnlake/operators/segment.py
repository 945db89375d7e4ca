"""Customer segmentation: k-means, Ward groups over cells, silhouettes, PCA."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions.expressions import col
from churnlake.operators import mlprep as M
from churnlake.operators.silhouette import cells_of, euclidean_silhouette
from churnlake.session import drop_staged, kept, small_frame, spread, stage

#: Cells that Ward merges; with no more distinct points, it works on these.
MICRO_CLUSTERS = 2048
DENDROGRAM_ROWS = 800


def scaled_vectors(df: DataFrame, features: Sequence[str] = S.SEGMENT_FEATURES,
                   name: str = "features") -> DataFrame:
    """Standardised features as a vector next to the raw columns."""
    scaler = M.fit_scaler(df, list(features))
    z = {f"z_{c}": (col(c).cast("double") - F.lit(scaler.means[c])) / F.lit(scaler.scales[c])
         for c in features}
    assembler = VectorAssembler(inputCols=list(z), outputCol=name)
    return assembler.transform(df.withColumns(z))


def kmeans(vectors: DataFrame, k: int = 4, seed: int = 42, cluster: str = "kmeans_cluster",
           max_iter: int = 300) -> tuple[DataFrame, KMeansModel]:
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol=cluster).fit(vectors)
    return model.transform(vectors), model


def centre_gaps(labelled: DataFrame, model: KMeansModel, cluster: str) -> DataFrame:
    """Rows of each cluster and the largest gap of a coordinate between centre and members' mean."""
    x, centres = vector_to_array("features"), model.clusterCenters()
    held = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    means = F.array(*[F.avg(x[i]) for i in range(len(centres[0]))])
    found = labelled.groupBy(col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), means.alias("mean"))
    gaps = F.zip_with("mean", held[F.col("cluster")], lambda a, b: F.abs(a - b))
    return found.select("cluster", "n", F.array_max(gaps).alias("gap"))


def nearest_centre(values: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest fixed centre, the first among equals."""
    distances = [
        F.struct(
            sum((v - F.lit(float(x))) * (v - F.lit(float(x))) for v, x in zip(values, centre))
            .alias("d"),
            F.lit(i).alias("i"),
        )
        for i, centre in enumerate(centres)
    ]
    return F.array_min(F.array(*distances))["i"]


def silhouettes_by_k(vectors: DataFrame, ks: Sequence[int] = (3, 4, 5, 6), seed: int = 42,
                     key: str = "user_id") -> DataFrame:
    """Silhouettes over all rows for several k: squared Euclidean, and Euclidean with its error."""
    rows = []
    # k-means and silhouettes work on narrow rows, so that their bytes would be few tasks
    with kept(spread(vectors.select(key, "features"), vectors.count())) as points:
        for k in ks:
            labelled, _ = kmeans(points, k, seed, "cluster")
            with kept(labelled) as held:
                plain = euclidean_silhouette(held, "cluster").first()
                rows.append((k, silhouette(held, "cluster").first()["silhouette"],
                             plain["silhouette"], plain["error"]))
    return small_frame(vectors.sparkSession, rows,
                       "k INT, silhouette DOUBLE, euclidean DOUBLE, euclidean_error DOUBLE")


def silhouette(labelled: DataFrame, cluster: str, features: str = "features") -> DataFrame:
    """Mean squared Euclidean silhouette of all rows, and their number, in linear time.

    The mean squared distance of a row to a cluster follows from the cluster's size, sum of
    points and sum of squares, so two passes of plain aggregates do; only those sums, one line
    per cluster, reach the driver. A row's own point never counts, and a row alone in its cluster,
    or without any other cluster, has 0. An empty table has a null silhouette.
    """
    points = labelled.select(col(cluster).alias("tag"), vector_to_array(features).alias("x"))
    first = points.select(F.size("x").alias("p")).first()
    x = [F.col("x")[i] for i in range(first["p"] if first else 0)]
    square = sum((v * v for v in x), F.lit(0.0))
    groups = points.groupBy("tag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"),
        *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]).collect()
    inner, outer = F.lit(None).cast("double"), [F.lit(None).cast("double")]
    for g in groups:
        product = sum((v * F.lit(g[f"s{i}"]) for i, v in enumerate(x)), F.lit(0.0))
        total = F.greatest(square * F.lit(g["n"]) - product * 2 + F.lit(g["q"]), F.lit(0.0))
        own = F.col("tag") == F.lit(g["tag"])
        inner = F.when(own & F.lit(g["n"] > 1), total / F.lit(max(g["n"] - 1, 1))).otherwise(inner)
        outer.append(F.when(~own, total / F.lit(g["n"])))
    pair = points.select(inner.alias("a"), F.array_min(F.array(*outer)).alias("b"))
    value = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)),
                       F.lit(0.0))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(value)
    return pair.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def ward_merges(points: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float, float]]:
    """Ward's merges of a bounded set of weighted points: (left, right, height, weight).

    Merge i makes cluster ``len(points) + i``; height is sqrt(2 wl wr / (wl + wr)) times
    the distance of the centres.
    """
    n = len(points)
    centre, weight = points.astype(float).copy(), weights.astype(float).copy()
    alive, number, level = np.ones(n, bool), np.arange(n), np.zeros(n)
    made, chain = [], []
    while len(made) < n - 1:
        # a chain of nearest neighbours ends in two that are each other's: they merge at any time
        if not chain:
            chain.append(int(alive.argmax()))
        i = chain[-1]
        cost = 2.0 * weight * weight[i] / (weight + weight[i]) * ((centre - centre[i]) ** 2).sum(1)
        cost[~alive] = np.inf
        cost[i] = np.inf
        j = int(cost.argmin())
        if len(chain) < 2 or cost[chain[-2]] > cost[j]:
            chain.append(j)
            continue
        i, j = sorted(chain[-2:])
        del chain[-2:]
        joined = weight[i] + weight[j]
        height = max(float(np.sqrt(cost[i if cost[j] == np.inf else j])), level[i], level[j])
        made.append((number[i], number[j], height, float(joined)))
        centre[i] = (centre[i] * weight[i] + centre[j] * weight[j]) / joined
        weight[i], number[i], level[i], alive[j] = joined, n + len(made) - 1, height, False
    order = np.argsort([m[2] for m in made], kind="stable")
    place = np.append(np.arange(n), n + np.argsort(order, kind="stable"))
    return [(*sorted((int(place[made[k][0]]), int(place[made[k][1]]))), *made[k][2:])
            for k in order]


def _groups(merges: list[tuple[int, int, float, float]], n: int, groups: int) -> list[int]:
    """Group of each starting point once only ``groups`` clusters are left."""
    home = list(range(n + len(merges)))

    def root(i: int) -> int:
        while home[i] != i:
            i = home[i]
        return i

    for step, (left, right, _, _) in enumerate(merges[: max(0, n - groups)]):
        home[root(left)] = home[root(right)] = n + step
    order: dict[int, int] = {}
    return [order.setdefault(root(i), len(order)) for i in range(n)]


def ward(vectors: DataFrame, groups: int = 4, micro: int = MICRO_CLUSTERS,
         cluster: str = "hclust_cluster") -> tuple[DataFrame, DataFrame]:
    """Ward groups of all rows, and the merge list of the cells that they are folded into.

    All-pairs linkage cannot grow with the rows, so passes over all rows split them into at most
    ``micro`` cells; Ward merges the cells' weighted centres, and every row takes the group of
    its cell. With up to ``micro`` distinct points each is a cell, and the groups are those of
    Ward over rows (whose further merges, of equal points, have height 0). Groups are numbered by
    their smallest cell; rows without features have a null group.
    """
    tags = pa.array([0], pa.int32())
    points = vectors.select(F.lit(0).alias("tag"), vector_to_array("features").alias("x"))
    points = stage(points.filter("x IS NOT NULL"), "ward-points")
    first = points.select(F.size("x").alias("width")).first()
    tree, cells = cells_of(points, tags[: 1 if first else 0], first["width"] if first else 0, micro)
    drop_staged(points)
    merges = ward_merges(cells.centre, cells.n)
    label = np.full(len(tree.axis) + 1, -1)
    label[cells.node] = _groups(merges, len(cells.n), groups)

    @F.pandas_udf("int")
    def group_of(x: pd.Series) -> pd.Series:
        out = pd.Series(pd.NA, index=x.index, dtype="Int32")
        some = x.notna().to_numpy()
        if some.any():
            rows = np.stack(x[some].to_list())
            out[some] = label[tree.find(np.zeros(len(rows), np.int64), rows)]
        return out

    table = small_frame(
        vectors.sparkSession, [(i, *m) for i, m in enumerate(merges)],
        "step INT, left_id INT, right_id INT, height DOUBLE, size DOUBLE",
    )
    return vectors.withColumn(cluster, group_of(vector_to_array("features"))), table


def ward_sample_merges(vectors: DataFrame, key: str = "user_id", rows: int = DENDROGRAM_ROWS,
                       seed: int = 42) -> DataFrame:
    """Dendrogram data: the merges of a bounded seeded sample, each row of weight one."""
    picked = M.seeded_sample(vectors.select(key, "features"), key, rows, seed).select(
        vector_to_array("features").alias("x")
    ).collect()
    points = np.array([r["x"] for r in picked], dtype=float)
    merges = ward_merges(points, np.ones(len(points)))
    return small_frame(
        vectors.sparkSession, [(i, *m) for i, m in enumerate(merges)],
        "step INT, left_id INT, right_id INT, height DOUBLE, size DOUBLE",
    )


def pca_coordinates(vectors: DataFrame, k: int = 2, keep: Sequence[str] = ("user_id",),
                    ) -> tuple[DataFrame, DataFrame]:
    """Coordinates on the first components, and the loadings.

    A component's sign is set so that its largest loading is positive.
    """
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(vectors)
    loadings = np.asarray(model.pc.toArray())
    flips = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0
             for j in range(k)]
    parts = vector_to_array("pca")
    rows = model.transform(vectors).select(
        *keep, *[(parts[j] * flips[j]).alias(f"pc{j + 1}") for j in range(k)]
    )
    share = [float(v) for v in model.explainedVariance.toArray()]
    table = small_frame(
        vectors.sparkSession,
        [(f"pc{j + 1}", i, float(loadings[i, j] * flips[j]), share[j])
         for j in range(k) for i in range(len(loadings))],
        "component STRING, feature INT, loading DOUBLE, explained DOUBLE",
    )
    return rows, table
