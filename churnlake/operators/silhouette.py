"""Euclidean silhouettes of all rows, within an error that comes with the result.

Mean plain distances have no closed form, unlike squared ones. So the points of each cluster are
split into cells, round by round, where the cells' points and spread promise most; one pass of
aggregates measures all cells of a round. Then every row meets every cell: the mean distance to
a cell's points lies between the distance d of its centre and sqrt(d^2 + r^2) for its mean squared
radius r^2, so each row's value lies in an interval. A cell of equal points has no radius and
gives exact distances; where all cells are such, so is the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.exact import exact_avg
from churnlake.functions.expressions import col
from churnlake.session import drop_staged, spread, stage

#: Cells that every row is compared with; more make the error smaller and the passes longer.
MAX_CELLS = 4096
_ROWS = 32


class CellTree:
    """Cells as leaves of binary cuts, one root per cluster; child ``left + 1`` has the larger x."""

    def __init__(self, clusters: int):
        self.axis = np.full(clusters, -1)
        self.cut = np.zeros(clusters)
        self.left = np.zeros(clusters, np.int64)
        self.root = np.arange(clusters)

    def find(self, cluster: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Leaf of each point."""
        node = cluster.copy()
        while len(inner := np.flatnonzero(self.axis[node] >= 0)):
            at = node[inner]
            node[inner] = self.left[at] + (x[inner, self.axis[at]] >= self.cut[at])
        return node

    def split(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Cut leaves with these bounds in the middle of their widest axis; no part is empty."""
        axis = (high - low).argmax(axis=1)
        a, b = (m[np.arange(len(nodes)), axis] for m in (low, high))
        middle = a + (b - a) / 2
        first = len(self.axis)
        self.axis[nodes], self.cut[nodes] = axis, np.where(middle > a, middle, b)
        self.left[nodes] = first + 2 * np.arange(len(nodes))
        self.axis = np.append(self.axis, np.full(2 * len(nodes), -1))
        self.cut = np.append(self.cut, np.zeros(2 * len(nodes)))
        self.left = np.append(self.left, np.zeros(2 * len(nodes), np.int64))
        self.root = np.append(self.root, np.repeat(self.root[nodes], 2))


class Cells:
    """What one round measured: leaves with size, centre, bounds and mean squared radius."""

    def __init__(self, rows: Sequence, width: int):
        rows = sorted(rows, key=lambda r: r["node"])
        self.node = np.array([r["node"] for r in rows], np.int64)
        self.n = np.array([r["n"] for r in rows], float)
        total, square, low, high = (
            np.array([[r[f"{kind}{j}"] for j in range(width)] for r in rows]).reshape(-1, width)
            for kind in ("s", "q", "lo", "hi"))
        self.low, self.high = low, high
        mean = np.clip(total / self.n[:, None], low, high)
        spread = np.clip(square / self.n[:, None] - mean ** 2, 0, (high - low) ** 2 / 4)
        self.centre, self.radius = mean, spread.sum(axis=1)


def _points(batch: pa.RecordBatch, tags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    cluster = pc.index_in(batch.column(0), value_set=tags).to_numpy(zero_copy_only=False)
    x = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return cluster.astype(np.int64), x.reshape(batch.num_rows, -1)


def _measured(points: DataFrame, tags: pa.Array, tree: CellTree, width: int) -> Cells:
    """One pass over all points: the cells as the tree has them."""
    fields = [f"{kind}{j}" for kind in ("s", "q", "lo", "hi") for j in range(width)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(tree.axis)
        n, s, q = np.zeros(size), np.zeros((width, size)), np.zeros((width, size))
        low, high = np.full((width, size), np.inf), np.full((width, size), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            cluster, x = _points(batch, tags)
            node = tree.find(cluster, x)
            n += np.bincount(node, minlength=size)
            for j in range(width):
                s[j] += np.bincount(node, x[:, j], size)
                q[j] += np.bincount(node, x[:, j] ** 2, size)
                np.minimum.at(low[j], node, x[:, j])
                np.maximum.at(high[j], node, x[:, j])
        some = np.flatnonzero(n)
        columns = [pa.array(v[some]) for kind in (s, q, low, high) for v in kind]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some].astype(np.int64)), *columns],
            names=["node", "n", *fields])

    how = {"s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}
    rows = points.mapInArrow(
        measure, "node BIGINT, n BIGINT, " + ", ".join(f"{f} DOUBLE" for f in fields))
    return Cells(rows.groupBy("node").agg(
        F.sum("n").alias("n"),
        *[how[f.rstrip("0123456789")](f).alias(f) for f in fields]).collect(), width)


def cells_of(points: DataFrame, tags: pa.Array, width: int,
             max_cells: int) -> tuple[CellTree, Cells]:
    """Cells of the points (tag, x): split by number times width until all are points or used up."""
    tree = CellTree(len(tags))
    cells = Cells([], max(width, 1))
    while len(tags):
        cells = _measured(points, tags, tree, width)
        worth = cells.n * np.sqrt(((cells.high - cells.low) ** 2).sum(axis=1))
        order = np.argsort(-worth, kind="stable")[:max(0, max_cells - len(cells.n))]
        chosen = np.sort(order[worth[order] > 0])
        if not len(chosen):
            break
        tree.split(cells.node[chosen], cells.low[chosen], cells.high[chosen])
    return tree, cells


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.maximum(a, b)
    return np.divide(b - a, most, out=np.zeros_like(most), where=most > 0)


def row_intervals(cluster: np.ndarray, x: np.ndarray, cells: Cells, of: np.ndarray,
                  sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest silhouette of each row; ``of`` is each cell's cluster, in order."""
    starts = np.searchsorted(of, np.arange(len(sizes)))
    square = np.zeros((len(x), len(of)))
    for j in range(x.shape[1]):
        gap = x[:, [j]] - cells.centre[:, j]
        gap *= gap
        square += gap
    bounds = []
    for far in (square + cells.radius, square):      # in place, so the plain ones last
        np.sqrt(far, out=far)
        far *= cells.n
        bounds.insert(0, np.add.reduceat(far, starts, axis=1))
    row = np.arange(len(x))
    own = [b[row, cluster] / np.maximum(sizes[cluster] - 1, 1) for b in bounds]
    other = [b / sizes for b in bounds]
    for b in other:
        b[row, cluster] = np.inf
    near = [b.min(axis=1) for b in other]
    alone = (sizes[cluster] < 2) | (len(sizes) < 2)
    near = [np.where(alone, 0.0, b) for b in near]
    low, high = _between(own[1], near[0]), _between(own[0], near[1])
    return np.where(alone, 0.0, low), np.where(alone, 0.0, high)


def euclidean_silhouette(labelled: DataFrame, cluster: str, features: str = "features",
                         max_cells: int = MAX_CELLS) -> DataFrame:
    """Mean Euclidean silhouette of all rows: silhouette, error, n, cells.

    The true mean lies within ``error`` of ``silhouette`` (rounding aside). Only the cells, at most
    ``max_cells``, reach the driver and the tasks; with up to that many distinct points per
    cluster together, the error is 0. A row alone in its cluster, or without any other cluster,
    has 0; rows with a null cluster are a cluster; rows without features are left out. An
    empty table has a null silhouette. More clusters than cells raise an error.
    """
    points = labelled.select(col(cluster).alias("tag"),
                             vector_to_array(features).alias("x")).filter("x IS NOT NULL")
    points = stage(spread(points, labelled.count()), "silhouette-points")
    found = points.groupBy("tag").agg(F.count(F.lit(1)).alias("n"),
                                      F.max(F.size("x")).alias("width")).limit(max_cells + 1)
    found = found.toArrow()
    if found.num_rows > max_cells:
        raise ValueError(f"more clusters than the {max_cells} cells")
    tags = found["tag"].combine_chunks()
    sizes = found["n"].to_numpy().astype(float)
    width = max(found["width"].to_pylist(), default=0)
    tree, cells = cells_of(points, tags, width, max_cells)
    of = tree.root[cells.node] if len(cells.node) else np.empty(0, np.int64)
    order = np.lexsort((*cells.centre.T, of))
    cells.n, cells.centre, cells.radius = cells.n[order], cells.centre[order], cells.radius[order]
    of = of[order]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                own, x = _points(batch.slice(start, _ROWS), tags)
                low, high = row_intervals(own, x, cells, of, sizes)
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)],
                                                 names=["low", "high"])

    rows = points.mapInArrow(scored, "low DOUBLE, high DOUBLE")
    low, high = exact_avg(F.col("low")), exact_avg(F.col("high"))
    out = stage(rows.agg(((low + high) / 2).alias("silhouette"), ((high - low) / 2).alias("error"),
                         F.count(F.lit(1)).alias("n"),
                         F.lit(len(cells.n)).cast("bigint").alias("cells")), "silhouette")
    drop_staged(points)
    return out
