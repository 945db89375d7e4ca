"""Centroid clustering over a VA-file: cells of a few bits decide, vectors settle overlaps.

Vectors become whole numbers. Every dimension is cut into ``2 ** bits`` cells of about equal
population, and a vector's cells are packed into a few bytes, its approximation. Per centroid,
lookup tables hold the least and greatest squared distance that a byte's cells allow, so a
vector's distance to each centroid lies in an interval that is the sum of a few table entries.
Only centroids whose interval overlaps the best one are compared on the full vector.

The blocks of the file hold approximations and vectors side by side and stay where they were
written: a round is one pass over them and sends back a sum per centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.tasks import lean
from churnlake.session import drop_staged, small_frame, stage

BITS = 4
BLOCK_ROWS = 4096
#: Components beyond this would not leave room for exact 64-bit distances.
MAX_COMPONENT = 1 << 27
#: Bins of an octave when the cells' edges are chosen.
_SUB = 8


def _bins(values: np.ndarray) -> np.ndarray:
    """A number in order of the value: own bins for small values, eight an octave beyond."""
    size = np.abs(values)
    octave = np.maximum(np.frexp(size.astype(float))[1] - 4, 0)     # 0 for sizes below 16
    bins = octave * _SUB + (size >> octave)
    return np.where(values < 0, -bins - 1, bins)


def _bin_ends(bins: np.ndarray) -> np.ndarray:
    """The greatest value of each bin."""
    size = np.where(bins < 0, -bins - 1, bins)
    octave = np.maximum(size // _SUB - 1, 0)
    first = (size - octave * _SUB) << octave
    return np.where(bins < 0, -first, first + (1 << octave) - 1)


@dataclass(frozen=True)
class Cells:
    """Least and greatest value of each cell: two arrays (dimensions, cells)."""

    low: np.ndarray
    high: np.ndarray
    bits: int

    def approximate(self, vectors: np.ndarray) -> np.ndarray:
        """Packed cell numbers of whole-number vectors, ``8 / bits`` dimensions a byte."""
        per_byte = 8 // self.bits
        out = np.zeros((len(vectors), -(-vectors.shape[1] // per_byte)), np.uint8)
        for d in range(vectors.shape[1]):
            cell = np.searchsorted(self.high[d, :-1], vectors[:, d], side="left")
            out[:, d // per_byte] |= (cell << (d % per_byte * self.bits)).astype(np.uint8)
        return out

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per byte place, byte value and centroid: bounds of the squared distance."""
        k, dims = centroids.shape
        per_byte, mask = 8 // self.bits, (1 << self.bits) - 1
        places = -(-dims // per_byte)
        least, most = (np.zeros((places, 256, k), np.int64) for _ in range(2))
        for d in range(dims):
            below = self.low[d][:, None] - centroids[:, d][None, :]     # (cells, centroids)
            above = centroids[:, d][None, :] - self.high[d][:, None]
            near = np.maximum(np.maximum(below, above), 0) ** 2
            far = np.maximum(np.abs(below), np.abs(above)) ** 2
            cell = np.arange(256) >> (d % per_byte * self.bits) & mask
            least[d // per_byte] += near[cell]
            most[d // per_byte] += far[cell]
        return least, most


def assign(cells: np.ndarray, vectors: np.ndarray, centroids: np.ndarray,
           tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """Nearest centroid of each vector (ties: the smaller number), and exact distances taken."""
    least, most = (np.zeros((len(cells), len(centroids)), np.int64) for _ in range(2))
    for place in range(cells.shape[1]):
        least += tables[0][place][cells[:, place]]
        most += tables[1][place][cells[:, place]]
    open_ = least <= most.min(axis=1)[:, None]
    found = np.argmax(open_, axis=1)
    unsure = np.flatnonzero(open_.sum(axis=1) > 1)
    if not len(unsure):
        return found, 0
    exact = np.full((len(unsure), len(centroids)), np.iinfo(np.int64).max)
    taken = 0
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[unsure, k])
        exact[rows, k] = ((vectors[unsure[rows]].astype(np.int64) - centroid) ** 2).sum(axis=1)
        taken += len(rows)
    found[unsure] = np.argmin(exact, axis=1)
    return found, taken


def _parts(batch: pa.RecordBatch, at: int, width: int, dims: int):
    """Row, approximations and vectors of the blocks of a batch."""
    for row in range(batch.num_rows):
        cells = np.frombuffer(batch.column(at)[row].as_py(), np.uint8)
        vectors = np.frombuffer(batch.column(at + 1)[row].as_py(), np.int32)
        yield row, cells.reshape(-1, width), vectors.reshape(-1, dims)


class VAFile:
    """Approximations and vectors in staged blocks, with the cells they were made by.

    ``ids`` are any type; rows without an id and repeated rows are vectors like any other.
    """

    def __init__(self, blocks: DataFrame, cells: Cells, dims: int, id_type: str):
        self.blocks, self.cells, self.dims, self.id_type = blocks, cells, dims, id_type

    @classmethod
    def build(cls, vectors: DataFrame, dims: int, bits: int = BITS) -> VAFile:
        """Cells from counts of all components, then blocks in one pass.

        ``vectors`` has ``id`` and ``v``, an array of ``dims`` whole numbers without nulls.
        """
        if bits not in (1, 2, 4, 8):
            raise ValueError("bits must divide a byte")
        cells = _choose_cells(vectors, dims, bits)
        kind = dict(vectors.dtypes)["id"]

        @lean
        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(start, BLOCK_ROWS)
                    rows = _matrix(part.column(1), dims)
                    ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()),
                                                   part.column(0))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([cells.approximate(rows).tobytes()], pa.binary()),
                         pa.array([rows.astype(np.int32).tobytes()], pa.binary())],
                        names=["ids", "cells", "vectors"])

        made = vectors.select("id", "v").mapInArrow(
            blocks, f"ids ARRAY<{kind}>, cells BINARY, vectors BINARY")
        return cls(stage(made, "va-file"), cells, dims, kind)

    def sums(self, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]], int]:
        """Members and exact component sums of every centroid, and exact distances taken."""
        tables, k = self.cells.tables(centroids), len(centroids)
        width, dims = tables[0].shape[0], self.dims

        @lean
        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total, taken = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
            for batch in batches:
                for _, cells, vectors in _parts(batch, 0, width, dims):
                    found, exact = assign(cells, vectors, centroids, tables)
                    taken += exact
                    count += np.bincount(found, minlength=k)
                    for own in np.unique(found):
                        total[own] += vectors[found == own].sum(axis=0, dtype=np.int64)
            at = np.repeat(np.arange(k + 1), [dims + 1] * k + [1])
            place = np.append(np.tile(np.arange(dims + 1), k), 0)
            values = np.append(np.column_stack([total, count]).reshape(-1), taken)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(place.astype(np.int32)),
                 pa.array(values)], names=["cluster", "place", "x"])

        rows = self.blocks.select("cells", "vectors").mapInArrow(
            fold, "cluster INT, place INT, x BIGINT")
        got = {(r[0], r[1]): int(r[2]) for r in
               rows.groupBy("cluster", "place").agg(F.sum("x")).collect()}
        members = np.array([got.get((c, dims), 0) for c in range(k)], np.int64)
        return members, [[got.get((c, d), 0) for d in range(dims)] for c in range(k)], got.get(
            (k, 0), 0)

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """Row per vector: id, cluster, distance (squared, exact)."""
        tables, dims = self.cells.tables(centroids), self.dims
        width = tables[0].shape[0]

        @lean
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, cells, vectors in _parts(batch, 1, width, dims):
                    found, _ = assign(cells, vectors, centroids, tables)
                    far = ((vectors.astype(np.int64) - centroids[found]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(row, 1).flatten(),
                         pa.array(found.astype(np.int32)), pa.array(far)],
                        names=["id", "cluster", "distance"])

        return self.blocks.mapInArrow(
            rows, f"id {self.id_type}, cluster INT, distance BIGINT")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _choose_cells(vectors: DataFrame, dims: int, bits: int) -> Cells:
    """Cells of about equal population from the counts of all components in fixed bins.

    A task sends at most some 430 bins a dimension, and so do all tasks together.
    """
    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            for d in range(dims if len(rows) else 0):
                bins, n = np.unique(_bins(rows[:, d]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bins), d, np.int32)), pa.array(bins.astype(np.int32)),
                     pa.array(n.astype(np.int64)),
                     pa.array(np.full(len(bins), rows[:, d].min())),
                     pa.array(np.full(len(bins), rows[:, d].max()))],
                    names=["d", "bin", "n", "lo", "hi"])

    found = (vectors.select("v").mapInArrow(count, "d INT, bin INT, n BIGINT, lo BIGINT, hi BIGINT")
             .groupBy("d", "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"),
                                      F.max("hi").alias("hi")).toPandas())
    n_cells = 1 << bits
    low, high = np.zeros((dims, n_cells), np.int64), np.zeros((dims, n_cells), np.int64)
    for d in range(dims):
        mine = found[found["d"] == d].sort_values("bin")
        if not len(mine):
            continue
        lo, hi = int(mine["lo"].min()), int(mine["hi"].max())
        upto = np.cumsum(mine["n"].to_numpy())
        cut = np.searchsorted(upto, upto[-1] * np.arange(1, n_cells) / n_cells)
        edges = np.minimum(_bin_ends(mine["bin"].to_numpy().astype(np.int64))[cut], hi)
        high[d] = np.append(edges, hi)
        low[d] = np.minimum(np.append(lo, edges + 1), high[d])
    return Cells(low, high, bits)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: int
                  ) -> DataFrame:
    """``id`` and ``v``, floor(scale * component), of the vectors that can be compared.

    Kept are vectors of exactly ``dims`` components, none of them null, NaN or infinite.
    """
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter((F.size(vector_col) == dims) & good)
    value = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))
    over = F.exists(value, lambda x: F.abs(x) >= MAX_COMPONENT)
    checked = F.when(over, F.raise_error(F.lit(
        "a component is too large for exact 64-bit distances")).cast("array<bigint>")).otherwise(value)
    return kept.select(F.col(id_col).alias("id"), checked.alias("v"))


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1,
            bits: int = BITS) -> DataFrame:
    """Clusters of all vectors after ``rounds`` exact rounds of the means.

    Result: the id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``. Vectors of another length or with a null, NaN or infinite component are
    left out; a component whose whole number reaches 2 ** 27 raises. Centroids start as the ``k``
    vectors with the smallest sha256 of ``seed:id`` (equal ids: the smaller vector first; null
    ids last), all vectors if there are fewer; an empty table gives no rows. Repeated rows are
    vectors of their own. Only the two named columns are read.
    """
    whole = whole_vectors(rows, id_col, vector_col, dims, scale)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = (whole.withColumn("drawn", drawn).orderBy(F.col("drawn").asc_nulls_last(), "v")
             .limit(k).collect())
    file = VAFile.build(whole, dims, bits)
    centroids = [list(r["v"]) for r in first]
    for _ in range(rounds if first else 0):
        members, totals, _ = file.sums(np.array(centroids, np.int64))
        centroids = [[t // int(n) for t in total] if n else old
                     for n, total, old in zip(members, totals, centroids)]
    final = np.array(centroids, np.int64).reshape(-1, dims)
    spark = rows.sparkSession
    if not len(final):
        return spark.createDataFrame([], f"`{id_col}` {file.id_type}, cluster INT, distance "
                                     "BIGINT, cluster_inertia BIGINT, inertia BIGINT, "
                                     "centroid_sha256 STRING")
    found = stage(file.assigned(final), "va-assigned")
    drop_staged(file.blocks)
    inertia = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}
    facts = small_frame(spark, [
        (c, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode())
         .hexdigest()) for c, n in sorted(inertia.items())],
        "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
