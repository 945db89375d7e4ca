"""Sums and products of many columns in one pass, added up block by block in numpy.

With p columns there are about p * p sums. As SQL expressions they make generated code too long
to be compiled well; here each task turns its rows, a block at a time, into matrices, keeps only
the sums, and sends those through the shuffle. A lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.functions.expressions import col


def _filled(batch: pa.RecordBatch, names: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Columns as one matrix with 0 for null, and 1.0 where a value is present."""
    columns = [batch.column(n) for n in names]
    values = [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns]
    present = [c.is_valid().to_numpy(zero_copy_only=False) for c in columns]
    return np.stack(values, axis=1), np.stack(present, axis=1).astype(float)


def pair_sums(df: DataFrame, columns: Sequence[str],
              centres: Sequence[float]) -> dict[str, np.ndarray]:
    """For each pair (i, j) of columns, over rows that have both: n, sums of x, xx and xy.

    ``x`` is column i less its centre and y column j. Four matrices of p * p reach the driver.
    A NaN is a value, so sums that it is part of are NaN. Without rows all sums are 0.
    """
    p = len(columns)
    shift = np.array(centres, float)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, p, p))
        for batch in batches:
            values, present = _filled(batch, names)
            x = np.where(present > 0, values - shift, 0.0)
            total += [present.T @ present, x.T @ present, (x * x).T @ present, x.T @ x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
            ["place", "value"])

    names = [f"c{i}" for i in range(p)]
    rows = df.select(*[col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    sums = rows.mapInArrow(fold, "place INT, value DOUBLE").groupBy("place").agg(
        F.sum("value").alias("value")).toArrow()
    total = np.zeros(4 * p * p)
    total[sums["place"].to_numpy()] = sums["value"].to_numpy()
    return dict(zip(("n", "x", "xx", "xy"), total.reshape(4, p, p)))


def _by_time(times: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with equal times (duration, event) added up."""
    order = np.lexsort((times[:, 1], times[:, 0]))
    times, sums = times[order], sums[order]
    first = np.flatnonzero(np.append(True, (np.diff(times, axis=0) != 0).any(axis=1)))
    return times[first], np.add.reduceat(sums, first, axis=0)


def time_sums(df: DataFrame, duration: str, event: str, covariates: Sequence[str],
              means: Sequence[float], scales: Sequence[float],
              beta: Sequence[float]) -> DataFrame:
    """Per (duration, event): row count n, then sums of x, of w, of w x and of w x x'.

    ``x`` are the standardised covariates and w = exp(x'beta). The sums are named x0, x1, ...,
    w, wx0, ... and wx0_0, wx0_1, ... (upper triangle). Rows with a null in a used column do not
    count. A task holds the sums of its distinct times, days in practice, and a block of rows.
    """
    p = len(covariates)
    shift, scale, slope = (np.array(v, float) for v in (means, scales, beta))
    upper = np.triu_indices(p)
    names = [f"x{i}" for i in range(p)]
    made = [*names, "w", *[f"wx{i}" for i in range(p)],
            *[f"wx{i}_{j}" for i, j in zip(*upper)]]

    def lines(times: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        columns = [times[:, 0], times[:, 1], sums[:, 0].astype(np.int64), *sums[:, 1:].T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns],
                                          ["duration", "event", "n", *made])

    def stacked(batch: pa.RecordBatch, wanted: Sequence[str]) -> np.ndarray:
        return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in wanted], axis=1)

    def fold(batches: Iterator[pa.RecordBatch], of_rows: bool) -> Iterator[pa.RecordBatch]:
        times, sums = np.empty((0, 2), np.int64), np.empty((0, 1 + len(made)))
        for batch in batches:
            if not batch.num_rows:
                continue
            if of_rows:
                x = (stacked(batch, names) - shift) / scale
                w = np.exp(x @ slope)[:, None]
                new = np.hstack([np.ones_like(w), x, w, w * x, w * x[:, upper[0]] * x[:, upper[1]]])
            else:
                new = stacked(batch, ["n", *made])
            times, sums = _by_time(np.vstack([times, stacked(batch, ["duration", "event"])]),
                                   np.vstack([sums, new]))
        if len(times):
            yield lines(times, sums)

    rows = df.select(
        F.col(duration).cast("bigint").alias("duration"), F.col(event).cast("bigint").alias("event"),
        *[col(c).cast("double").alias(n) for n, c in zip(names, covariates)]).na.drop()
    schema = ", ".join(["duration BIGINT, event BIGINT, n BIGINT", *[f"{c} DOUBLE" for c in made]])
    return (
        rows.mapInArrow(lambda batches: fold(batches, True), schema)
        .repartition("duration")
        .mapInArrow(lambda batches: fold(batches, False), schema)
    )
