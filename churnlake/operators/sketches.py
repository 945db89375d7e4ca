"""Daily sketches of distinct counts and quantiles that merge over any span of days.

Each group and day keeps one HyperLogLog sketch per counted column and one KLL sketch per measured
column, of fixed size whatever the number of rows. Sketches of days, groups or runs merge to that
of all their rows. A count's relative standard error is 1.04 / sqrt(2 ** lg_k); the rank of a
quantile is off by at most about 2.3 / k ** 0.9 with 99 % probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.expressions import col

LG_K, K = 12, 200


def daily_sketches(df: DataFrame, at: str, by: Sequence[str] = (), distinct: Sequence[str] = (),
                   measured: Sequence[str] = (), lg_k: int = LG_K, k: int = K) -> DataFrame:
    """One row per group and day: rows ``n`` and a sketch per column; nulls are in no sketch.

    Folding starts on the map side, so a dominant group costs no more than any other. Store the
    rows with ``write_partitions(..., ["day"])``: a day that runs again replaces itself.
    """
    return df.groupBy(*map(col, by), F.to_date(col(at)).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(col(c), lg_k).alias(f"{c}_distinct") for c in distinct],
        *[F.kll_sketch_agg_double(col(c).cast("double"), F.lit(k)).alias(f"{c}_quantiles")
          for c in measured],
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, such as all days of a month or all groups together."""
    return sketches.groupBy(*map(col, by)).agg(
        F.sum("n").alias("n"),
        *[F.hll_union_agg(col(c)).alias(c) for c in sketches.columns if c.endswith("_distinct")],
        *[F.kll_merge_agg_double(col(c)).alias(c) for c in sketches.columns
          if c.endswith("_quantiles")],
    )


def sketch_summary(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75),
                   ) -> DataFrame:
    """Estimates in place of the sketches: a count, or an array with one value per probability.

    Quantiles are values of the column, not means of two; null where a group has no value.
    """
    def quantiles(c: str) -> Column:
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        some = F.kll_sketch_get_n_double(col(c)) > 0
        return F.when(some, F.kll_sketch_get_quantile_double(col(c), wanted))

    return sketches.withColumns({
        c: F.hll_sketch_estimate(col(c)) if c.endswith("_distinct") else quantiles(c)
        for c in sketches.columns if c.endswith(("_distinct", "_quantiles"))
    })
