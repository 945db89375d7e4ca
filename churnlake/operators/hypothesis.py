"""Tests of each variable against the churn label.

The rows are reduced to one line of sums per variable on the cluster; only the p-value
of that line is worked out on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions import pvalues as P
from churnlake.functions.expressions import col
from churnlake.operators import explore as X
from churnlake.operators import order_stats as O
from churnlake.operators import ranking as R
from churnlake.session import small_frame

#: Rows of the smaller class up to which the rank test counts all orders.
EXACT_ROWS = 8


def chi_square_statistics(df: DataFrame, columns: Sequence[str],
                          target: str = "churn") -> DataFrame:
    """Chi-square of independence; with one degree of freedom the deviations are
    reduced by up to a half (continuity correction). Variables with a single row or
    column give no result."""
    cells = X.crosstab(df, columns, target)
    mine = Window.partitionBy("variable")
    both = cells.select(
        "variable",
        F.count(F.lit(1)).over(mine).alias("n_rows"),
        F.sum("n_active").over(mine).alias("sum_active"),
        F.sum("n_churned").over(mine).alias("sum_churned"),
        (F.col("n_active") + F.col("n_churned")).alias("row_sum"),
        "n_active", "n_churned",
    ).where("n_rows > 1 AND sum_active > 0 AND sum_churned > 0")
    total = F.col("sum_active") + F.col("sum_churned")
    dof = F.col("n_rows") - 1

    def share(observed: str, column_sum: str):
        expected = F.col("row_sum") * F.col(column_sum).cast("double") / total
        gap = F.abs(F.col(observed) - expected)
        corrected = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return corrected * corrected / expected

    return both.groupBy("variable", "n_rows").agg(
        F.sum(share("n_active", "sum_active") + share("n_churned", "sum_churned")).alias("chi2")
    ).select("variable", "chi2", dof.alias("dof"), "n_rows", F.lit(2).alias("n_columns"))


def chi_square(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    rows = chi_square_statistics(df, columns, target).collect()
    return small_frame(
        df.sparkSession, [(*r, P.chi_square_tail(r["chi2"], r["dof"])) for r in rows],
        "variable STRING, chi2 DOUBLE, dof BIGINT, n_rows BIGINT, n_columns INT, p_value DOUBLE",
    )


def welch_statistics(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    """Welch's t and its degrees of freedom; both classes need more than one value."""

    def row(c: str):
        a = F.when(col(target) == 0, col(c).cast("double"))
        b = F.when(col(target) == 1, col(c).cast("double"))
        return F.struct(
            F.lit(c).alias("variable"),
            F.count(a).alias("n_a"), F.count(b).alias("n_b"),
            F.avg(a).alias("mean_active"), F.avg(b).alias("mean_churned"),
            F.var_samp(a).alias("var_a"), F.var_samp(b).alias("var_b"),
        )

    sums = df.agg(F.array(*[row(c) for c in columns]).alias("rows")).select(F.inline("rows"))
    se_a, se_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    spread = se_a + se_b
    freedom = F.try_divide(
        spread * spread,
        se_a * se_a / (F.col("n_a") - 1) + se_b * se_b / (F.col("n_b") - 1),
    )
    return sums.where("n_a > 1 AND n_b > 1").select(
        "variable",
        F.try_divide(F.col("mean_active") - F.col("mean_churned"), F.sqrt(spread)).alias("t"),
        freedom.alias("dof"), "mean_active", "mean_churned",
    )


def welch(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    rows = welch_statistics(df, columns, target).collect()

    def p(r) -> float | None:
        return None if r["t"] is None else P.student_two_sided(r["t"], r["dof"])

    return small_frame(
        df.sparkSession, [(*r, p(r)) for r in rows],
        "variable STRING, t DOUBLE, dof DOUBLE, mean_active DOUBLE, mean_churned DOUBLE, "
        "p_value DOUBLE",
    )


def mann_whitney_statistics(df: DataFrame, columns: Sequence[str],
                            target: str = "churn") -> DataFrame:
    """U of the active class and its normal score with tie and continuity correction.

    Rows fold to counts per distinct value before they are ranked, so a value shared
    by many users is one row.
    """
    pairs = O.long_form(df.where(col(target).isin(0, 1)), columns, target)
    counts = pairs.groupBy("variable", "value").agg(
        F.count_if(F.col("grp") == 0).alias("a"), F.count_if(F.col("grp") == 1).alias("b"),
    ).withColumn("t", F.col("a") + F.col("b"))
    placed = R.running_sums(
        counts, "value", ["t"], *R.split_points(pairs, "value"), by=["variable"]
    )
    t = F.col("t").cast("double")
    rank = F.col("cum_t") - (F.col("t") - 1) / 2
    sums = placed.groupBy("variable").agg(
        F.sum("a").cast("double").alias("n1"), F.sum("b").cast("double").alias("n2"),
        F.sum(F.col("a") * rank).alias("r1"), F.sum(t * t * t - t).alias("tie_term"),
    ).where("n1 > 1 AND n2 > 1")
    n = F.col("n1") + F.col("n2")
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    mean = F.col("n1") * F.col("n2") / 2
    deviation = F.sqrt(
        F.col("n1") * F.col("n2") / 12 * ((n + 1) - F.col("tie_term") / (n * (n - 1)))
    )
    larger = F.greatest(u, F.col("n1") * F.col("n2") - u)
    return sums.select(
        "variable", u.alias("u"),
        F.try_divide(larger - mean - 0.5, deviation).alias("z"),
        F.col("n1").cast("bigint").alias("n_active"),
        F.col("n2").cast("bigint").alias("n_churned"),
        (F.col("tie_term") > 0).alias("tied"),
    )


def mann_whitney(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    """The test with its two-sided p-value and the class medians.

    The p-value is exact where a class has at most ``EXACT_ROWS`` rows and no values are tied,
    and that of the normal approximation elsewhere.
    """
    rows = mann_whitney_statistics(df, columns, target).collect()
    mid = {
        (r["grp"], r["variable"]): r["quantile"]
        for r in O.quantiles(df, columns, [0.5], by=target).collect()
    }

    def p(r) -> float | None:
        if not r["tied"] and min(r["n_active"], r["n_churned"]) <= EXACT_ROWS:
            return P.mann_whitney_exact(round(r["u"]), r["n_active"], r["n_churned"])
        return None if r["z"] is None else min(1.0, P.normal_two_sided(max(r["z"], 0.0)))

    return small_frame(
        df.sparkSession, [(*r[:-1], p(r), mid.get((0, r["variable"])), mid.get((1, r["variable"])))
                          for r in rows],
        "variable STRING, u DOUBLE, z DOUBLE, n_active BIGINT, n_churned BIGINT, "
        "p_value DOUBLE, median_active DOUBLE, median_churned DOUBLE",
    )
