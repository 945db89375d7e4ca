"""Descriptive statistics, group rates, outliers, correlations and chart data."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions.exact import exact_avg
from churnlake.functions.expressions import col
from churnlake.operators import order_stats as O
from churnlake.operators.mlprep import centre_and_scale
from churnlake.operators.moments import pair_sums
from churnlake.sources.tables import ShopTables
from churnlake.session import small_frame

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def levels_frame(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    """A label dimension: one row per label with its position."""
    rows = [(label, i) for i, label in enumerate(labels)]
    return small_frame(df.sparkSession, rows, f"`{name}` STRING, position INT")


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, object],
                by: Sequence[str] = ()) -> DataFrame:
    """One pass over the rows, one result row per column; stats map a name to fn(column).

    None stands for the mean.
    """
    rows = F.array(*[
        F.struct(F.lit(c).alias("variable"), *[
            (fn(col(c)) if fn else mean_of(df, c)).alias(n) for n, fn in stats.items()])
        for c in columns
    ])
    return df.groupBy(*by).agg(rows.alias("rows")).select(*by, F.inline("rows"))


def mean_of(df: DataFrame, column: str) -> Column:
    """The mean as an aggregate: of whole numbers plain, of all others by exact sums."""
    whole = df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.avg(col(column)) if whole else exact_avg(col(column))


def table_shapes(tables: ShopTables) -> DataFrame:
    """Row and column count of every table that is present."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
        )
        for name, df in tables.present().items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def group_rate(df: DataFrame, key: str, target: str = "churn",
               labels: Sequence[str] | None = None) -> DataFrame:
    """Mean of a 0/1 target per group; with ``labels`` empty groups stay, without a rate."""
    rates = df.where(col(key).isNotNull()).groupBy(col(key).alias(key)).agg(
        F.avg(target).alias(f"{target}_rate"), F.count(F.lit(1)).alias("n")
    )
    if labels is None:
        return rates
    known = levels_frame(df, labels, key)
    return known.join(rates, key, "left").na.fill({"n": 0})


def overall_rate(df: DataFrame, target: str = "churn") -> DataFrame:
    return df.agg(F.avg(target).alias(f"{target}_rate"), F.count(F.lit(1)).alias("n"))


def rfm_profile(df: DataFrame) -> DataFrame:
    """Means, churn rate and size of each RFM bucket, empty buckets included."""
    means = df.groupBy("RFM_bucket").agg(
        F.avg("order_count").alias("order_count_mean"),
        exact_avg(F.col("total_spend")).alias("total_spend_mean"),
        F.avg("login_count").alias("login_count_mean"),
        F.avg("recency_days").alias("recency_days_mean"),
        F.avg("churn").alias("churn_rate"),
        F.count(F.lit(1)).alias("n"),
    )
    return levels_frame(df, S.RFM_LABELS, "RFM_bucket").join(means, "RFM_bucket", "left").na.fill(
        {"n": 0}
    )


def describe(df: DataFrame, columns: Sequence[str], accurate: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of each column."""
    moments = _per_column(df, columns, {
        "count": F.count, "mean": None,
        "std": lambda c: F.stddev_samp(c.cast("double")),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    })
    quarts = O.quantile_columns(df, columns, QUARTILES, accurate=accurate).drop("grp")
    return moments.join(quarts, "variable", "left")


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share (4 decimals) of missing values per column."""
    return _per_column(df, columns, {
        "missing_count": lambda c: F.count_if(c.isNull()),
        "missing_ratio": lambda c: F.round(F.avg(c.isNull().cast("int")), 4),
    })


def outliers(df: DataFrame, columns: Sequence[str], accurate: bool = True) -> DataFrame:
    """Values beyond 1.5 interquartile ranges: count, share (4 decimals), bounds (3)."""
    quarts = O.quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75}, accurate=accurate)
    step = (F.col("q3") - F.col("q1")) * 1.5
    bounds = {
        r["variable"]: (r["low"], r["high"])
        for r in quarts.select(
            "variable", (F.col("q1") - step).alias("low"), (F.col("q3") + step).alias("high")
        ).collect()
    }

    def row(c: str) -> Column:
        low, high = bounds.get(c, (None, None))
        outside = (col(c) < F.lit(low)) | (col(c) > F.lit(high))
        share = F.avg(outside.cast("int"))
        return F.struct(
            F.lit(c).alias("variable"),
            F.count_if(outside).alias("outlier_count"),
            F.round(F.coalesce(share, F.lit(0.0)), 4).alias("outlier_ratio"),
            F.round(F.lit(low).cast("double"), 3).alias("lower_bound"),
            F.round(F.lit(high).cast("double"), 3).alias("upper_bound"),
        )

    return df.agg(F.array(*[row(c) for c in columns]).alias("rows")).select(F.inline("rows"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over rows where both are present.

    A first pass finds the columns' centres; the second adds up the products of centred values,
    so that the sums stay small. NULL where a column is constant.
    """
    first = df.agg(*[
        F.struct(F.avg(v).alias("mean"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        for v in (col(c).cast("double") for c in columns)
    ]).first()
    flat = np.array([seen["lo"] == seen["hi"] for seen in first])
    sums = pair_sums(df, columns, [seen["mean"] or 0.0 for seen in first])
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = np.maximum(sums["xx"] - sums["x"] ** 2 / sums["n"], 0.0)
        shared = sums["xy"] - sums["x"] * sums["x"].T / sums["n"]
        found = shared / np.sqrt(spread * spread.T)
    known = (sums["n"] > 0) & (spread * spread.T != 0) & ~(flat[:, None] | flat)
    rows = [(a, b, float(found[i, j]) if known[i, j] else None)
            for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return small_frame(df.sparkSession, rows,
                       "variable_a STRING, variable_b STRING, corr DOUBLE")


def crosstab(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    """Counts of each level by the 0/1 target, for several columns in one pass."""
    entries = [
        F.struct(F.lit(c).alias("variable"), col(c).cast("string").alias("level"))
        for c in columns
    ]
    return (
        df.select(col(target).alias("target"), F.inline(F.array(*entries)))
        .where(F.col("level").isNotNull())
        .groupBy("variable", "level")
        .agg(
            F.count_if(F.col("target") == 0).alias("n_active"),
            F.count_if(F.col("target") == 1).alias("n_churned"),
        )
    )


def class_centres(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    """Mean and median of each column by class."""
    means = _per_column(df, columns, {"n": F.count, "mean": None}, [target])
    mid = O.quantile_columns(df, columns, {"median": 0.5}, by=target).withColumnRenamed(
        "grp", target
    )
    return means.join(mid, [target, "variable"], "left")


def cohort_summary(snapshot_rows: DataFrame) -> DataFrame:
    """Size, label rate, share and medians of all users and of the cohort, per date."""
    parts = F.array_compact(F.array(
        F.lit("full"), F.when(F.col("is_male_20s30s") == 1, F.lit("cohort"))
    ))
    rows = snapshot_rows.withColumn("part", F.explode(parts)).withColumn(
        "block", F.concat_ws("|", F.col("snapshot_ref_date").cast("string"), F.col("part"))
    )
    shape = rows.groupBy("block").agg(
        F.min("snapshot_ref_date").alias("snapshot_ref_date"), F.min("part").alias("part"),
        F.count(F.lit(1)).alias("n_rows"), F.avg("churn_90d").alias("label_rate"),
    )
    totals = shape.where("part = 'full'").select(
        "snapshot_ref_date", F.col("n_rows").alias("n_full")
    )
    mid = O.quantiles(rows, S.SNAPSHOT_MEDIANS, [0.5], by="block").groupBy(
        F.col("grp").alias("block")
    ).pivot("variable", list(S.SNAPSHOT_MEDIANS)).agg(F.max("quantile"))
    named = mid.select("block", *[F.col(c).alias(f"median_{c}") for c in S.SNAPSHOT_MEDIANS])
    return (
        shape.join(totals, "snapshot_ref_date").join(named, "block", "left")
        .withColumn("n_columns", F.lit(len(S.SNAPSHOT_COLUMNS)))
        .withColumn("share", F.col("n_rows") / F.greatest(F.col("n_full"), F.lit(1)))
        .drop("block", "n_full")
    )


def cluster_summary(df: DataFrame, cluster: str, features: Sequence[str],
                    target: str = "churn") -> DataFrame:
    """Means and medians of the features, target rate and size of each cluster."""
    means = df.groupBy(cluster).agg(
        *[mean_of(df, c).alias(f"{c}_mean") for c in features],
        F.avg(target).alias(f"{target}_rate"), F.count(F.lit(1)).alias("size"),
    )
    mid = O.quantiles(df, features, [0.5], by=cluster).groupBy(
        F.col("grp").alias(cluster)
    ).pivot("variable", list(features)).agg(F.max("quantile"))
    named = mid.select(cluster, *[F.col(c).alias(f"{c}_median") for c in features])
    return means.join(named, cluster, "left")


def cluster_z(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Cluster means as z-scores over the clusters (population deviation, 0 -> 1)."""
    means = df.groupBy(cluster).agg(*[mean_of(df, c).alias(c) for c in features])
    found = centre_and_scale(means, features)

    def z(c: str) -> Column:
        return ((F.col(c) - F.lit(found[c][0])) / F.lit(found[c][1])).alias(c)

    return means.select(cluster, *[z(c) for c in features])


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum; the last bin is closed."""
    spans = _per_column(df, columns, {
        "lo": lambda c: F.min(c).cast("double"), "hi": lambda c: F.max(c).cast("double")
    }).where(F.col("lo").isNotNull()).collect()
    single = {r["variable"]: r["lo"] == r["hi"] for r in spans}
    ranges = [
        (r["variable"], r["lo"] - 0.5 * single[r["variable"]],
         r["hi"] + 0.5 * single[r["variable"]])
        for r in spans
    ]
    spark = df.sparkSession
    extent = small_frame(spark, ranges, "variable STRING, lo DOUBLE, hi DOUBLE")
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        O.long_form(df, columns).join(F.broadcast(extent), "variable")
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    frame = extent.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, ["variable", "bin"], "left").na.fill({"n": 0}).select(
        "variable", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n"
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per level of each column; a missing level shows as 'nan'."""
    entries = [
        F.struct(
            F.lit(c).alias("variable"),
            F.coalesce(col(c).cast("string"), F.lit("nan")).alias("level"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*entries))).groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("n")
    )


def box_summary(df: DataFrame, columns: Sequence[str], target: str = "churn") -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (the outermost values within) by class."""
    quarts = O.quantile_columns(df, columns, QUARTILES, by=target).collect()
    spark = df.sparkSession
    table = small_frame(
        spark, [(r["grp"], r["variable"], r["q1"], r["median"], r["q3"]) for r in quarts],
        "grp INT, variable STRING, q1 DOUBLE, median DOUBLE, q3 DOUBLE",
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    value = F.col("value").cast("double")
    low = F.when(value >= F.col("q1") - reach, value)
    high = F.when(value <= F.col("q3") + reach, value)
    beyond = (value < F.col("q1") - reach) | (value > F.col("q3") + reach)
    return (
        O.long_form(df, columns, target).join(F.broadcast(table), ["grp", "variable"])
        .groupBy(F.col("grp").alias(target), "variable", "q1", "median", "q3")
        .agg(F.min(low).alias("whisker_low"), F.max(high).alias("whisker_high"),
             F.count_if(beyond).alias("fliers"))
    )


def bottom_and_top(df: DataFrame, order: str, key: str, k: int) -> DataFrame:
    """The k highest and the k lowest rows by a column, ties by key, as two parts."""
    top = df.orderBy(F.col(order).desc(), F.col(key)).limit(k)
    bottom = df.orderBy(F.col(order), F.col(key).desc()).limit(k)
    return top.withColumn("part", F.lit("top")).unionByName(
        bottom.withColumn("part", F.lit("bottom"))
    )
