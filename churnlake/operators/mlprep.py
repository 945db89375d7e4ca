"""Preparation of features for the models: splits, scaling, dummies, weights, imputation.

Everything fitted (means, levels, medians, weights) is a short list of numbers taken
from the training rows; applying it is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.expressions import col
from churnlake.operators import order_stats as O
from churnlake.session import kept

MAX_LEVELS = 1000
HASH_HEX_DIGITS = 13      # 52 bits, exact in a double


def seeded_hash(key: str, seed: int) -> Column:
    """A number in [0, 2^52) fixed by the row's id and the seed, whatever the partitioning."""
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def split(df: DataFrame, key: str, label: str, test_share: float, seed: int = 42,
          exact: bool = False) -> DataFrame:
    """Adds ``split`` ('train' or 'test'), stratified by label.

    By default a row is drawn by its own hash, which needs no pass over the data and
    gives each class the share up to chance. ``exact`` draws the rows with the smallest
    hashes so that every class gets its rounded share; the hash at which a class's
    draw ends is found by exact selection.
    """
    drawn = seeded_hash(key, seed)
    if not exact:
        limit = int(test_share * 16**HASH_HEX_DIGITS)
        return df.withColumn("split", F.when(drawn < limit, "test").otherwise("train"))
    with kept(df.select(col(label).alias("__label"), drawn.alias("__hash"))) as rows:
        ends = O.order_statistics(
            O.long_form(rows, ["__hash"], "__label"), O.extents(rows, ["__hash"], "__label"),
            lambda _g, _v, n: [(max(0, round(test_share * n) - 1),) * 2],
        ).collect()
    chosen = F.lit(False)
    for r in ends:
        if round(test_share * r["n"]) > 0:
            chosen |= (col(label) == F.lit(r["grp"])) & (drawn <= F.lit(r["lower"]))
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def split_summary(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("size"), F.avg(label).alias("label_rate")
    )


def seeded_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """Up to ``size`` rows without replacement: those with the smallest hashes."""
    return (
        df.withColumn("__hash", seeded_hash(key, seed))
        .orderBy("__hash", key).limit(size).drop("__hash")
    )


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column keeps scale 1."""

    means: dict[str, float]
    scales: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (col(c).cast("double") - F.lit(m)) / F.lit(self.scales[c])
            for c, m in self.means.items()
        })


def centre_and_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation by column; a constant column has its value and 1.

    Sums of a constant are not exact, so its deviation comes out tiny instead of zero; equal
    least and greatest values tell it, as does a deviation within rounding of the mean.
    """
    row = df.agg(*[f(col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns)
                   for n, f in (("m", F.avg), ("s", F.stddev_pop), ("lo", F.min), ("hi", F.max))]
                 ).first()
    out = {}
    for i, c in enumerate(columns):
        mean, spread, lo, hi = (row[f"{n}{i}"] for n in ("m", "s", "lo", "hi"))
        if mean is None:
            out[c] = (0.0, 1.0)
        elif lo == hi:
            out[c] = (lo, 1.0)
        else:
            out[c] = (mean, spread if spread > 10 * math.ulp(mean) else 1.0)
    return out


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    found = centre_and_scale(df, columns)
    return Scaler({c: m for c, (m, _) in found.items()}, {c: s for c, (_, s) in found.items()})


def levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels per categorical column, as text; their number is checked."""
    entries = [
        F.struct(F.lit(c).alias("variable"), level_text(df, c).alias("level")) for c in columns
    ]
    rows = (
        df.select(F.inline(F.array(*entries))).where(F.col("level").isNotNull())
        .distinct().limit(MAX_LEVELS + 1).collect()
    )
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} levels in {list(columns)}")
    return {c: sorted(r["level"] for r in rows if r["variable"] == c) for c in columns}


def level_text(df: DataFrame, column: str) -> Column:
    """A level as the text used in dummy names; booleans read True and False."""
    if df.schema[column].dataType.typeName() == "boolean":
        return F.when(col(column), "True").when(~col(column), "False")
    return col(column).cast("string")


def one_hot(df: DataFrame, known: dict[str, list[str]],
            drop: str = "if_binary") -> tuple[DataFrame, list[str]]:
    """0/1 columns named ``column_level``; an unknown or missing level gives zeros.

    ``drop='if_binary'`` leaves out the first of two levels, ``drop='first'`` the first
    level of every column.
    """
    out: dict[str, Column] = {}
    for c, found in known.items():
        skip = 1 if drop == "first" or (drop == "if_binary" and len(found) == 2) else 0
        for level in found[skip:]:
            hit = level_text(df, c) == level
            out[f"{c}_{level}"] = F.when(hit, 1.0).otherwise(0.0)
    return (df.withColumns(out) if out else df), list(out)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes x n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.withColumn("weight", F.lit(float(total[0])) / (F.col("n") * total[1]))


def with_balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """The class weight as a column, for estimators that take one."""
    expr = F.lit(None).cast("double")
    for r in balanced_weights(df, label).collect():
        expr = F.when(col(label) == F.lit(r[label]), F.lit(r["weight"])).otherwise(expr)
    return df.withColumn(name, expr)


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values replaced by the exact median of their column."""
    found = O.medians(df, columns)
    return df.withColumns({
        c: F.coalesce(col(c).cast("double"), F.lit(found[c])) for c in columns if c in found
    })
