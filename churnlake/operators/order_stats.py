"""Exact order statistics (medians, quartiles, cut points) without a full sort.

The built-in exact ``percentile`` gathers all distinct values of a group in one
task, which does not hold for a continuous column at scale. Here a mergeable sketch
first brackets each wanted rank between two values with guaranteed rank error. A
second aggregation counts everything below the bracket as one number and keeps
only the distinct values inside it: some 100,000 at most up to 1e11 input rows, since the
sketch gets finer with the data. Both steps combine on the map side; a value held by a
large share of the rows is one counted entry.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.expressions import col
from churnlake.session import small_frame

SKETCH_ACCURACY = 100_000     # least accuracy; the rank error of the sketch is n / accuracy
MAX_ACCURACY = 4_000_000      # bounds the sketch itself to some 100 MB
INSIDE_ROWS = 100_000         # rows aimed at inside a bracket
WHOLE_RANGE_ROWS = 1_000      # up to here the bracket is the whole range
MAX_GROUPS = 5_000            # groups of a ``by`` column; checked before use

# Maps a row count to the (lower, upper) zero-based ranks wanted for it, and the same
# for a group, a variable and its row count.
Ranks = Callable[[int], list[tuple[int, int]]]
RanksOf = Callable[[object, str, int], list[tuple[int, int]]]


def linear_ranks(probs: Sequence[float]) -> Ranks:
    """The two neighbours between which the linear quantile definition interpolates."""

    def ranks(n: int) -> list[tuple[int, int]]:
        places = [p * (n - 1) for p in probs]
        return [(math.floor(h), math.ceil(h)) for h in places]

    return ranks


def lower_ranks(parts: int) -> Ranks:
    """Ranks after which each of ``parts`` equal-sized bins but the last one ends."""

    def ranks(n: int) -> list[tuple[int, int]]:
        return [((k * (n - 1)) // parts,) * 2 for k in range(1, parts)]

    return ranks


def long_form(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """(grp, variable, value) rows without the missing values."""
    group = col(by) if by else F.lit(None).cast("string")
    if len(columns) == 1:
        pairs = df.select(
            group.alias("grp"), F.lit(columns[0]).alias("variable"), col(columns[0]).alias("value")
        )
    else:
        entries = [
            F.struct(F.lit(c).alias("variable"), value_column(c, columns).alias("value"))
            for c in columns
        ]
        pairs = df.select(group.alias("grp"), F.inline(F.array(*entries)))
    return pairs.where(F.col("value").isNotNull())


@dataclass(frozen=True)
class Extent:
    """Row count and value range of one variable in one group; an unknown end is None."""

    grp: object
    variable: str
    n: int
    lo: object = None
    hi: object = None


def extents(df: DataFrame, columns: Sequence[str], by: str | None = None) -> list[Extent]:
    """Counts and ranges of several columns from one pass; the number of groups is checked."""
    group = col(by) if by else F.lit(None).cast("string")
    measures = [
        F.struct(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
        for v in (value_column(c, columns) for c in columns)
    ]
    named = [m.alias(f"e{i}") for i, m in enumerate(measures)]
    rows = (
        df.groupBy(group.alias("grp")).agg(*named).limit(MAX_GROUPS + 1).collect()
        if by else df.agg(*named).collect()
    )
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups: aggregate per group instead")
    return [
        Extent(r["grp"] if by else None, c, *r[f"e{i}"])
        for r in rows for i, c in enumerate(columns) if r[f"e{i}"]["n"] > 0
    ]


def value_column(name: str, columns: Sequence[str]) -> Column:
    """A column as it appears in the long form: its own type alone, else a double."""
    return col(name) if len(columns) == 1 else col(name).cast("double")


def _brackets(pairs: DataFrame, found: Sequence[Extent], ranks_of: RanksOf) -> DataFrame:
    """A small table of (grp, variable, target, ranks, value bracket) per wanted rank pair."""
    most = max((e.n for e in found), default=0)
    accuracy = min(max(SKETCH_ACCURACY, 4 * most // INSIDE_ROWS), MAX_ACCURACY)
    margin = 2.0 / accuracy

    def bounds(lower: int, upper: int, n: int) -> tuple[float, float]:
        return (max(0.0, lower / n - margin), min(1.0, (upper + 1) / n + margin))

    wanted = {(e.grp, e.variable): ranks_of(e.grp, e.variable, e.n) for e in found}
    large = [e for e in found if e.n > WHOLE_RANGE_ROWS]
    sketch: dict[tuple, dict[float, object]] = {}
    if large:
        points = sorted({
            p for e in large for pair in wanted[e.grp, e.variable] for p in bounds(*pair, e.n)
        })
        rows = pairs.groupBy("grp", "variable").agg(
            F.percentile_approx("value", points, accuracy).alias("q")
        ).collect()
        sketch = {(r["grp"], r["variable"]): dict(zip(points, r["q"])) for r in rows}
    table = []
    for e in found:
        key = (e.grp, e.variable)
        for target, (lower, upper) in enumerate(wanted[key]):
            lo, hi = e.lo, e.hi
            if e.n > WHOLE_RANGE_ROWS:
                p_lo, p_hi = bounds(lower, upper, e.n)
                lo = lo if p_lo == 0.0 else sketch[key][p_lo]
                hi = hi if p_hi == 1.0 else sketch[key][p_hi]
            table.append((*key, target, e.n, lower, upper, lo, hi))
    kind = pairs.schema["value"].dataType
    declared = T.StructType([
        T.StructField("grp", pairs.schema["grp"].dataType),
        T.StructField("variable", T.StringType()),
        T.StructField("target", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("lower_rank", T.LongType()), T.StructField("upper_rank", T.LongType()),
        T.StructField("lo", kind), T.StructField("hi", kind),
    ])
    return small_frame(pairs.sparkSession, table, declared)


def order_statistics(pairs: DataFrame, found: Sequence[Extent], ranks_of: RanksOf) -> DataFrame:
    """Values at the wanted ranks of each (grp, variable).

    Returns (grp, variable, target, n, lower_rank, upper_rank, lower, upper, below,
    ties) where ``below`` counts the rows less than ``lower`` and ``ties`` those equal
    to it. A bracket that missed its rank would fail the query, never give a wrong value.
    """
    brackets = _brackets(pairs, found, ranks_of)
    key = ["grp", "variable", "target"]
    value, lo, hi = pairs["value"], brackets["lo"], brackets["hi"]
    inside = (
        pairs.join(
            F.broadcast(brackets),
            pairs["grp"].eqNullSafe(brackets["grp"])
            & (pairs["variable"] == brackets["variable"]),
        )
        .where(hi.isNull() | (value <= hi))
        .select(
            brackets["grp"], brackets["variable"], "target", "n", "lower_rank", "upper_rank",
            F.when(lo.isNull() | (value >= lo), value).alias("value"),
        )
        .groupBy(*key, "n", "lower_rank", "upper_rank", "value")
        .agg(F.count(F.lit(1)).alias("ties"))
    )
    upto = Window.partitionBy(*key).orderBy(F.col("value").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = inside.withColumn("through", F.sum("ties").over(upto))

    def holds(rank: str) -> Column:
        return (F.col("through") > F.col(rank)) & (
            F.col("through") - F.col("ties") <= F.col(rank)
        )

    picked = placed.groupBy(*key, "n", "lower_rank", "upper_rank").agg(
        F.max(F.when(holds("lower_rank"), F.col("value"))).alias("lower"),
        F.max(F.when(holds("upper_rank"), F.col("value"))).alias("upper"),
        F.max(F.when(holds("lower_rank"), F.col("through") - F.col("ties"))).alias("below"),
        F.max(F.when(holds("lower_rank"), F.col("ties"))).alias("ties"),
    )
    missed = F.col("lower").isNull() | F.col("upper").isNull()
    failure = F.raise_error(F.lit("rank outside its bracket")).cast(pairs.schema["value"].dataType)
    return picked.withColumn("lower", F.when(missed, failure).otherwise(F.col("lower")))


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: str | None = None, accurate: bool = True) -> DataFrame:
    """Linear-interpolated quantiles as (grp, variable, prob, n, quantile) rows.

    ``by`` takes a column with few levels, such as a label or a cluster.
    """
    pairs = long_form(df, columns, by)
    pairs = pairs.withColumn("value", F.col("value").cast("double"))
    if not accurate:
        entries = F.arrays_zip(
            F.array(*map(F.lit, probs)).alias("prob"), F.col("q").alias("quantile")
        )
        return pairs.groupBy("grp", "variable").agg(
            F.count("value").alias("n"),
            F.percentile_approx("value", list(probs), SKETCH_ACCURACY).alias("q"),
        ).select("grp", "variable", "n", F.inline(entries))
    ranks = linear_ranks(probs)
    doubles = df.select(*([by] if by else []), *[col(c).cast("double").alias(c) for c in columns])
    found = extents(doubles, columns, by)
    stats = order_statistics(pairs, found, lambda _g, _v, n: ranks(n))
    prob = F.element_at(F.array(*map(F.lit, probs)), F.col("target") + 1)
    weight = prob * (F.col("n") - 1) - F.col("lower_rank")
    return stats.select(
        "grp", "variable", prob.alias("prob"), "n",
        (F.col("lower") + (F.col("upper") - F.col("lower")) * weight).alias("quantile"),
    )


def quantile_columns(df: DataFrame, columns: Sequence[str], named: dict[str, float],
                     by: str | None = None, accurate: bool = True) -> DataFrame:
    """``quantiles`` with one column per named probability."""
    rows = quantiles(df, columns, list(named.values()), by, accurate)
    return rows.groupBy("grp", "variable").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
        for name, p in named.items()
    ])


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians as plain numbers, one per column that has any value."""
    return {r["variable"]: r["quantile"] for r in quantiles(df, columns, [0.5]).collect()}
