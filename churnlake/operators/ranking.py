"""Global ranks, running sums and quantile scores without a single-partition sort.

An ordered window without a partition key pulls all rows into one task. Instead a
sketch of the order column gives split points for about as many ranges as there
are shuffle partitions. Counts per range (a small table) give each range its offset,
and the window runs inside a range. A value so frequent that it fills a range alone is
split further by the tie-break id, so no range outgrows its share of the rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions import expressions as E
from churnlake.operators import order_stats as O
from churnlake.session import kept

MAX_RANGES = 2000
SCORE_LABELS = (1, 2, 3, 4, 5)


def range_count(df: DataFrame) -> int:
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(wanted, MAX_RANGES))


def split_points(df: DataFrame, *columns: str, ranges: int | None = None) -> list[list[float]]:
    """Approximate quantiles of each column, from one pass; a frequent value shows more
    than once among the points of its column."""
    ranges = ranges or range_count(df)
    probs = [i / ranges for i in range(1, ranges)]
    row = df.agg(*[
        F.percentile_approx(E.col(c).cast("double"), probs, 20 * ranges).alias(f"p{i}")
        for i, c in enumerate(columns)
    ]).first()
    return [[p for p in (points or []) if math.isfinite(p)] for points in row]


def frequent_points(points: Sequence[float]) -> set[float]:
    """Values that show more than once among the split points of a column."""
    return {v for v, times in Counter(points).items() if times > 1}


def _edges(points: Sequence[float]) -> tuple[list[float], set[float]]:
    """Range starts, and those starts whose range holds a single frequent value."""
    frequent = frequent_points(points)
    edges = sorted(set(points) | {math.nextafter(v, math.inf) for v in frequent})
    return edges, frequent


def _range_of(df: DataFrame, value: Column, edges: Sequence[float], name: str) -> DataFrame:
    """Adds the 0-based range of a value, ranges being closed on the left."""
    if not edges:
        return df.withColumn(name, F.lit(0))
    ranger = Bucketizer(
        inputCol="__v", outputCol="__r", splits=[-math.inf, *edges, math.inf],
        handleInvalid="keep",
    )
    return (
        ranger.transform(df.withColumn("__v", value.cast("double")))
        .withColumn(name, F.col("__r").cast("int")).drop("__v", "__r")
    )


CELL = ("__range", "__sub")


def ordered_cells(df: DataFrame, value: Column, tie: str) -> DataFrame:
    """Adds ``__range`` and ``__sub``: cells that follow the order of (value, id).

    No cell holds much more than its share of the rows, whatever the data: ranges come
    from approximate quantiles of the value, and a range filled by one frequent value is
    split further by quantiles of the id. Missing values form the last range, split too.
    """
    marked = df.withColumn("__value", value)
    points, ids = split_points(marked, "__value", tie)
    edges, frequent = _edges(points)
    tie_edges = sorted(set(ids))
    ranged = _range_of(marked, F.col("__value"), edges, "__range")
    ranged = _range_of(ranged, E.col(tie), tie_edges, "__sub")
    hot = [edges.index(v) + 1 for v in frequent]
    missing = F.col("__value").isNull()
    split = (F.col("__range").isin(*hot) | missing) if hot else missing
    return ranged.withColumns({
        "__sub": F.when(split, F.col("__sub")).otherwise(0),
        "__range": F.when(missing, len(edges) + 2).otherwise(F.col("__range")),
    }).drop("__value")


def global_rank(df: DataFrame, value: str, tie: str, rank: str = "rank") -> DataFrame:
    """Unique 1-based rank by value, ties in order of a numeric id; missing values last."""
    ranged = ordered_cells(df, E.col(value), tie)
    before = Window.orderBy(*CELL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*CELL).agg(F.count(F.lit(1)).alias("__n")).select(
        *CELL, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*CELL).orderBy(E.col(value), E.col(tie))
    return (
        ranged.withColumn("__place", F.row_number().over(inside))
        .join(offsets, list(CELL), "left")
        .withColumn(rank, F.col("__offset") + F.col("__place"))
        .drop(*CELL, "__place", "__offset")
    )


def running_sums(df: DataFrame, order: str, sums: Sequence[str], points: Sequence[float],
                 by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Inclusive running sums of columns in the order of a column, as ``cum_*``.

    Rows must be unique per ``by`` and ``order`` (aggregate first), and ``points``
    are split points of the order column, best taken from the rows before that
    aggregation. ``by`` takes columns with few levels.
    """
    edges = sorted(set(points))
    ranged = _range_of(df, E.col(order), edges, "__range")
    cells = [*by, "__range"]

    def along(column: str) -> Column:
        return E.col(column).desc() if descending else E.col(column).asc()

    before = Window.partitionBy(*by).orderBy(along("__range")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = ranged.groupBy(*cells).agg(*[F.sum(E.col(c)).alias(c) for c in sums]).select(
        *cells, *[F.coalesce(F.sum(E.col(c)).over(before), F.lit(0)).alias(f"__off_{c}")
                  for c in sums]
    )
    inside = Window.partitionBy(*cells).orderBy(along(order)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    out = ranged.withColumns({
        f"__in_{c}": F.sum(E.col(c)).over(inside) for c in sums
    }).join(totals, cells, "left")
    return out.withColumns({
        f"cum_{c}": F.col(f"__in_{c}") + F.col(f"__off_{c}") for c in sums
    }).drop("__range", *[f"__in_{c}" for c in sums], *[f"__off_{c}" for c in sums])


def average_rank(df: DataFrame, value: str, rank: str = "avg_rank") -> DataFrame:
    """Distinct values with their count and the mean rank shared by their ties."""
    present = df.where(E.col(value).isNotNull())
    counts = present.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    placed = running_sums(counts, value, ["n"], *split_points(present, value))
    return placed.select(
        value, "n", (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias(rank)
    )


def _measure(df: DataFrame, columns: Sequence[str], q: int) -> tuple[dict, dict[str, int]]:
    """Extent of each column, and the distinct count of those with less than ``q`` values.

    The estimate never exceeds ``q`` when there are so few values, so the exact set is
    only gathered where it is known to be small.
    """
    values = {c: E.col(c).cast("double") for c in columns}
    row = df.agg(*[
        F.struct(
            F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
            F.approx_count_distinct(v).alias("guess"),
        ).alias(f"e{i}")
        for i, v in enumerate(values.values())
    ]).first()
    measured = {c: row[f"e{i}"] for i, c in enumerate(columns)}
    small = [c for c in columns if measured[c]["guess"] <= 2 * q]
    if not small:
        return measured, {}
    sizes = df.agg(*[
        F.size(F.collect_set(E.col(c))).alias(f"d{i}") for i, c in enumerate(small)
    ]).first()
    return measured, {c: sizes[i] for i, c in enumerate(small) if sizes[i] < q}


def quantile_scores(df: DataFrame, specs: dict[str, tuple[str, Sequence[int], bool]],
                    tie: str, q: int = 5) -> DataFrame:
    """Adds equal-sized score columns; ``specs`` maps a name to (column, labels, descending).

    A row's bin is decided by its unique rank, ties in order of the id. Bin b ends at
    rank floor(b (n-1) / q), so q-1 (value, id) pairs per score settle every row: the
    pairs are found by exact selection, and scoring is then a plain comparison
    that moves no rows. A column with fewer distinct values than bins gets one bin per
    distinct value and, as in the published scores, ignores ``descending``.
    """
    columns = list(dict.fromkeys(c for c, _, _ in specs.values()))
    with kept(df.select(tie, *map(E.col, columns))) as source:
        measured, few = _measure(source, columns, q)

        def order_value(name: str) -> Column:
            column, _, descending = specs[name]
            value = E.col(column).cast("double")
            return -value if descending and column not in few else value

        def extent(name: str) -> O.Extent:
            column, _, descending = specs[name]
            n, lo, hi, _ = measured[column]
            flipped = descending and column not in few
            return O.Extent(None, name, n, *((-hi, -lo) if flipped else (lo, hi)))

        bins = {n: max(1, few.get(c, q)) for n, (c, _, _) in specs.items()}
        narrow = source.select(tie, *[order_value(n).alias(n) for n in specs])
        cuts = O.order_statistics(
            O.long_form(narrow, list(specs)),
            [extent(n) for n, (c, _, _) in specs.items() if measured[c]["n"]],
            lambda _g, name, n: O.lower_ranks(bins[name])(n),
        ).collect()
        # Where a cut falls among the rows sharing its value, the id decides.
        place = [c["lower_rank"] - c["below"] for c in cuts]
        tied_slots = [i for i, c in enumerate(cuts) if place[i] < c["ties"] - 1]
        last_id: dict[int, object] = {}
        if tied_slots:
            hits = [
                F.when(E.col(cuts[i]["variable"]) == F.lit(cuts[i]["lower"]), F.lit(i))
                for i in tied_slots
            ]
            tied = narrow.select(F.explode(F.array_compact(F.array(*hits))).alias("slot"), tie)
            found = O.order_statistics(
                O.long_form(tied, [tie], "slot"),
                [O.Extent(i, tie, cuts[i]["ties"]) for i in tied_slots],
                lambda slot, _v, _n: [(place[slot], place[slot])],
            ).collect()
            last_id = {r["grp"]: r["lower"] for r in found}
    out = {}
    for name, (_, labels, _) in specs.items():
        value = order_value(name)
        passed = F.lit(0)
        for i, c in enumerate(cuts):
            if c["variable"] != name:
                continue
            beyond = value > F.lit(c["lower"])
            if i in last_id:
                beyond |= (value == F.lit(c["lower"])) & (E.col(tie) > F.lit(last_id[i]))
            passed = passed + beyond.cast("int")
        score = F.element_at(F.array(*[F.lit(v) for v in labels]), passed + 1)
        out[name] = F.when(value.isNotNull(), score)
    return df.withColumns(out)


def quantile_score(df: DataFrame, value: str, name: str, tie: str = "user_id", q: int = 5,
                   labels: Sequence[int] = SCORE_LABELS, descending: bool = False) -> DataFrame:
    """One quantile score column."""
    return quantile_scores(df, {name: (value, labels, descending)}, tie, q)


def rfm_scores(df: DataFrame, q: int = 5, r_mode: str = "reference",
               tie: str = "user_id") -> DataFrame:
    """Recency, frequency and money scores, their sum and its bucket.

    ``r_mode='reference'`` scores recency the way the published figures do, where the
    stalest users get 5 (both the order and the labels are reversed);
    ``'recent_high'`` gives 5 to the most recent.
    """
    scored = quantile_scores(df, {
        "R_score": ("recency_days", tuple(reversed(SCORE_LABELS)), r_mode == "reference"),
        "F_score": ("order_count", SCORE_LABELS, False),
        "M_score": ("total_spend", SCORE_LABELS, False),
    }, tie, q)
    total = F.col("R_score") + F.col("F_score") + F.col("M_score")
    return scored.withColumn("RFM_sum", total).withColumn(
        "RFM_bucket", E.rfm_bucket(F.col("RFM_sum"))
    )
