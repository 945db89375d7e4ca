"""Joins of fact rows with a table that has one row per key, safe against dominant keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.functions.expressions import col
from churnlake.operators import ranking as R

KEY_RANGES = 200      # a key with more than 1/100 of the rows is found for sure


def frequent_keys(df: DataFrame, key: str) -> list[int]:
    """Keys that fill whole quantile ranges of the key column; at most half as many as
    ranges. One pass over that column alone."""
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return []
    (points,) = R.split_points(df, key, ranges=KEY_RANGES)
    return sorted(int(p) for p in R.frequent_points(points))


def lookup(facts: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``facts`` joined with a table that is unique on ``key`` (left, left_semi, left_anti).

    Rows of dominant keys never go through the shuffle: the table holds one row for each
    of those few keys, so that part is broadcast whatever the size of the table. All other
    rows take the ordinary join.
    """
    hot = frequent_keys(facts, key)
    if not hot:
        return facts.join(table, key, how)
    dominant = F.coalesce(col(key).isin(*hot), F.lit(False))
    few = table.where(col(key).isin(*hot))
    return facts.where(~dominant).join(table, key, how).unionByName(
        facts.where(dominant).join(F.broadcast(few), key, how)
    )
