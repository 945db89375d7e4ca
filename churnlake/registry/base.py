"""Registration of a query next to its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.expressions import col
from churnlake.registry.sql import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the SQL that must give equal rows, if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = sql(oracle)
        return fn

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions cannot show."""
    return df.withColumns({c: F.round(col(c), digits) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: col(c).cast("bigint") for c in columns})


def r6(*columns: str) -> str:
    """SQL for columns rounded to six digits under their own names."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def b(*columns: str) -> str:
    """SQL for whole-number columns as BIGINT under their own names."""
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
