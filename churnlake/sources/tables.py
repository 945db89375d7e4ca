"""Reading, checking and writing the shop tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake import schema as S


@dataclass(frozen=True)
class ShopTables:
    """The shop's tables; an optional one that does not exist is ``None``."""

    users: DataFrame
    orders: DataFrame
    user_logins: DataFrame
    cart_items: DataFrame
    order_items: DataFrame | None = None
    products: DataFrame | None = None
    categories: DataFrame | None = None
    user_interests: DataFrame | None = None

    def present(self) -> dict[str, DataFrame]:
        named = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in named.items() if df is not None}


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """One shop table with its declared types; columns are never inferred.

    CSV files carry a header (a leading byte-order mark is dropped) and are matched
    to the schema by column name, so extra or reordered columns do no harm. Other formats
    are cast to the declared types. NaN is read as missing.
    """
    declared = T.StructType.fromDDL(S.TABLE_SCHEMAS[name])
    if fmt != "csv":
        return _as_declared(spark.read.format(fmt).load(path), declared)
    header = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in declared}
    full = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    rows = (
        spark.read.schema(full)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd[ ]['T'][HH:mm:ss][.SSSSSS]")
        .csv(path)
    )
    return _as_declared(rows, declared)


def _as_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared columns in their types, with NULL for NaN; all others as they are."""
    changed = {}
    for field in declared:
        if field.name in df.columns:
            value = F.col(field.name)
            if df.schema[field.name].dataType != field.dataType:
                value = value.cast(field.dataType)
            if isinstance(field.dataType, T.DoubleType):
                value = F.when(~F.isnan(value), value)
            changed[field.name] = value
    return df.withColumns(changed)


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> ShopTables:
    """All shop tables of a folder; optional tables may be missing."""
    suffix = "csv" if fmt == "csv" else fmt
    found = {n: read_table(spark, f"{folder}/{n}.{suffix}", n, fmt) for n in S.REQUIRED_TABLES}
    for name in S.OPTIONAL_TABLES:
        found[name] = read_optional(spark, f"{folder}/{name}.{suffix}", name, fmt)
    return ShopTables(**found)


def read_optional(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame | None:
    try:
        return read_table(spark, path, name, fmt)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def or_empty(spark: SparkSession, df: DataFrame | None, name: str) -> DataFrame:
    """A missing optional table as a typed empty frame."""
    return df if df is not None else spark.createDataFrame([], S.TABLE_SCHEMAS[name])


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The frame itself, or an error naming every missing column before any job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The training feature table, checked for its columns."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return require_columns(reader.format(fmt).load(path), S.TRAINING_COLUMNS)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] = (), mode: str = "overwrite") -> None:
    """Write a result; CSV gets a header row, Parquet may be partitioned."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


def write_partitions(df: DataFrame, path: str, partition_by: Iterable[str]) -> None:
    """Replace the partitions that the rows belong to and leave all others as they are.

    Writing the same rows again, also after a failed attempt, gives the same table. A partition
    that gets no rows is not touched, so an empty frame changes nothing.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table with declared types, those of its partition columns included.

    Nothing is inferred from folder names, so a filter on a partition column compares in its own
    type and prunes folders.
    """
    return spark.read.schema(schema).parquet(path)
