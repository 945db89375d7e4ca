"""Partitions are replaced one by one and read with declared types."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.sources.tables import read_partitions, write_partitions


def made(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, day STRING").select(
        "id", F.col("day").cast("timestamp_ntz").alias("day"))


def test_one_partition_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    first = made(spark, [(1, "2025-01-01 12:00:00.25"), (2, "2025-01-01 12:00:00.25"),
                         (3, "2025-01-02"), (4, None)])
    write_partitions(first, path, ["day"])
    for _ in range(2):                              # writing again changes nothing
        write_partitions(made(spark, [(5, "2025-01-02")]), path, ["day"])
    write_partitions(first.limit(0), path, ["day"])
    back = read_partitions(spark, path, first.schema)
    assert back.schema["day"].dataType.simpleString() == "timestamp_ntz"
    got = sorted((r["id"], str(r["day"])) for r in back.collect())
    assert got == [(1, "2025-01-01 12:00:00.250000"), (2, "2025-01-01 12:00:00.250000"),
                   (4, "None"), (5, "2025-01-02 00:00:00")]
    late = back.filter(F.col("day") >= F.lit("2025-01-02").cast("timestamp_ntz"))
    assert [r["id"] for r in late.collect()] == [5]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "Cast" not in plan
