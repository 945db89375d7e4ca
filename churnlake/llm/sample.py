"""Bounded samples of labelled texts for the models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import small_frame


def _bar(distinct: int, limit: int) -> int:
    """Hash up to which about twice the wanted number of texts lies."""
    share = min(1.0, (2 * limit + 100) / max(distinct, 1))
    return min(2**63 - 1, -2**63 + int(share * 2**64))


def sample_texts(rows: DataFrame, limit: int) -> DataFrame:
    """Up to ``limit`` distinct texts of each label, those with the smallest hashes.

    ``rows`` has ``label`` and ``text``, both without nulls; so has the result. Only hashes are
    looked at until a bound on them, from the number of distinct hashes of the label, leaves some
    twice the wanted number of texts; copies fold before the exchange. So no task and not the
    driver gets more than that, whatever the input. Labels are those of a model, hence few.
    """
    hashed = rows.select("label", "text", F.xxhash64("text").alias("hash"))
    counts = hashed.groupBy("label").agg(F.approx_count_distinct("hash").alias("n")).collect()
    bars = small_frame(rows.sparkSession, [(r["label"], _bar(r["n"], limit)) for r in counts],
                       f"label {dict(rows.dtypes)['label']}, bar BIGINT")
    near = hashed.join(F.broadcast(bars), "label").filter("hash <= bar")
    one = near.groupBy("label", "hash").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    return one.withColumn("nth", nth).filter(F.col("nth") <= limit).select("label", "text")
