"""The corpus pipeline: five operators in a row, from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import decontaminate, langid, near_dup, packing, pii
from churnlake.session import drop_staged, stage

#: Documents are near duplicates from this similarity of their five-word shingle sets.
NEAR_PERCENT = 80


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells, however sure it is.

    It learns from the labelled documents of the input; null, empty and letterless texts go.
    Without any labelled document nothing can be told, and all with a letter stay.
    """
    net = langid.fit(docs.select("text", "lang"))
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    name = _free_name(docs, "language")
    rows = langid.identify(docs, net, out_col=name)
    return rows.filter(F.col(f"{name}.label") != langid.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, and all others.

    Rows without an id stay. Of rows that repeat an id the smallest row stays, by the order of
    their columns.
    """
    found = near_dup.near_duplicates(docs.select("doc_id", "text"), percent=NEAR_PERCENT)
    ids = stage(found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("n")), "kept-ids")
    kept = docs.join(ids.filter("n = 1").select("doc_id"), "doc_id", "left_semi").unionByName(
        docs.filter("doc_id IS NULL"))
    repeated = ids.filter("n > 1").select("doc_id")
    if not repeated.isEmpty():
        rows = docs.join(repeated, "doc_id", "left_semi")
        one = rows.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
        kept = kept.unionByName(one.select("row.*"))
    return kept.select(*docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window; rows are told apart by id and text."""
    key = _free_name(docs, "key")
    keyed = docs.withColumn(key, F.concat_ws(":", F.coalesce(
        F.col("doc_id").cast("string"), F.lit("none")), F.xxhash64("text").cast("string")))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    index = decontaminate.build_index(keyed, id_col=key)
    found = decontaminate.contamination(keyed.select(key, "text"), benchmark, id_col=key,
                                        index=index)
    hit = stage(found.filter("n_hit > 0").select(F.col("doc_id").alias(key)).distinct(),
                "contaminated")
    drop_staged(index)
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind in brackets.

    ``n_chars`` becomes the length of the masked text; null texts stay null.
    """
    name = _free_name(docs, "pii")
    rows = pii.detect(docs, with_masked=True, out_col=name)
    changed = {"text": F.col(f"{name}.masked")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(f"{name}.spans") > 0, F.length(f"{name}.masked").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.withColumns(changed).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024."""
    return packing.pack_documents(docs.select("doc_id", "text")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL has no form for trained models, signatures and packing; tests hold the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
