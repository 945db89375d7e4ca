"""The registered queries of the operators, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import (
    cuckoo,
    decontaminate,
    divergence,
    fingerprint,
    langid,
    language_model,
    licences,
    near_dup,
    packing,
    pii,
    sharding,
    url_filter,
    va_file,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all texts and of their edited texts, with containment estimates."""
    rows = fingerprint.edited_pairs(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprint.containment(F.col("sketch"), F.col("edited_sketch"),
                                F.col("edited") == F.col("text")).alias("near_edited"),
        fingerprint.containment(F.col("sketch"), F.col("next_sketch"),
                                F.col("next") == F.col("text")).alias("near_next"),
    )


@_query
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    rows = sharding.shard_documents(_table(spark, sf_dir, "documents"), n_shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that whole documents, or whole lines and blocks of them, are."""
    rows = licences.scan(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "digest", "licence",
                       F.array_join("part_licences", ",").alias("part_licences"))


ALLOW = ["com/", "www.example.com/en/"]
BLOCK = ["example.com/en/", "net/es/", "net/fr/"]


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return url_filter.judge(_table(spark, sf_dir, "pages"), ALLOW, BLOCK)


ORACLE["op6_url_filter"] = """
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages)
SELECT page_id, host, path,
       CASE WHEN starts_with(path, '/en/') AND (host = 'www.example.com' OR suffix(host, '.www.example.com'))
              THEN 'www.example.com/en/'
            WHEN starts_with(path, '/en/') AND (host = 'example.com' OR suffix(host, '.example.com'))
              THEN 'example.com/en/'
            WHEN starts_with(path, '/es/') AND (host = 'net' OR suffix(host, '.net')) THEN 'net/es/'
            WHEN starts_with(path, '/fr/') AND (host = 'net' OR suffix(host, '.net')) THEN 'net/fr/'
            WHEN starts_with(path, '/') AND (host = 'com' OR suffix(host, '.com')) THEN 'com/'
       END AS rule,
       CASE WHEN starts_with(path, '/en/') AND (host = 'www.example.com' OR suffix(host, '.www.example.com'))
              THEN 'allow'
            WHEN starts_with(path, '/en/') AND (host = 'example.com' OR suffix(host, '.example.com'))
              THEN 'block'
            WHEN (starts_with(path, '/es/') OR starts_with(path, '/fr/'))
                 AND (host = 'net' OR suffix(host, '.net')) THEN 'block'
            ELSE 'allow' END AS verdict
FROM p
"""


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in all documents."""
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"),
                                       _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in as few sequences of 1024 as the packing finds."""
    return packing.pack_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document at a shingle similarity of 0.85."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    held = langid.held_out("doc_id", 4, 2)
    net = langid.fit(docs.filter(~held).select("text", "lang"))
    rows = langid.identify(docs.select("doc_id", "text"), net)
    return rows.select("doc_id", held.alias("held_out"), F.col("language.label").alias("lang_pred"),
                       F.col("language.score").alias("score"))


@_query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    rows = pii.detect(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: str):
        return F.array_join(F.transform(f"pii.{spans}", lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("bigint")

    return rows.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"))


@_query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of six sevenths of them."""
    rows = language_model.fit_and_score(_table(spark, sf_dir, "documents"),
                                        langid.held_out("doc_id", 7, 2))
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                       "score")


@_query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all embeddings after three rounds."""
    return va_file.cluster(_table(spark, sf_dir, "embeddings"))


def _assigned_sql(vectors: str, centroids: str) -> str:
    return f"""
SELECT key, arg_min(c, struct_pack(d := distance, c := c)) AS c, min(distance) AS distance
FROM (SELECT v.key, m.c, sum((v.x - m.x) * (v.x - m.x)) AS distance
      FROM {vectors} v JOIN {centroids} m USING (d) GROUP BY v.key, m.c)
GROUP BY key"""


def _moved_sql(assigned: str, centroids: str) -> str:
    return f"""
SELECT m.c, m.d, coalesce(s.x, m.x) AS x
FROM {centroids} m LEFT JOIN (
  SELECT c, d, (total - ((total % n) + n) % n) // n AS x
  FROM (SELECT a.c, v.d, sum(v.x) AS total, count(*) AS n
        FROM {assigned} a JOIN vectors v USING (key) GROUP BY a.c, v.d)) s USING (c, d)"""


ORACLE["op11_centroid_clusters"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS key, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64),
vectors AS MATERIALIZED (
  SELECT key, d, floor(64 * embedding[d]::DOUBLE)::BIGINT AS x
  FROM kept, (SELECT unnest(range(1, 65)) AS d)),
first AS (
  SELECT key, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept
  ORDER BY sha256('1:' || vec_id) LIMIT 16),
c0 AS MATERIALIZED (SELECT f.c, v.d, v.x FROM first f JOIN vectors v USING (key)),
a1 AS MATERIALIZED ({_assigned_sql('vectors', 'c0')}),
c1 AS MATERIALIZED ({_moved_sql('a1', 'c0')}),
a2 AS MATERIALIZED ({_assigned_sql('vectors', 'c1')}),
c2 AS MATERIALIZED ({_moved_sql('a2', 'c1')}),
a3 AS MATERIALIZED ({_assigned_sql('vectors', 'c2')}),
c3 AS MATERIALIZED ({_moved_sql('a3', 'c2')}),
a4 AS MATERIALIZED ({_assigned_sql('vectors', 'c3')}),
digests AS (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS digest
            FROM c3 GROUP BY c)
SELECT vec_id, c::INT AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM a4 JOIN kept USING (key) JOIN digests USING (c)
"""


@_query
def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents, white space aside, and the row of each that stays."""
    return cuckoo.exact_duplicates(_table(spark, sf_dir, "documents"))


ORACLE["op12_exact_duplicates"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY digest) AS size,
         row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY digest ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, size AS group_size, place = 1 AS kept, digest AS text_sha256 FROM r
"""


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, and the terms that mark them."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS key, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
terms AS MATERIALIZED (
  SELECT key, lang, source, term, count(*) AS n
  FROM (SELECT key, lang, source,
               unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
  GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM terms GROUP BY lang, term
                      HAVING count(*) >= 3),
langs AS (SELECT lang, sum(n) + count(*) AS total FROM kept GROUP BY lang),
used AS MATERIALIZED (SELECT lang, source, term, sum(t.n) AS n
                      FROM terms t SEMI JOIN kept k USING (lang, term) GROUP BY ALL),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM used u WHERE u.lang = g.lang
                                     AND u.source = g.source), 0)
         + (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(u.n, 0) + 1) // g.total)::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.n + 1) // l.total)::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN used u USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item,
                    sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
             GROUP BY ALL) v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
marks AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank
FROM pair
UNION ALL
SELECT lang, source, 'term', item, value, rank
FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank
      FROM marks) WHERE rank <= 200
"""
