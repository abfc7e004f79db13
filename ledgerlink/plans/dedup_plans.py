"""Dedup and link plans over ``documents`` and ``pages`` (L1 L7: E1-E3 E8 K1 C10 C11 G2).

Files are the documents: name ``doc_<doc_id>.pdf``, content = text, source
order = doc_id.  The consolidated link report lists every document with the
page URL whose page_id equals its doc_id (missing otherwise).  The incremental
run splits the documents by id into an earlier and a later run; together the
two runs cover the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators.links import link_report as _link_report
from .base import table

ORDER = ("seq",)


def _files(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file_name"),
                       F.col("doc_id").alias("seq"), F.col("text").alias("content"))


def _hashed(spark, sf_dir) -> DataFrame:
    return D.hash_files(_files(spark, sf_dir), keep=("seq",))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("file_name", "content_hash")


def dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.assign_originals(_hashed(spark, sf_dir), ORDER).select(
        "file_name", "content_hash", "original", "is_duplicate")


def dup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = D.assign_originals(_hashed(spark, sf_dir), ORDER)
    report = D.duplicate_report(classified.where(~F.col("is_duplicate")), D.duplicate_pairs(classified))
    return D.report_order(report)


def _runs(spark, sf_dir):
    h = _hashed(spark, sf_dir)
    # earlier run: ids up to half the largest id (a scalar subquery)
    top = h.agg(F.max("seq")).scalar()
    first = h.where(F.col("seq") * 2 <= top)
    second = h.where(F.col("seq") * 2 > top)
    return first, second


def dup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _runs(spark, sf_dir)
    registry = D.first_per_hash(first, ORDER)
    classified, _ = D.incremental_dedup(registry, second, ORDER)
    return classified.select("file_name", "content_hash", "original", "status")


def dup_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry after both runs: earlier registry plus the later run's additions."""
    first, second = _runs(spark, sf_dir)
    registry = D.first_per_hash(first, ORDER)
    _, additions = D.incremental_dedup(registry, second, ORDER)
    return registry.unionByName(additions)


def dup_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _runs(spark, sf_dir)
    classified, _ = D.incremental_dedup(D.first_per_hash(first, ORDER), second, ORDER)
    return D.run_counters(classified)


def link_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir).drop("content")
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), F.col("url").alias("pdf_link"))
    reference = files.join(pages, "seq", "left")
    classified = D.assign_originals(_hashed(spark, sf_dir), ORDER)
    pairs = D.duplicate_pairs(classified)
    counts = pairs.groupBy("original").agg(F.count(F.lit(1)).alias("duplicate_count"))
    rep = _link_report(reference, pairs, counts)
    return rep.drop("seq")


QUERIES = {
    "content_hash": content_hash,
    "dup_groups": dup_groups,
    "dup_report": dup_report,
    "dup_incremental": dup_incremental,
    "dup_registry": dup_registry,
    "dup_run_counters": dup_run_counters,
    "link_report": link_report,
}

_FILES = """
WITH f AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS file_name, doc_id AS seq, md5(text) AS content_hash
  FROM documents),
g AS (
  SELECT *, first_value(file_name) OVER (PARTITION BY content_hash ORDER BY seq) AS original FROM f),
runs AS (
  SELECT f.*, (f.seq * 2 <= (SELECT max(seq) FROM f)) AS early FROM f),
reg AS (
  SELECT DISTINCT content_hash, first_value(file_name) OVER (PARTITION BY content_hash ORDER BY seq) AS original
  FROM runs WHERE early),
late AS (
  SELECT r.*, first_value(r.file_name) OVER (PARTITION BY r.content_hash ORDER BY r.seq) AS batch_original,
         reg.original AS known_original
  FROM runs r LEFT JOIN reg ON r.content_hash = reg.content_hash WHERE NOT r.early),
inc AS (
  SELECT file_name, content_hash, coalesce(known_original, batch_original) AS original,
         CASE WHEN known_original IS NOT NULL AND file_name = known_original THEN 'known_original'
              WHEN file_name = coalesce(known_original, batch_original) THEN 'new'
              ELSE 'duplicate' END AS status,
         known_original, batch_original
  FROM late)
"""

SQL = {
    "content_hash": _FILES + "SELECT file_name, content_hash FROM f",
    "dup_groups": _FILES + "SELECT file_name, content_hash, original, file_name <> original AS is_duplicate FROM g",
    "dup_report": _FILES + """
, o AS (SELECT DISTINCT original FROM g),
p AS (SELECT original, file_name AS duplicate FROM g WHERE file_name <> original),
c AS (SELECT original, count(*) AS n FROM p GROUP BY original)
SELECT o.original AS original_file, p.duplicate AS duplicate_file,
       CAST(coalesce(c.n, 0) AS BIGINT) AS duplicate_count
FROM o LEFT JOIN c ON o.original = c.original LEFT JOIN p ON o.original = p.original""",
    "dup_incremental": _FILES + "SELECT file_name, content_hash, original, status FROM inc",
    "dup_registry": _FILES + """
SELECT content_hash, original FROM reg
UNION ALL
SELECT DISTINCT content_hash, batch_original AS original FROM inc WHERE known_original IS NULL""",
    "dup_run_counters": _FILES + """
SELECT CAST(count(*) FILTER (WHERE status = 'new') AS BIGINT) AS new_files,
       CAST(count(*) FILTER (WHERE status = 'duplicate') AS BIGINT) AS duplicates,
       CAST(count(*) FILTER (WHERE status = 'known_original') AS BIGINT) AS known_originals,
       CAST(count(*) AS BIGINT) AS total
FROM inc""",
    "link_report": _FILES + """
, ref AS (
  SELECT f.file_name, f.seq, p.url AS pdf_link FROM f LEFT JOIN pages p ON p.page_id = f.seq),
pr AS (SELECT original, file_name AS duplicate FROM g WHERE file_name <> original),
cnt AS (SELECT original, count(*) AS n FROM pr GROUP BY original),
own AS (
  SELECT ref.file_name, coalesce(ref.pdf_link, 'Link Not Found') AS pdf_link,
         CASE WHEN pr.original IS NOT NULL THEN 'Duplicate' ELSE 'Original' END AS status,
         coalesce(pr.original, ref.file_name) AS maps_to_original
  FROM ref LEFT JOIN pr ON pr.duplicate = ref.file_name)
SELECT own.file_name, own.pdf_link, own.status, own.maps_to_original,
       coalesce(ol.pdf_link, 'Link Not Found') AS original_link,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS total_duplicates
FROM own LEFT JOIN ref ol ON ol.file_name = own.maps_to_original AND ol.pdf_link IS NOT NULL
LEFT JOIN cnt ON cnt.original = own.maps_to_original""",
}
