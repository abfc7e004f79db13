"""Content-hash dedup (E1 E2 E3 K1 C11) as aggregate + join plans.

Every per-hash reduction is a combinable aggregate (``min_by``/``count``),
so a content hash shared by a third of all files costs one partial row per
map task, never a sorted window over the hot group.  The join back to the
files is an equi-join on the hash; AQE splits the skewed file side while the
per-hash side holds exactly one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status labels of an incremental run.
STATUS_NEW = "new"
STATUS_DUPLICATE = "duplicate"
STATUS_KNOWN = "known_original"


def content_hash(content, algo: str = "md5") -> Column:
    """Hex digest of the content (binary or string, strings as UTF-8)."""
    c = F.col(content) if isinstance(content, str) else content
    if algo == "md5":
        return F.md5(c)
    if algo == "sha1":
        return F.sha1(c)
    if algo.startswith("sha"):
        return F.sha2(c, int(algo[3:]))
    raise ValueError(f"unknown hash algorithm {algo!r}")


def hash_files(files: DataFrame, name_col: str = "file_name", content_col: str = "content",
               algo: str = "md5", keep: tuple[str, ...] = ()) -> DataFrame:
    """(file_name, content_hash, *keep); the content column is dropped after hashing."""
    return files.select(F.col(name_col).alias("file_name"), *keep,
                        content_hash(content_col, algo).alias("content_hash"))


def _order_struct(order_cols) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def first_per_hash(hashed: DataFrame, order_cols=("file_name",)) -> DataFrame:
    """One row per hash: the file that comes first in ``order_cols`` (D18: caller picks)."""
    return hashed.groupBy("content_hash").agg(
        F.min_by("file_name", _order_struct(order_cols)).alias("original"))


def assign_originals(hashed: DataFrame, order_cols=("file_name",)) -> DataFrame:
    """Every file with its hash, its group's original and a duplicate flag."""
    firsts = first_per_hash(hashed, order_cols)
    return (hashed.join(firsts, "content_hash")
            .withColumn("is_duplicate", F.col("file_name") != F.col("original")))


def duplicate_pairs(classified: DataFrame) -> DataFrame:
    """(original, duplicate) for every file that is a copy of another."""
    return classified.where("is_duplicate").select("original", F.col("file_name").alias("duplicate"))


def duplicate_report(originals: DataFrame, pairs: DataFrame) -> DataFrame:
    """E3 in long form: one row per (original, duplicate); originals without
    duplicates get one row with a null duplicate; ``duplicate_count`` per original.

    Long form keeps every row bounded: a hot original never becomes one giant
    ", "-joined cell built in a single task.  ``report_text`` renders the
    joined form for small reports.
    """
    counts = pairs.groupBy("original").agg(F.count(F.lit(1)).alias("duplicate_count"))
    base = originals.select(F.col("original").alias("original_file")).distinct()
    return (base.join(counts, base.original_file == counts.original, "left").drop("original")
            .join(pairs, base.original_file == pairs.original, "left").drop("original")
            .select("original_file", F.col("duplicate").alias("duplicate_file"),
                    F.coalesce("duplicate_count", F.lit(0)).cast("long").alias("duplicate_count")))


def report_order(report: DataFrame) -> DataFrame:
    """G1: duplicate count descending, then original name, then duplicate name."""
    return report.orderBy(F.col("duplicate_count").desc(), F.col("original_file").asc(),
                          F.col("duplicate_file").asc_nulls_first())


def report_text(report: DataFrame) -> DataFrame:
    """The reference's display form: duplicates of an original joined by ", ".

    Each output row holds the whole duplicate list of one original, so use it
    for presentation of bounded reports only; ``duplicate_report`` is the
    scalable form.
    """
    return report.groupBy("original_file").agg(
        F.coalesce(F.array_join(F.array_sort(F.collect_list("duplicate_file")), ", "),
                   F.lit("")).alias("duplicate_files"),
        F.max("duplicate_count").alias("duplicate_count"))


def incremental_dedup(registry: DataFrame, batch: DataFrame, order_cols=("file_name",)) -> tuple[DataFrame, DataFrame]:
    """K1/C11 batch form.

    ``registry``: (content_hash, original) from earlier runs, one row per hash.
    ``batch``: (file_name, content_hash, *order_cols) of this run.

    Returns (classified batch, registry additions).  A file whose hash is known
    is a duplicate of the *earlier* original, unless it is that original itself
    (status ``known_original``, as the reference skips it).  New hashes take the
    first file of this run as original; later copies in the run are duplicates.
    """
    firsts = first_per_hash(batch, order_cols).withColumnRenamed("original", "batch_original")
    reg = registry.select("content_hash", F.col("original").alias("known_original"))
    classified = (batch.join(firsts, "content_hash")
                  .join(reg, "content_hash", "left")
                  .withColumn("original", F.coalesce("known_original", "batch_original"))
                  .withColumn("status",
                              F.when(F.col("known_original").isNotNull() & (F.col("file_name") == F.col("known_original")),
                                     F.lit(STATUS_KNOWN))
                              .when(F.col("file_name") == F.col("original"), F.lit(STATUS_NEW))
                              .otherwise(F.lit(STATUS_DUPLICATE)))
                  .drop("known_original", "batch_original"))
    additions = (firsts.join(reg, "content_hash", "left_anti")
                 .select("content_hash", F.col("batch_original").alias("original")))
    return classified, additions


def run_counters(classified: DataFrame) -> DataFrame:
    """One-row counters of a run (new, duplicate, known, total)."""
    return classified.agg(
        F.count_if(F.col("status") == STATUS_NEW).cast("long").alias("new_files"),
        F.count_if(F.col("status") == STATUS_DUPLICATE).cast("long").alias("duplicates"),
        F.count_if(F.col("status") == STATUS_KNOWN).cast("long").alias("known_originals"),
        F.count(F.lit(1)).alias("total"))
