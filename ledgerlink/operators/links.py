"""Link/duplicate consolidation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of the consolidated report.
LINK_NOT_FOUND = "Link Not Found"
STATUS_ORIGINAL = "Original"
STATUS_DUPLICATE = "Duplicate"


def split_list(c, sep: str = ", ") -> Column:
    """Delimited text -> array without empty items (D9: blanks never become keys)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(col, re.escape(sep), -1), lambda x: x != "")


def natural_key(c) -> Column:
    """Last digit run before the extension, as a number (null when none)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(col, r"(\d+)\D*$", 1), F.lit("")).try_cast("long")


def natural_sort(df: DataFrame, name_col: str) -> DataFrame:
    return df.orderBy(natural_key(name_col).asc_nulls_last(), F.col(name_col).asc())


def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Dict semantics (later rows overwrite): one row per key, reduced map-side."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def link_report(link_reference: DataFrame, pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Each listed file -> status, original, own link, original's link, count.

    ``link_reference``: (seq, file_name, pdf_link); ``pairs``: (original, duplicate);
    ``counts``: (original, duplicate_count).  Lookups are reduced to one row per
    key before joining, so no row fans out; the two joins on ``file_name`` and
    the two on ``maps_to_original`` each share one shuffle.
    """
    links = last_value_per_key(link_reference.where(F.col("pdf_link").isNotNull()),
                               "file_name", "pdf_link", "seq")
    dup_of = last_value_per_key(pairs.withColumn("_o", F.col("original")), "duplicate", "original", "_o")
    rows = link_reference.select("seq", "file_name")
    own = (rows.join(dup_of, rows.file_name == dup_of.duplicate, "left")
           .join(links, "file_name", "left")
           .select("seq", "file_name",
                   F.coalesce("pdf_link", F.lit(LINK_NOT_FOUND)).alias("pdf_link"),
                   F.when(F.col("original").isNotNull(), F.lit(STATUS_DUPLICATE))
                    .otherwise(F.lit(STATUS_ORIGINAL)).alias("status"),
                   F.coalesce("original", "file_name").alias("maps_to_original")))
    olinks = links.select(F.col("file_name").alias("maps_to_original"), F.col("pdf_link").alias("original_link"))
    ocounts = counts.select(F.col("original").alias("maps_to_original"),
                            F.col("duplicate_count").alias("total_duplicates"))
    return (own.join(olinks, "maps_to_original", "left")
            .join(ocounts, "maps_to_original", "left")
            .select("file_name", "pdf_link", "status", "maps_to_original",
                    F.coalesce("original_link", F.lit(LINK_NOT_FOUND)).alias("original_link"),
                    F.coalesce("total_duplicates", F.lit(0)).cast("long").alias("total_duplicates"),
                    "seq"))


def pick_document_link(link, sitelinks) -> Column:
    """Own link if it is a PDF, else the first PDF sitelink, else own link."""
    lk = F.col(link) if isinstance(link, str) else link
    sl = F.col(sitelinks) if isinstance(sitelinks, str) else sitelinks
    is_pdf = lambda x: F.lower(x).endswith(".pdf")
    first_pdf = F.try_element_at(F.filter(sl, lambda s: is_pdf(s["link"])), F.lit(1))["link"]
    return F.coalesce(F.when(is_pdf(lk), lk), first_pdf, F.nullif(lk, F.lit("")))
