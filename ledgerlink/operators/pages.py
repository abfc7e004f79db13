"""Documents -> pages -> records and rejects (L2: I2 B35 B36 B38 B9 B13-B15 B39 I4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import page_number_from_name, page_text, strip, zero_for_slashed_o
from .records import parse_records

# Why a page gives no records.
NO_ANSWER = "no answer"
UNPARSEABLE = "unparseable answer"


def split_pages(docs: DataFrame, doc_col: str = "document_name", pages_col: str = "pages") -> DataFrame:
    """A row for each page of ``pages_col`` (array of (text, grid)), with the name of its split-off file, the number
    read from it (B35) and the document's other columns.  Documents without pages give no rows."""
    kept = [c for c in docs.columns if c != pages_col]
    out = docs.select(*kept, F.posexplode_outer(pages_col).alias("_at", "_page")).where(F.col("_at").isNotNull())
    name = F.concat(F.regexp_replace(doc_col, r"\.[^.]*$", ""), F.lit("_page_"), (F.col("_at") + 1).cast("string"), F.lit(".pdf"))
    return out.select(*kept, name.alias("page_name"), page_number_from_name(name).alias("page_no"), F.col("_page.text").alias("text"), F.col("_page.grid").alias("grid"))


def readable_pages(pages: DataFrame) -> DataFrame:
    """A grid of more than one row replaces the page's text, 'Ø' is '0', pages without text go."""
    text = zero_for_slashed_o(page_text("text", "grid"))
    return pages.withColumn("text", text).drop("grid").where(F.trim("text") != "")


def outcomes(answers: DataFrame, schema: str, raw_col: str = "raw") -> DataFrame:
    """One parse for both sinks: ``answers`` without ``raw_col``, with ``rec_idx`` and ``rec`` for each record of a page,
    or one row with ``reason`` for a page whose answer is missing or no list.  An empty list gives no rows."""
    fields = schema[len("array<"):-1]
    kind = f"array<struct<rec_idx:int,rec:{fields},reason:string>>"
    kept = [c for c in answers.columns if c != raw_col]

    def rejected(reason: str) -> Column:
        return F.array(F.struct(F.lit(None).cast("int").alias("rec_idx"), F.lit(None).cast(fields).alias("rec"), F.lit(reason).alias("reason"))).cast(kind)

    records = F.transform("_recs", lambda r, i: F.struct(i.cast("int").alias("rec_idx"), r.alias("rec"), F.lit(None).cast("string").alias("reason"))).cast(kind)
    missing = F.col(raw_col).isNull() | (strip(raw_col) == "")
    made = F.when(missing, rejected(NO_ANSWER)).when(F.col("_recs").isNull(), rejected(UNPARSEABLE)).otherwise(records)
    # the generator leaves one row at least, so nothing is inferred below it that would parse the answers again
    out = answers.withColumn("_recs", parse_records(raw_col, schema)).select(*kept, F.explode_outer(made).alias("_o"))
    return out.where(F.col("_o").isNotNull()).select(*kept, "_o.rec_idx", "_o.rec", "_o.reason")


def records_of(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.where("reason is null").select(*keys, "rec_idx", "rec.*")


def rejects_of(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.where("reason is not null").select(*keys, "reason")
