"""The resumable page job (L2 with K2, H3, H4, E8, A6, A7).

Each run reads the documents that no earlier run has read, parses their answers once and writes, for its batch number,

* ``outcomes/batch_id=N/kind=record|reject``: one write for both sinks, observed by the run's counters (E8);
* ``ledger/batch_id=N``: every document of the batch as processed or failed, with the reason.  It is written last: a
  batch counts once its ledger stands.

All writes overwrite the batch's own folders and all reads leave the batch out, so a replay gives the same rows.  A
document that can't be read is failed, like one with nothing but rejects, and isn't tried again.  Where the ledger is
lost it is rebuilt from the outcomes (H3).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import pages as P
from .incremental import _read_batches, pending

# States of a document.
PROCESSED, FAILED = "processed", "failed"
UNREADABLE, NO_PAGES = "unreadable", "no pages"


def rebuilt_ledger(found: DataFrame, doc_col: str = "document_name") -> DataFrame:
    """H3: a document with a record is processed, one with rejects alone failed, for the first reason by name."""
    reason = F.when(F.count_if(F.col("reason").isNull()) == 0, F.min("reason"))
    out = found.groupBy(doc_col).agg(reason.alias("reason"))
    return out.select(doc_col, F.when(F.col("reason").isNull(), F.lit(PROCESSED)).otherwise(F.lit(FAILED)).alias("status"), "reason")


class PageJob:
    """``answers`` gives (document_name, page_no, raw) for readable pages: the model's answers are a table of the caller."""

    def __init__(self, spark: SparkSession, state_dir: str, schema: str, answers: Callable[[DataFrame], DataFrame]):
        self.spark, self.schema, self.answers = spark, schema, answers
        self.state_dir = state_dir.rstrip("/")
        self.outcomes_path, self.ledger_path = f"{self.state_dir}/outcomes", f"{self.state_dir}/ledger"

    def outcomes(self, before: int = 2**62) -> DataFrame | None:
        return _read_batches(self.spark, self.outcomes_path, before)

    def ledger(self, before: int = 2**62) -> DataFrame:
        """document_name, status, reason: as written, or rebuilt from the outcomes where it is lost."""
        stored = _read_batches(self.spark, self.ledger_path, before)
        if stored is not None:
            return stored
        found = self.outcomes(before)
        return self.spark.createDataFrame([], "document_name string, status string, reason string") if found is None else rebuilt_ledger(found)

    def records(self) -> DataFrame:
        return P.records_of(self.outcomes().where("kind = 'record'"), ["document_name", "page_no"])

    def rejects(self) -> DataFrame:
        return P.rejects_of(self.outcomes().where("kind = 'reject'"), ["document_name", "page_no"])

    def process_batch(self, docs: DataFrame, batch_id: int) -> dict[str, int]:
        """``docs``: document_name, pages (array of (text, grid); null where the document can't be read).

        Returns the counters of the run.  Documents in the ledger of another batch are skipped."""
        todo = pending(docs, self.ledger(batch_id), "document_name")
        found = P.outcomes(self.answers(P.readable_pages(P.split_pages(todo))), self.schema)
        found = found.withColumn("kind", F.when(F.col("reason").isNull(), "record").otherwise("reject"))
        seen = Observation(f"pages-{batch_id}")
        counted = found.observe(seen, F.count_if(F.col("kind") == "record").alias("records"), F.count_if(F.col("kind") == "reject").alias("rejected_pages"))
        counted.write.mode("overwrite").partitionBy("kind").parquet(f"{self.outcomes_path}/batch_id={batch_id}")
        written = self.spark.read.schema(found.schema).parquet(f"{self.outcomes_path}/batch_id={batch_id}")
        known = rebuilt_ledger(written)
        ledger = todo.select("document_name", F.when(F.col("pages").isNull(), UNREADABLE).otherwise(NO_PAGES).alias("otherwise")).dropDuplicates(["document_name"]).join(known, "document_name", "left")
        ledger = ledger.select("document_name", F.coalesce("status", F.lit(FAILED)).alias("status"), F.when(F.col("status").isNull(), F.col("otherwise")).otherwise(F.col("reason")).alias("reason"))
        done = Observation(f"documents-{batch_id}")
        ledger.observe(done, F.count(F.lit(1)).alias("documents"), F.count_if(F.col("status") == FAILED).alias("failed_documents")) \
            .write.mode("overwrite").parquet(f"{self.ledger_path}/batch_id={batch_id}")
        return {**done.get, **seen.get}

    def run_folder(self, folder: str, pattern: str = "*.txt") -> None:
        """Every file of ``folder`` not read yet: UTF-8 text, pages parted by form feeds; a file that isn't is unreadable."""
        from ..sources.io import BINARY_FILE_SCHEMA

        files = self.spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", pattern).load(folder)
        text = F.when(F.call_function("is_valid_utf8", F.col("content").cast("string")), F.col("content").cast("string"))
        grid = F.lit(None).cast("array<array<string>>")
        docs = files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("document_name"), F.transform(F.split(text, "\f", -1), lambda x: F.struct(x.alias("text"), grid.alias("grid"))).alias("pages"))
        run = docs.writeStream.foreachBatch(lambda df, batch_id: self.process_batch(df, batch_id)).option("checkpointLocation", f"{self.state_dir}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
