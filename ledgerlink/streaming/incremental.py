"""Incremental runs (K1 K2 K3) with Structured Streaming and idempotent batch writes.

K1: new files arrive in a folder; each micro-batch is hashed, classified
against the registry of earlier batches, and the registry grows by the new
hashes.  ``foreachBatch`` may replay a batch after a failure, so every write
goes to its own ``batch_id=<n>`` folder in overwrite mode and reads of the
registry exclude the batch being written: a replay rewrites the same rows.

K2: pending inputs are the inputs minus the processed keys (``left_anti``).

K3: a batch adds its rows and, for each of its documents, the first value of
each field as a partial aggregate (``min(struct)``, which merges in any order).
A document's values are merged from its partials when they are read, so no
earlier row is read again and replaying a batch changes nothing.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import hash_files, incremental_dedup
from ..operators.ordered import first_values
from ..sources.io import BINARY_FILE_SCHEMA, _exists, case_insensitive_glob


def _read_batches(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    if not _exists(spark, path):
        return None
    df = spark.read.parquet(path)
    return df.where(F.col("batch_id") < before).drop("batch_id")


class IncrementalDedup:
    """K1 over a stream of files: registry and per-batch classification tables."""

    def __init__(self, spark: SparkSession, state_dir: str, order_cols=("modificationTime", "file_name"),
                 algo: str = "md5"):
        self.spark = spark
        self.state_dir = state_dir.rstrip("/")
        self.registry_path = f"{self.state_dir}/registry"
        self.results_path = f"{self.state_dir}/classified"
        self.order_cols = tuple(order_cols)
        self.algo = algo

    def registry(self, before: int = 2 ** 62) -> DataFrame:
        reg = _read_batches(self.spark, self.registry_path, before)
        if reg is None:
            return self.spark.createDataFrame([], "content_hash string, original string")
        return reg

    def results(self) -> DataFrame:
        return self.spark.read.parquet(self.results_path)

    def process_batch(self, files: DataFrame, batch_id: int) -> None:
        """files: file_name, content and the order columns."""
        keep = tuple(c for c in self.order_cols if c != "file_name")
        hashed = hash_files(files, "file_name", "content", self.algo, keep=keep)
        classified, additions = incremental_dedup(self.registry(batch_id), hashed, self.order_cols)
        classified.select("file_name", "content_hash", "original", "status") \
            .write.mode("overwrite").parquet(f"{self.results_path}/batch_id={batch_id}")
        additions.write.mode("overwrite").parquet(f"{self.registry_path}/batch_id={batch_id}")

    def run_folder(self, folder: str, ext: str = "pdf", max_files_per_trigger: int | None = None) -> None:
        """Process every file not yet seen in ``folder`` and stop (availableNow)."""
        src = (self.spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
               .option("pathGlobFilter", case_insensitive_glob(ext)))
        if max_files_per_trigger:
            src = src.option("maxFilesPerTrigger", str(max_files_per_trigger))
        stream = src.load(folder).withColumn("file_name", F.regexp_extract("path", r"([^/]*)$", 1))
        # beside the state, at a fixed path: a later application goes on where this one ended
        ckpt = f"{self.state_dir}/checkpoint"
        q = (stream.writeStream.foreachBatch(lambda df, bid: self.process_batch(df, bid))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()


def pending(inputs: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """K2/C11/H4: inputs whose key was not processed yet (processed or failed)."""
    return inputs.join(processed.select(key).distinct(), key, "left_anti")


def doc_bucket(doc_col: str, n_buckets: int):
    return F.pmod(F.xxhash64(F.col(doc_col)), F.lit(n_buckets)).cast("int")


class DocumentFields:
    """K3: F1 (``page_col`` None: F2) kept up to date over batches.

    ``n_buckets`` parts the partials by document, so that reading a batch's documents reads their buckets only: choose
    it so that a bucket holds a few thousand documents; ``compact`` merges the partials of a bucket into one row for
    each document."""

    def __init__(self, spark: SparkSession, state_dir: str, doc_col: str, fields: list[str], page_col: str | None = "page_no",
                 seq_col: str = "seq", n_buckets: int = 64):
        self.spark, self.doc_col, self.fields = spark, doc_col, fields
        self.page_col, self.seq_col, self.n_buckets = page_col, seq_col, n_buckets
        self.rows_path, self.partials_path = f"{state_dir.rstrip('/')}/rows", f"{state_dir.rstrip('/')}/partials"

    def _firsts(self, rows: DataFrame) -> DataFrame:
        return first_values(rows, self.doc_col, self.fields, self.page_col, self.seq_col)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Store a batch: its rows, and one partial for each of its documents.  Nothing stored is read."""
        rows = batch.where(F.col(self.doc_col).isNotNull())
        rows.write.mode("overwrite").parquet(f"{self.rows_path}/batch_id={batch_id}")
        self._firsts(rows).withColumn("bucket", doc_bucket(self.doc_col, self.n_buckets)) \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.partials_path}/batch_id={batch_id}")

    def _merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(self.doc_col).agg(*[F.min(f).alias(f) for f in self.fields])

    def _partials(self) -> DataFrame:
        """Since the last compaction, which has the partials up to its batch."""
        stored = self.spark.read.option("basePath", self.partials_path).parquet(self.partials_path)
        last = stored.where("batch_id < 0").select(F.max(-F.col("batch_id") - 1)).first()[0] if self._compacted() else None
        return stored.where("batch_id >= 0") if last is None else stored.where((F.col("batch_id") == -last - 1) | (F.col("batch_id") > last))

    def _compacted(self) -> bool:
        return any(x < 0 for x in self._batches())

    def _batches(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.partials_path)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path) if "=" in f.getPath().getName())

    def values(self, batch_id: int | None = None) -> DataFrame:
        """Document and fields, merged; with ``batch_id`` of that batch's documents alone, out of their buckets."""
        partials = self._partials()
        if batch_id is not None:
            touched = self.spark.read.parquet(f"{self.partials_path}/batch_id={batch_id}").select(self.doc_col, "bucket")
            buckets = [r[0] for r in touched.select("bucket").distinct().collect()]  # n_buckets at most
            partials = partials.where(F.col("bucket").isin(buckets)).join(touched.select(self.doc_col), self.doc_col, "left_semi")
        return self._merged(partials).select(self.doc_col, *[F.coalesce(F.col(f"{f}.v"), F.lit("")).alias(f) for f in self.fields])

    def rows(self) -> DataFrame:
        """Every stored row with its document's values: what F1 over all rows gives."""
        stored = self.spark.read.parquet(self.rows_path).drop("batch_id")
        order = stored.columns
        return stored.drop(*self.fields).join(self.values(), self.doc_col).select(*order)

    def compact(self) -> None:
        """One partial for each document.  A compaction up to batch n is batch -n-1: written whole before it counts."""
        last = max(self._batches())
        if last < 0:
            return
        merged = self._merged(self._partials()).withColumn("bucket", doc_bucket(self.doc_col, self.n_buckets))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.partials_path}/batch_id={-last - 1}")
