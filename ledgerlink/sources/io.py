"""Sources and sinks (A1-A8): files, tables, registries and reports.

Everything is a ``spark.read`` / ``df.write`` call with an explicit schema; no
driver-side file loops.  Writes are whole-table ``overwrite`` per named table,
so a re-run after a lost executor or a failed job leaves a complete table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import counted_on
from ..operators.sizes import small_side

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("content", T.BinaryType(), True),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("content_hash", T.StringType(), False),
    T.StructField("original", T.StringType(), False),
])


def case_insensitive_glob(ext: str) -> str:
    """'pdf' -> '*.[pP][dD][fF]' (``pathGlobFilter`` is case-sensitive)."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ext)


def scan_files(spark: SparkSession, folder: str, ext: str = "pdf", recursive: bool = False) -> DataFrame:
    """A1: files of one extension in a folder (not its subfolders unless asked):
    path, file_name, modificationTime, length, content."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", case_insensitive_glob(ext))
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(folder)
    return df.withColumn("file_name", F.regexp_extract("path", r"([^/]*)$", 1))


def scan_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", with_file: bool = False) -> DataFrame:
    """A2: lines of a text file, or of the files of a folder in the order of their paths, in a given encoding, numbered
    from 1; ``with_file`` adds ``file`` and the number within it, ``file_line_no``.

    ``text`` keeps blank lines and the bytes as they are; they are decoded afterwards.  A line's number is its place
    within its block of its file, after the lines of all blocks before (one row per file and block is summed up)."""
    raw = spark.read.text(path).select(
        F.decode(F.col("value").cast("binary"), encoding).alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    out = counted_on(raw, ["file", "_block"], "_at", "line_no")
    if not with_file:
        return out.select("line_no", "line")
    starts = small_side(out.groupBy("file").agg((F.min("line_no") - 1).alias("_start")))
    return out.join(starts, "file").select("line_no", "line", "file", (F.col("line_no") - F.col("_start")).alias("file_line_no"))


def read_table(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet",
               header: bool = True, limit: int | None = None) -> DataFrame:
    """A3: one table (a sheet of the reference) with an explicit schema; ``limit``
    only for the "first n rows" preview the reference offers."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", str(header).lower())
    df = reader.format(fmt).load(path)
    return df.limit(limit) if limit else df


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The stored table, or an empty frame with the declared schema when absent."""
    if _exists(spark, path):
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def load_first_existing(spark: SparkSession, paths: list[str], schema: T.StructType,
                        fmt: str = "parquet") -> DataFrame:
    """Previous output from the first location that exists (e.g. backup,
    then report), else an empty frame with the declared schema."""
    for path in paths:
        if _exists(spark, path):
            return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True) -> None:
    """A5/A4: one write per table; csv gets a header once per part file."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_report(folder: str, tables: dict[str, DataFrame], fmt: str = "parquet") -> None:
    """Several named tables under one folder, each replaced as a whole."""
    for name, df in tables.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", fmt)


def profile(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """Per column (position, column, type, rows, non_null, distinct, first): exact counts, and the value of the first
    row by ``order_col`` (by place in the input without one).

    Rows are unpivoted to (column, value) and counted per value, which combines map-side: one shuffle of distinct values,
    no set of a column's values in one task.  Binary values count by their hex form, nested ones by their JSON."""
    def shown(field) -> Column:
        c = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, T.BinaryType):
            return F.hex(c)
        return F.to_json(c) if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")

    fields = df.schema.fields
    at = F.col("`" + order_col.replace("`", "``") + "`") if order_col else F.monotonically_increasing_id()
    cells = F.array(*[F.struct(F.lit(i).alias("position"), shown(f).alias("value")) for i, f in enumerate(fields)])
    # one cell a column stands even for an empty table
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for i, f in enumerate(fields)])).alias("x")).select("x.*")
    found = df.select(at.alias("at"), F.explode(cells).alias("x")).select("at", "x.*")
    values = found.groupBy("position", "value").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    sums = values.groupBy("position").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("non_null"),
                                          F.count("value").alias("distinct"), F.min_by("value", "at").alias("first"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "non_null", "distinct")]
    return every.join(sums, "position", "left").select("position", "column", "type", *zero, "first")


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in an order, for a look at a table (each task keeps n)."""
    return df.orderBy(*order).limit(n)
