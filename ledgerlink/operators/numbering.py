"""Row numbers and routing (A2 B3 G3): numbers by prefix sums, carried through and used to restore the order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sizes import small_side

# The two routes.
VALID, INVALID = "valid", "invalid"


def counted_on(rows: DataFrame, run_cols: list[str], at_col: str, out_col: str) -> DataFrame:
    """Numbers from 1 over runs in the order of ``run_cols``: within a run rows have consecutive values of ``at_col``,
    so a row's number is its place in the run after the rows of the runs before.  One row per run is summed up."""
    runs = rows.groupBy(*run_cols).agg(F.min(at_col).alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*run_cols).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*run_cols, "_first", before.alias("_before"))
    numbered = rows.join(small_side(runs), run_cols)
    return numbered.withColumn(out_col, F.col("_before") + F.col(at_col) - F.col("_first") + 1).drop("_first", "_before")


def number_rows(df: DataFrame, order: list, out_col: str = "row_no") -> DataFrame:
    """``df`` with each row's number in ``order`` (columns, or names), without one task seeing all rows: rows are
    dealt by range and sorted, each partition numbers its own, and partition sizes are summed up.

    The dealt rows are written once to the checkpoint folder, so that a lost executor can't deal them anew in between."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.withColumn("_at", F.monotonically_increasing_id()))
    with_run = dealt.withColumn("_run", F.shiftright("_at", 33))
    return counted_on(with_run, ["_run"], "_at", out_col).select(*df.columns, out_col)


def restored(df: DataFrame, row_col: str = "row_no") -> DataFrame:
    """The rows in the order of their numbers, without the number."""
    return df.orderBy(row_col).drop(row_col)


def write_routed(df: DataFrame, is_valid: Column, path: str) -> None:
    """One pass that writes the valid and the invalid rows apart; a null verdict is invalid."""
    route = F.when(F.coalesce(is_valid, F.lit(False)), F.lit(VALID)).otherwise(F.lit(INVALID))
    df.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(path)


def read_routed(spark: SparkSession, path: str, schema, route: str) -> DataFrame:
    """One of the routed tables; empty where no row went there."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col("route") == route).drop("route")
