"""Cascade linkage over the driver tables (L5: B4 B6 C1 C2 C15 E4 E5).

Left ("top keys") is every order; right ("extracted records") is every order
again plus every line item, with per-row CASE rules that null or alter key
parts so all five levels and ``Unmatched`` occur.  No row is filtered out:
the work grows with ``orders`` and ``lineitem``.

  left   bin = padded o_custkey, missing when day of month > 25
         pcn = o_orderstatus, missing when 'P'
         grp = 'G' || o_orderkey, missing for priorities 3-MEDIUM / 4-NOT SPECIFIED
  right  orders:   bin = padded o_custkey, pcn = 'X' for 1-URGENT else o_orderstatus,
                   grp = 'G' || o_orderkey for priorities 1-URGENT / 2-HIGH, else missing
         lineitem: bin = padded l_partkey, pcn = l_linestatus, grp = 'G' || l_orderkey
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import format_bin, format_bpg
from ..operators.cascade import attach_summary, cascade_counts, cascade_join, match_summary, precomputed_levels
from .base import sql_pad6, table


def cascade_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    left = o.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.dayofmonth("o_orderdate") > 25, F.lit(None)).otherwise(format_bin("o_custkey")).alias("bin"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("pcn"),
        F.when(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit(None))
         .otherwise(F.concat(F.lit("G"), F.col("o_orderkey").cast("string"))).alias("grp"),
    ).withColumn("bpg", format_bpg("bin", "pcn", "grp"))
    right_orders = o.select(
        (F.col("o_orderkey") * 2).alias("right_id"),
        F.lit("orders").alias("src"),
        format_bin("o_custkey").alias("bin"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("X")).otherwise(F.col("o_orderstatus")).alias("pcn"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
               F.concat(F.lit("G"), F.col("o_orderkey").cast("string"))).alias("grp"))
    right_lines = li.select(
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2 + 1).alias("right_id"),
        F.lit("lineitem").alias("src"),
        format_bin("l_partkey").alias("bin"),
        F.col("l_linestatus").alias("pcn"),
        F.concat(F.lit("G"), F.col("l_orderkey").cast("string")).alias("grp"))
    return left, right_orders.unionByName(right_lines)


def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = cascade_inputs(spark, sf_dir)
    return cascade_join(left, right, left_id="row_id")


def cascade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = cascade_inputs(spark, sf_dir)
    summary = match_summary(cascade_counts(left, right), key_col="bpg", count_col="match_count")
    return attach_summary(left.select("row_id", "bpg"), summary, key_col="bpg")


def cascade_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade_counts(*cascade_inputs(spark, sf_dir)).select("row_id", "matched_level", "match_count")


def cascade_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cascade_counts(*cascade_inputs(spark, sf_dir))
    return counts.groupBy("matched_level").agg(
        F.count(F.lit(1)).alias("left_rows"), F.sum("match_count").alias("matched_rows"))


def _with_precomputed(df: DataFrame) -> DataFrame:
    """C4 inputs: one key column per level, null when a part is missing (D3)."""
    def joined(*cols):
        return F.when(F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) == 0,
                      F.concat_ws("_", *cols)) if len(cols) > 1 else F.col(cols[0])
    return (df.withColumn("k_bpg", joined("bin", "pcn", "grp")).withColumn("k_bin_grp", joined("bin", "grp"))
              .withColumn("k_grp", joined("grp")).withColumn("k_bin_pcn", joined("bin", "pcn"))
              .withColumn("k_bin", joined("bin")))


def cascade_precomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: the same cascade driven by precomputed key columns (here they cannot
    collide: BINs are digits and GRPs start with 'G'); equals cascade_match."""
    left, right = cascade_inputs(spark, sf_dir)
    cols = ("k_bpg", "k_bin_grp", "k_grp", "k_bin_pcn", "k_bin")
    anchors = ("k_grp", "k_grp", "k_grp", "k_bin", "k_bin")  # a key names its group id, else its BIN
    out = cascade_join(_with_precomputed(left), _with_precomputed(right),
                       precomputed_levels(left_cols=cols, anchors=anchors), left_id="row_id")
    return out.select("row_id", "bin", "pcn", "grp", "bpg", "right_id", "src",
                      "bin_matched", "pcn_matched", "grp_matched", "matched_level")


QUERIES = {
    "cascade_match": cascade_match,
    "cascade_precomputed": cascade_precomputed,
    "cascade_summary": cascade_summary,
    "cascade_per_row": cascade_per_row,
    "cascade_level_counts": cascade_level_counts,
}

# ---- DuckDB oracle: an independent formulation (all level joins, keep the
# minimum rank per left row), not the two-phase plan above.
_CTE = f"""
WITH l AS (
  SELECT o_orderkey AS row_id,
         CASE WHEN dayofmonth(o_orderdate) > 25 THEN NULL ELSE {sql_pad6('o_custkey')} END AS bin,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS pcn,
         CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN NULL
              ELSE 'G' || CAST(o_orderkey AS VARCHAR) END AS grp
  FROM orders),
lk AS (
  SELECT *, concat_ws('~', coalesce(bin, 'NULL'), coalesce(pcn, 'NULL'), coalesce(grp, 'NULL')) AS bpg FROM l),
r AS (
  SELECT 2 * o_orderkey AS right_id, 'orders' AS src, {sql_pad6('o_custkey')} AS bin,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS pcn,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'G' || CAST(o_orderkey AS VARCHAR) END AS grp
  FROM orders
  UNION ALL
  SELECT (l_orderkey * 8 + l_linenumber) * 2 + 1, 'lineitem', {sql_pad6('l_partkey')}, l_linestatus,
         'G' || CAST(l_orderkey AS VARCHAR)
  FROM lineitem),
m AS (
  SELECT lk.row_id, r.*, 1 AS rnk FROM lk JOIN r ON lk.bin = r.bin AND lk.pcn = r.pcn AND lk.grp = r.grp
  UNION ALL SELECT lk.row_id, r.*, 2 FROM lk JOIN r ON lk.bin = r.bin AND lk.grp = r.grp
  UNION ALL SELECT lk.row_id, r.*, 3 FROM lk JOIN r ON lk.grp = r.grp
  UNION ALL SELECT lk.row_id, r.*, 4 FROM lk JOIN r ON lk.bin = r.bin AND lk.pcn = r.pcn
  UNION ALL SELECT lk.row_id, r.*, 5 FROM lk JOIN r ON lk.bin = r.bin),
best AS (
  SELECT * FROM (
    SELECT *, min(rnk) OVER (PARTITION BY row_id) AS min_rnk FROM m) WHERE rnk = min_rnk),
cm AS (
  SELECT lk.row_id, lk.bin, lk.pcn, lk.grp, lk.bpg, best.right_id, best.src,
         best.bin AS bin_matched, best.pcn AS pcn_matched, best.grp AS grp_matched,
         coalesce((['BPG', 'BIN_GRP', 'GRP', 'BIN_PCN', 'BIN'])[best.rnk], 'Unmatched') AS matched_level
  FROM lk LEFT JOIN best ON lk.row_id = best.row_id)
"""

SQL = {
    "cascade_match": _CTE + "SELECT * FROM cm",
    "cascade_precomputed": _CTE + "SELECT * FROM cm",
    "cascade_summary": _CTE + """,
s AS (
  SELECT bpg, count(*) AS match_count,
         array_to_string(list_sort(list_distinct(list(matched_level))), ', ') AS rules_used
  FROM cm WHERE matched_level <> 'Unmatched' GROUP BY bpg)
SELECT lk.row_id, lk.bpg, CAST(coalesce(s.match_count, 0) AS BIGINT) AS match_count,
       coalesce(s.rules_used, 'No Match') AS rules_used
FROM lk LEFT JOIN s ON lk.bpg = s.bpg""",
    "cascade_per_row": _CTE + """
SELECT row_id, max(matched_level) AS matched_level,
       CAST(count(*) FILTER (WHERE matched_level <> 'Unmatched') AS BIGINT) AS match_count
FROM cm GROUP BY row_id""",
    "cascade_level_counts": _CTE + """
SELECT matched_level, CAST(count(DISTINCT row_id) AS BIGINT) AS left_rows,
       CAST(count(*) FILTER (WHERE right_id IS NOT NULL) AS BIGINT) AS matched_rows
FROM cm GROUP BY matched_level""",
}
