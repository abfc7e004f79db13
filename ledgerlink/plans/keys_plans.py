"""Key parsing and validation over ``orders``.

Every order yields one key text ``BIN~PCN~GRP`` with ``NULL`` for missing
parts; orders of priority 5-LOW are written with two parts and 4-NOT SPECIFIED
with a fourth part, so the validator has both kinds of invalid rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import format_bin, is_valid_bpg, parse_bpg, plan_id
from .base import sql_pad6, table


def _keys(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    b = F.coalesce(F.when(F.dayofmonth("o_orderdate") <= 25, format_bin("o_custkey")), F.lit("NULL"))
    p = F.when(F.col("o_orderstatus") == "P", F.lit("NULL")).otherwise(F.col("o_orderstatus"))
    g = F.concat(F.lit("G"), F.col("o_orderkey").cast("string"))
    pr = F.col("o_orderpriority")
    text = (F.when(pr == "5-LOW", F.concat_ws("~", b, p))
            .when(pr == "4-NOT SPECIFIED", F.concat_ws("~", b, p, g, F.lit("X")))
            .otherwise(F.concat_ws("~", b, p, g)))
    return o.select(F.col("o_orderkey").alias("seq"), text.alias("bpg"))


def bpg_parse_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _keys(spark, sf_dir)
    parsed = k.withColumn("_p", parse_bpg("bpg"))
    return parsed.select("seq", "bpg", is_valid_bpg("bpg").alias("is_valid"),
                         F.col("_p.bin").alias("bin"), F.col("_p.pcn").alias("pcn"), F.col("_p.grp").alias("grp"),
                         plan_id(F.col("_p.bin"), F.col("_p.pcn"), F.col("_p.grp")).alias("plan_id"))


def bpg_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flagged frame, counted both ways in one pass."""
    v = _keys(spark, sf_dir).select(is_valid_bpg("bpg").alias("ok"))
    return v.agg(F.count_if("ok").cast("long").alias("valid_rows"),
                 F.count_if(~F.col("ok")).cast("long").alias("invalid_rows"))


QUERIES = {
    "bpg_parse_validate": bpg_parse_validate,
    "bpg_validation_counts": bpg_validation_counts,
}

_K = f"""
WITH o AS (
  SELECT o_orderkey AS seq, o_orderpriority AS pr,
         coalesce(CASE WHEN dayofmonth(o_orderdate) <= 25 THEN {sql_pad6('o_custkey')} END, 'NULL') AS b,
         CASE WHEN o_orderstatus = 'P' THEN 'NULL' ELSE o_orderstatus END AS p,
         'G' || CAST(o_orderkey AS VARCHAR) AS g
  FROM orders),
k AS (
  SELECT seq, CASE WHEN pr = '5-LOW' THEN b || '~' || p
                   WHEN pr = '4-NOT SPECIFIED' THEN b || '~' || p || '~' || g || '~X'
                   ELSE b || '~' || p || '~' || g END AS bpg
  FROM o),
s AS (SELECT seq, bpg, string_split(bpg, '~') AS parts FROM k),
q AS (
  SELECT seq, bpg, len(parts) = 3 AS is_valid,
         CASE WHEN parts[1] = 'NULL' OR trim(parts[1]) = '' THEN NULL ELSE trim(parts[1]) END AS bin,
         CASE WHEN parts[2] = 'NULL' OR trim(parts[2]) = '' THEN NULL ELSE trim(parts[2]) END AS pcn,
         CASE WHEN parts[3] = 'NULL' OR trim(parts[3]) = '' THEN NULL ELSE trim(parts[3]) END AS grp
  FROM s)
"""

SQL = {
    "bpg_parse_validate": _K + """
SELECT seq, bpg, is_valid, bin, pcn, grp,
       coalesce(bin, 'NA') || '_' || coalesce(pcn, 'NA') || '_' || coalesce(grp, 'NA') AS plan_id
FROM q""",
    "bpg_validation_counts": _K + """
SELECT CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid_rows,
       CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS invalid_rows
FROM q""",
}
