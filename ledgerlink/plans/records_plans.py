"""Record clean-up plans (L3 L4, F1-F5) over part, events, customer, supplier,
documents and conversations.

  explode_cells   part: BIN cell = p_name / p_brand -, PCN cell = p_type (size n)
                  or (p_type), GRP cell = p_brand or p_name; split, triple
                  explode, symbol-only values blanked (B7 I1 B8)
  field_cleanup   events as extracted rows: BIN/PCN/GRP/plan cleanup, majority
                  'Legacy' strip, empty-row drop, BIN gap fill per user in
                  event order (B31 B32 E7 B33 F4)
  majority_prefix customer and supplier names, 'Customer#' stripped when more
                  than 80% carry it (E7)
  wrapped_lines   documents: wrapped-line merge of every text (F5)
  doc_backfill    conversations as pages of a document (F1); arrival-order
                  variant (F2); running first value (F3)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ordered as O
from ..operators.records import explode_cells as _explode_cells
from ..operators.records import majority_prefix_strip
from .base import table


def _cells(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("seq"),
        F.concat_ws(" ", "p_name", F.lit("/"), "p_brand", F.lit("-")).alias("bin"),
        F.when(F.col("p_size") % 2 == 0,
               F.concat(F.col("p_type"), F.lit(" (size "), F.col("p_size").cast("string"), F.lit(")")))
         .otherwise(F.concat(F.lit("("), F.col("p_type"), F.lit(")"))).alias("pcn"),
        F.concat(F.col("p_brand"), F.lit(" or "), F.col("p_name")).alias("grp"))


def explode_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explode_cells(_cells(spark, sf_dir), ["bin", "pcn", "grp"])


# Words that mark a GRP cell as description, not a code.
GRP_WORDS = "Group ID|Required|when"


def _extracted_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id",
        F.concat(F.lit("BIN "), F.round(F.col("value") * 100).cast("long").cast("string")).alias("bin"),
        F.when(F.col("event_type") == "error", F.lit("see card for details"))
         .when(F.col("event_type") == "view", F.lit(""))
         .otherwise(F.upper("event_type")).alias("pcn"),
        F.when(F.col("props").endswith("1}"), F.lit("Group ID Required"))
         .otherwise(F.concat(F.lit("G"), F.col("user_id").cast("string"))).alias("grp"),
        F.when(F.col("props").endswith("0}"), F.lit(""))
         .otherwise(F.concat(F.lit("Legacy "), F.col("event_type"), F.lit(" plan"))).alias("plan_name"))


def field_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _extracted_events(spark, sf_dir)
    df = df.select("event_id", "user_id", T.clean_bin("bin").alias("bin"), T.clean_pcn("pcn").alias("pcn"),
                   T.clean_grp("grp", GRP_WORDS).alias("grp"), "plan_name")
    df = majority_prefix_strip(df, "plan_name", "Legacy", 0.8)
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    df = df.where(~(empty("bin") & empty("plan_name")))
    df = df.withColumn("_block", F.floor(F.col("event_id") / 4096))
    return O.gap_fill(df, ["user_id"], "event_id", block_col="_block").drop("_block")


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _extracted_events(spark, sf_dir).select(
        "event_id", "user_id", T.clean_bin("bin").alias("bin"), T.clean_pcn("pcn").alias("pcn"))
    df = df.withColumn("_block", F.floor(F.col("event_id") / 4096))
    return O.gap_fill(df, ["user_id"], "event_id", block_col="_block").drop("_block")


def majority_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return majority_prefix_strip(c.unionByName(s), "name", "Customer", 0.8)


def wrapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return O.merge_wrapped_lines(d.select("doc_id", "text"), "text", "merged").drop("text")


def _conv_records(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("document_name"),
        F.when(F.col("role") == "system", F.lit(None)).otherwise(F.col("turn")).alias("page_no"),
        F.col("turn").alias("seq"),
        F.when(F.col("role") == "assistant", F.split_part("text", F.lit(" "), F.lit(1)))
         .otherwise(F.lit("")).alias("processor"),
        F.when((F.col("role") == "user") & (F.length("text") > 100),
               F.concat(F.lit(" "), F.split_part("text", F.lit(" "), F.lit(2)))).alias("payer"))


def doc_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.doc_backfill(_conv_records(spark, sf_dir), "document_name", ["processor", "payer"],
                          page_col="page_no", seq_col="seq")


def backfill_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.doc_backfill(_conv_records(spark, sf_dir), "document_name", ["processor", "payer"],
                          page_col=None, seq_col="seq")


def running_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.running_first(_conv_records(spark, sf_dir), "document_name", ["processor", "payer"], seq_col="seq")


# Fixed pattern choices for the carry-down query: a key is a run of 5-6
# digits, a code is a capitalised word at the start of a line.
KEY_REGEX = r"(\d{5,6})"
CODE_REGEX = r"^([A-Z][a-z]+)"


def bin_carry_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 over every document: lines below a key line carry that key; each
    line with a code becomes a (key, code) row."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return O.carry_down(d, "doc_id", "text", KEY_REGEX, CODE_REGEX)


QUERIES = {
    "bin_carry_down": bin_carry_down,
    "explode_cells": explode_cells,
    "field_cleanup": field_cleanup,
    "gap_fill": gap_fill,
    "majority_prefix": majority_prefix,
    "wrapped_lines": wrapped_lines,
    "doc_backfill": doc_backfill,
    "backfill_arrival": backfill_arrival,
    "running_first": running_first,
}

# ---------------------------------------------------------------- oracle SQL
_SPLIT = ("list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace({x}, "
          "'\\(.*?\\)', '', 'g'), '\\bor\\b.*', '', 'i'), '[ ,/]+'), lambda t: trim(t)), lambda t: t <> '')")
_OUTER = "unnest(CASE WHEN len({l}) = 0 THEN [NULL::VARCHAR] ELSE {l} END)"
_BLANK = "CASE WHEN regexp_full_match({x}, '[#&\\\\:\\-]+') THEN '' ELSE {x} END"

_EVENTS = r"""
WITH x AS (
  SELECT event_id, user_id,
         'BIN ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS bin_raw,
         CASE WHEN event_type = 'error' THEN 'see card for details'
              WHEN event_type = 'view' THEN '' ELSE upper(event_type) END AS pcn_raw,
         CASE WHEN props LIKE '%1}' THEN 'Group ID Required' ELSE 'G' || CAST(user_id AS VARCHAR) END AS grp_raw,
         CASE WHEN props LIKE '%0}' THEN '' ELSE 'Legacy ' || event_type || ' plan' END AS plan_raw
  FROM events),
c AS (
  SELECT event_id, user_id,
         nullif(regexp_extract(bin_raw, '(\d{5,6})', 1), '') AS bin,
         CASE WHEN length(pcn_raw) > 15 OR regexp_matches(pcn_raw, '\s') THEN '' ELSE pcn_raw END AS pcn,
         CASE WHEN regexp_matches(grp_raw, '(?i)Group ID|Required|when') THEN '' ELSE grp_raw END AS grp,
         plan_raw
  FROM x),
"""

_GAP = r"""
  CASE WHEN (bin IS NULL OR bin = '') AND length(pcn) > 0
       THEN coalesce(last_value(CASE WHEN length(bin) > 0 THEN bin END IGNORE NULLS)
                     OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), bin)
       ELSE bin END AS bin"""

_CONV = r"""
WITH r AS (
  SELECT 'conv_' || CAST(conv_id AS VARCHAR) AS document_name,
         CASE WHEN role = 'system' THEN NULL ELSE turn END AS page_no, turn AS seq,
         CASE WHEN role = 'assistant' THEN split_part(text, ' ', 1) ELSE '' END AS processor,
         CASE WHEN role = 'user' AND length(text) > 100 THEN ' ' || split_part(text, ' ', 2) END AS payer
  FROM conversations)
"""


def _backfill_sql(order: str) -> str:
    def first(f):
        return (f"coalesce(regexp_replace(first_value(CASE WHEN length({f}) > 0 THEN {f} END IGNORE NULLS) OVER "
                f"(PARTITION BY document_name ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),"
                f" '^\\s+|\\s+$', '', 'g'), '') AS {f}")
    return _CONV + f"SELECT document_name, page_no, seq, {first('processor')}, {first('payer')} FROM r"


def _running_sql() -> str:
    def first(f):
        # first usable value in order; rows at or after it take it
        st = f"regexp_replace({f}, '^\\s+|\\s+$', '', 'g')"
        return (f"CASE WHEN count(CASE WHEN length({st}) > 0 THEN 1 END) OVER w > 0 "
                f"THEN first_value(CASE WHEN length({st}) > 0 THEN {st} END IGNORE NULLS) OVER w "
                f"ELSE {f} END AS {f}")
    return (_CONV + f"SELECT document_name, page_no, seq, {first('processor')}, {first('payer')} FROM r "
            "WINDOW w AS (PARTITION BY document_name ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


_WRAPPED = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS j,
         unnest(string_split(text, chr(10))) AS raw
  FROM documents),
s AS (SELECT doc_id, j, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM lines),
e AS (
  SELECT *, coalesce(j > 1 AND NOT regexp_matches(lag(line) OVER w, '\d{5,}') AND length(line) < 40
                     AND NOT regexp_matches(line, 'BIN|PCN|GRP|Effective'), false) AS edge
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
r AS (
  SELECT *, max(CASE WHEN edge AND NOT coalesce(prev_edge, false) THEN j END)
              OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_start
  FROM (SELECT *, lag(edge) OVER (PARTITION BY doc_id ORDER BY j) AS prev_edge FROM e)),
a AS (
  SELECT *, edge AND (j - run_start) % 2 = 0 AS absorbed FROM r),
h AS (
  SELECT *, sum(CASE WHEN absorbed THEN 0 ELSE 1 END)
              OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head
  FROM a),
m AS (SELECT doc_id, head, string_agg(line, ' ' ORDER BY j) AS merged FROM h GROUP BY doc_id, head)
SELECT doc_id, string_agg(merged, chr(10) ORDER BY head) AS merged FROM m GROUP BY doc_id
"""

SQL = {
    "bin_carry_down": r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
k AS (
  SELECT *, nullif(regexp_extract(line, '(\d{5,6})', 1), '') AS k,
         nullif(regexp_extract(line, '^([A-Z][a-z]+)', 1), '') AS code
  FROM l),
c AS (
  SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key
  FROM k)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, key, code FROM c WHERE code IS NOT NULL AND key IS NOT NULL""",
    "explode_cells": f"""
WITH c AS (
  SELECT p_partkey AS seq,
         p_name || ' / ' || p_brand || ' -' AS bin,
         CASE WHEN p_size % 2 = 0 THEN p_type || ' (size ' || CAST(p_size AS VARCHAR) || ')'
              ELSE '(' || p_type || ')' END AS pcn,
         p_brand || ' or ' || p_name AS grp
  FROM part),
l AS (SELECT seq, {_SPLIT.format(x='bin')} AS bl, {_SPLIT.format(x='pcn')} AS pl, {_SPLIT.format(x='grp')} AS gl FROM c),
e1 AS (SELECT seq, pl, gl, {_OUTER.format(l='bl')} AS bin FROM l),
e2 AS (SELECT seq, gl, bin, {_OUTER.format(l='pl')} AS pcn FROM e1),
e3 AS (SELECT seq, bin, pcn, {_OUTER.format(l='gl')} AS grp FROM e2)
SELECT seq, {_BLANK.format(x='bin')} AS bin, {_BLANK.format(x='pcn')} AS pcn, {_BLANK.format(x='grp')} AS grp
FROM e3""",
    "field_cleanup": _EVENTS + r"""
ratio AS (SELECT count(*) FILTER (WHERE starts_with(plan_raw, 'Legacy')) * 1.0 / count(*) AS r FROM c),
p AS (
  SELECT c.*, CASE WHEN (SELECT r FROM ratio) > 0.8 THEN regexp_replace(plan_raw, '^Legacy\s*', '') ELSE plan_raw END
              AS plan_name
  FROM c),
k AS (SELECT * FROM p WHERE NOT ((bin IS NULL OR bin = '') AND (plan_name IS NULL OR plan_name = '')))
SELECT event_id, user_id, """ + _GAP + """, pcn, grp, plan_name FROM k""",
    "gap_fill": _EVENTS.rstrip().rstrip(",") + "\nSELECT event_id, user_id, " + _GAP + ", pcn FROM c",
    "majority_prefix": r"""
WITH n AS (SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier),
ratio AS (SELECT count(*) FILTER (WHERE starts_with(name, 'Customer')) * 1.0 / count(*) AS r FROM n)
SELECT CASE WHEN (SELECT r FROM ratio) > 0.8 THEN regexp_replace(name, '^Customer\s*', '') ELSE name END AS name
FROM n""",
    "wrapped_lines": _WRAPPED,
    "doc_backfill": _backfill_sql("page_no NULLS LAST, seq"),
    "backfill_arrival": _backfill_sql("seq"),
    "running_first": _running_sql(),
}
