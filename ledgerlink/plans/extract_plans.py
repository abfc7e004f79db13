"""Model-answer parsing plans (L2 L9 pieces: B13-B17 B39 F7 I4) over orders and lineitem.

parse_records / parse_rejects: one answer per order, page = o_orderkey of
  document ``cust_<o_custkey>``: a fenced JSON array of two records; priority
  5-LOW answers are cut short (bad JSON), 4-NOT SPECIFIED answers are a lone
  object (not a list), 3-MEDIUM answers have chatter around the array.
parse_pipe / first_usable_doc: one pipe-table answer per line item (key =
  l_orderkey, document position = l_linenumber): returned items give a header
  and a data row, rejected items give prose, others a row with empty fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import extra_parts, extraction_status, parse_pipe_table, parse_records as _parse
from .base import sql_pad6, table

RECORD_SCHEMA = "array<struct<bin:string,pcn:string,grp:string,plan_name:string>>"


def responses(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    b = F.when(F.length(F.col("o_custkey").cast("string")) < 6,
               F.lpad(F.col("o_custkey").cast("string"), 6, "0")).otherwise(F.col("o_custkey").cast("string"))
    rec1 = F.concat(F.lit('{"bin": "'), b, F.lit('", "pcn": "'), F.col("o_orderstatus"),
                    F.lit('", "grp": "G'), F.col("o_orderkey").cast("string"),
                    F.lit('", "plan_name": "'), F.col("o_orderpriority"), F.lit('"}'))
    rec2 = F.concat(F.lit('{"bin": "'), b, F.lit('", "pcn": null, "grp": "H'), F.col("o_orderkey").cast("string"),
                    F.lit('", "plan_name": "second"}'))
    arr = F.concat(F.lit("["), rec1, F.lit(", "), rec2, F.lit("]"))
    pr = F.col("o_orderpriority")
    raw = (F.when(pr == "5-LOW", F.concat(F.lit("```json\n"), F.substring(arr, 1, 40)))
           .when(pr == "4-NOT SPECIFIED", rec1)
           .when(pr == "3-MEDIUM", F.concat(F.lit("Here are the records:\n"), arr, F.lit("\nDone.")))
           .otherwise(F.concat(F.lit("```json\n"), arr, F.lit("\n```"))))
    return o.select(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("document_name"),
                    F.col("o_orderkey").alias("page_no"), raw.alias("raw"))


def parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = responses(spark, sf_dir).withColumn("recs", _parse("raw", RECORD_SCHEMA))
    # posexplode_outer + filter: a plain explode makes Spark infer size(recs) > 0
    # below the projection, which would parse every answer twice more
    return (r.select("document_name", "page_no", F.posexplode_outer("recs").alias("rec_idx", "rec"))
            .where(F.col("rec_idx").isNotNull())
            .select("document_name", "page_no", "rec_idx", "rec.bin", "rec.pcn", "rec.grp", "rec.plan_name"))


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = responses(spark, sf_dir).withColumn("recs", _parse("raw", RECORD_SCHEMA))
    # the reject flag leaves through a generator (exactly one row per answer):
    # a filter on a generator's output is not pushed below it, so the parse
    # runs after the scan is spread instead of inside a single-split scan
    flagged = r.select("document_name", "page_no",
                       F.explode_outer(F.array(F.col("recs").isNull())).alias("_rejected"))
    return flagged.where("_rejected").select(
        "document_name", "page_no", F.lit("unparseable answer").alias("reason"))


def pipe_answers(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    raw = (F.when(F.col("l_returnflag") == "N",
                  F.concat(F.lit("BIN | PCN | Group | Plan\n"), F.col("l_partkey").cast("string"), F.lit(" | "),
                           F.col("l_linestatus"), F.lit(" | G"), F.col("l_suppkey").cast("string"),
                           F.lit(" | plan "), F.col("l_quantity").cast("int").cast("string"),
                           F.when(F.col("l_partkey") % 5 == 0, F.lit(" | note | second note | ")).otherwise(F.lit(""))))
           .when(F.col("l_returnflag") == "R", F.lit("No table was found in this document."))
           .otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(" |  | |"))))
    return li.select(F.col("l_orderkey").alias("key_id"), F.col("l_linenumber").alias("doc_pos"),
                     F.concat(F.lit("http://docs.example/"), F.col("l_partkey").cast("string"), F.lit(".pdf"))
                     .alias("link"), raw.alias("raw"))


def _pipe_rows(spark, sf_dir) -> DataFrame:
    return _rows_of(pipe_answers(spark, sf_dir))


def _rows_of(answers: DataFrame) -> DataFrame:
    a = answers.withColumn("rows", parse_pipe_table("raw", 5))
    rows = (a.select("key_id", "doc_pos", "link", F.posexplode_outer("rows").alias("row_idx", "p"))
            .where(F.col("row_idx").isNotNull()))
    return rows.select("key_id", "doc_pos", "link", "row_idx",
                       *[F.col("p")[i].alias(f"f{i + 1}") for i in range(5)], F.array_join(extra_parts("p", 5), "|").alias("more")).withColumn(
        "status", extraction_status("f1", "f2", "f3", "f4"))


def parse_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pipe_rows(spark, sf_dir)


def first_usable_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per key, the lowest document position that gave any row, and all its
    rows; keys whose documents gave none get one 'no_document' row."""
    answers = pipe_answers(spark, sf_dir)
    # an answer yields rows iff some line holds '|' (such a line always splits
    # into >= 2 parts, and min_parts is 1): choose documents on that cheap
    # test, then parse only the chosen answers
    first = (answers.where(F.col("raw").contains("|"))
             .groupBy("key_id").agg(F.min("doc_pos").alias("doc_pos")))
    chosen = _rows_of(answers.join(first, ["key_id", "doc_pos"]))
    keys = answers.select("key_id").distinct()
    missing = keys.join(first, "key_id", "left_anti").select(
        "key_id", F.lit(None).cast("int").alias("doc_pos"), F.lit(None).cast("string").alias("link"),
        F.lit(None).cast("int").alias("row_idx"),
        *[F.lit(None).cast("string").alias(f"f{i}") for i in range(1, 6)], F.lit(None).cast("string").alias("more"),
        F.lit("no_document").alias("status"))
    return chosen.select(*missing.columns).unionByName(missing)


QUERIES = {
    "parse_records": parse_records,
    "parse_rejects": parse_rejects,
    "parse_pipe": parse_pipe,
    "first_usable_doc": first_usable_doc,
}

_RESP = f"""
WITH o AS (
  SELECT *, {sql_pad6('o_custkey')} AS b FROM orders),
x AS (
  SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS document_name, o_orderkey AS page_no, o_orderpriority AS pr,
         '{{"bin": "' || b || '", "pcn": "' || o_orderstatus || '", "grp": "G' || CAST(o_orderkey AS VARCHAR)
           || '", "plan_name": "' || o_orderpriority || '"}}' AS rec1,
         '{{"bin": "' || b || '", "pcn": null, "grp": "H' || CAST(o_orderkey AS VARCHAR) || '", "plan_name": "second"}}' AS rec2
  FROM o),
y AS (SELECT *, '[' || rec1 || ', ' || rec2 || ']' AS arr FROM x),
r AS (
  SELECT document_name, page_no,
         CASE WHEN pr = '5-LOW' THEN '```json' || chr(10) || substring(arr, 1, 40)
              WHEN pr = '4-NOT SPECIFIED' THEN rec1
              WHEN pr = '3-MEDIUM' THEN 'Here are the records:' || chr(10) || arr || chr(10) || 'Done.'
              ELSE '```json' || chr(10) || arr || chr(10) || '```' END AS raw
  FROM y),
f AS (
  SELECT *, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(trim(raw, ' ' || chr(10)),
              '^```json', '')), '^```', '')), '```$', ''), ' ' || chr(10)) AS unfenced
  FROM r),
g AS (
  SELECT *, trim(CASE WHEN regexp_extract(unfenced, '(?s)\\[.*\\]', 0) <> '' THEN regexp_extract(unfenced, '(?s)\\[.*\\]', 0)
                      ELSE unfenced END, ' ' || chr(10)) AS body
  FROM f),
p AS (
  SELECT document_name, page_no,
         CASE WHEN starts_with(body, '[') AND ends_with(body, ']') AND json_valid(body)
              THEN from_json(body, '[{{"bin":"VARCHAR","pcn":"VARCHAR","grp":"VARCHAR","plan_name":"VARCHAR"}}]') END AS recs
  FROM g)
"""

_PIPE = r"""
WITH a AS (
  SELECT l_orderkey AS key_id, l_linenumber AS doc_pos,
         'http://docs.example/' || CAST(l_partkey AS VARCHAR) || '.pdf' AS link,
         CASE WHEN l_returnflag = 'N'
              THEN 'BIN | PCN | Group | Plan' || chr(10) || CAST(l_partkey AS VARCHAR) || ' | ' || l_linestatus
                   || ' | G' || CAST(l_suppkey AS VARCHAR) || ' | plan ' || CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR)
                   || CASE WHEN l_partkey % 5 = 0 THEN ' | note | second note | ' ELSE '' END
              WHEN l_returnflag = 'R' THEN 'No table was found in this document.'
              ELSE CAST(l_partkey AS VARCHAR) || ' |  | |' END AS raw
  FROM lineitem),
l AS (
  SELECT key_id, doc_pos, link,
         list_filter(string_split(raw, chr(10)), lambda x: contains(x, '|')) AS lines
  FROM a),
e AS (
  SELECT key_id, doc_pos, link, generate_subscripts(lines, 1) - 1 AS row_idx, unnest(lines) AS line FROM l),
q AS (
  SELECT key_id, doc_pos, link, row_idx,
         list_transform(string_split(line, '|'), lambda x: trim(x)) AS p FROM e),
rows AS (
  SELECT key_id, doc_pos, link, row_idx,
         coalesce(p[1], '') AS f1, coalesce(p[2], '') AS f2, coalesce(p[3], '') AS f3,
         coalesce(p[4], '') AS f4, coalesce(p[5], '') AS f5, array_to_string(p[6:], '|') AS more
  FROM q),
s AS (
  SELECT *, CASE WHEN f1 <> '' AND f2 <> '' AND f3 <> '' AND f4 <> '' THEN 'success'
                 WHEN f1 <> '' OR f2 <> '' OR f3 <> '' OR f4 <> '' THEN 'partial' ELSE 'none' END AS status
  FROM rows)
"""

SQL = {
    "parse_records": _RESP + """
SELECT document_name, page_no, CAST(i - 1 AS INTEGER) AS rec_idx, recs[i].bin AS bin, recs[i].pcn AS pcn,
       recs[i].grp AS grp, recs[i].plan_name AS plan_name
FROM (SELECT *, generate_subscripts(recs, 1) AS i FROM p WHERE recs IS NOT NULL)""",
    "parse_rejects": _RESP + """
SELECT document_name, page_no, 'unparseable answer' AS reason FROM p WHERE recs IS NULL""",
    "parse_pipe": _PIPE + "SELECT key_id, doc_pos, link, CAST(row_idx AS INTEGER) AS row_idx, f1, f2, f3, f4, f5, more, status FROM s",
    "first_usable_doc": _PIPE + """,
fst AS (SELECT key_id, min(doc_pos) AS doc_pos FROM s GROUP BY key_id)
SELECT s.key_id, s.doc_pos, s.link, CAST(s.row_idx AS INTEGER) AS row_idx, s.f1, s.f2, s.f3, s.f4, s.f5, s.more, s.status
FROM s JOIN fst ON s.key_id = fst.key_id AND s.doc_pos = fst.doc_pos
UNION ALL
SELECT k.key_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no_document'
FROM (SELECT DISTINCT key_id FROM a) k WHERE k.key_id NOT IN (SELECT key_id FROM fst)""",
}
