"""Line scans, routing, numbering, profiles and list matching (A2 A8 B3 C9 G3 K3) over derived lines, orders and pages.

line_routes: each order's key text (B1) is written to text files, an empty line for every fiftieth; the files are scanned
  as Latin-1 lines numbered over all files, and the valid and invalid lines written apart and read back (A2 B3).
row_numbers: the orders numbered by price, highest first, without a single sorting task (G3).
profile_orders: every column's type, exact counts and first value (A8).
last_payer_match: per page the last listed payer and processor whose name its text holds, as plain substrings (C9).
backfill_merged: F1 from partial aggregates of three batches (K3).
download_queue: orders assigned to one reader that still need a link (B22).
table_pages: which derived page texts look like tables (B30), and their labelled plan type (B34).
listed_files: comma lists of file names as rows in natural order, from two sources with differing columns (I3 G2 H1 B25).
last_orders: the last hundred orders (G4).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import is_valid_bpg, parse_bpg
from ..functions.text import TABLE_PATTERNS, labelled_value, looks_like_table, visible_text
from ..operators import dictionary as DM
from ..operators import numbering as N
from ..operators import search as S
from ..operators.conform import first_existing, union_all
from ..operators.links import natural_key, split_list
from ..operators.ordered import first_values
from ..session import ensure_checkpoint_dir
from ..sources.io import profile, scan_lines
from .base import sql_visible_text, table
from .keys_plans import _K, _keys
from .records_plans import _conv_records

LINE_SCHEMA = "line_no long, line string, bin string, pcn string, grp string, route string"


def line_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    text = F.when(F.col("seq") % 50 == 0, F.lit("")).otherwise(F.col("bpg"))
    _keys(spark, sf_dir).repartitionByRange("seq").sortWithinPartitions("seq").select(text.alias("value")).write.text(f"{folder}/in")
    lines = scan_lines(spark, f"{folder}/in").withColumn("p", parse_bpg("line"))
    parsed = lines.select("line_no", "line", "p.bin", "p.pcn", "p.grp")
    N.write_routed(parsed, is_valid_bpg("line"), f"{folder}/routed")
    both = [N.read_routed(spark, f"{folder}/routed", LINE_SCHEMA, route).withColumn("route", F.lit(route)) for route in (N.VALID, N.INVALID)]
    return both[0].unionByName(both[1])


def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return N.number_rows(o, [F.desc("o_totalprice"), F.asc("o_orderkey")])


def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "orders"), "o_orderkey")


def _listed(spark, sf_dir) -> DataFrame:
    """kind, pos, name: payers are the first words of the benchmark items, processors their second ones."""
    b = table(spark, sf_dir, "benchmark")
    payer, processor = (F.regexp_extract("text", r"^([A-Za-z]+) ([A-Za-z]+)", k) for k in (1, 2))
    names = F.array(*[F.struct(F.lit(kind).alias("kind"), name.alias("name")) for kind, name in (("payer", payer), ("processor", processor))])
    rows = b.select(F.col("item_id").alias("pos"), F.explode(names).alias("x")).select("pos", "x.kind", "x.name")
    # of equal names the last listed counts
    return rows.where("name <> ''").groupBy("kind", F.lower("name").alias("low")).agg(F.max(F.struct("pos", "name")).alias("x")).select("kind", "x.pos", "x.name")


def last_payer_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", visible_text("html").alias("text"))
    hits = DM.substring_matches(p, _listed(spark, sf_dir), ["page_id"], "text", "name")
    best = hits.groupBy("page_id").agg(*[F.max_by(F.when(F.col("kind") == k, F.col("name")), F.when(F.col("kind") == k, F.col("pos"))).alias(f"matched_{k}") for k in ("payer", "processor")])
    return p.select("page_id").join(best, "page_id", "left").fillna("", ["matched_payer", "matched_processor"])


def backfill_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _conv_records(spark, sf_dir).where("document_name IS NOT NULL")
    fields = ["processor", "payer"]
    parts = None
    for batch in range(3):  # as three runs would store them
        part = first_values(rows.where(F.col("seq") % 3 == batch), "document_name", fields, "page_no", "seq")
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("document_name").agg(*[F.min(f).alias(f) for f in fields])
    return merged.select("document_name", *[F.coalesce(F.col(f"{f}.v"), F.lit("")).alias(f) for f in fields])


def download_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    rows = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "ann").when(F.col("o_orderstatus") == "O", "ben").alias("assigned_to"),
                    F.when(k % 3 == 0, F.concat(F.lit("http://docs.example/"), k.cast("string"), F.lit(".pdf"))).when(k % 3 == 1, " ").alias("pdf_links"),
                    F.when(k % 4 == 0, "not found").when(k % 4 == 1, "again").alias("comments"))
    return S.download_candidates(rows, "ann")


def table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, bin_ = F.col("o_orderkey"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    text = (F.when(k % 5 == 0, F.concat(F.lit("Payer sheet\nbin and pcn Combinations\nPlan Type: "), "o_orderpriority"))
            .when(k % 5 == 1, F.concat(F.lit("codes\n  "), bin_, F.lit(" ABC \nNote: none")))
            .when(k % 5 == 2, F.concat(F.lit("  Plan Type:  "), "o_orderstatus", F.lit("  \n"), bin_, F.lit(" A")))
            .when(k % 5 == 3, F.concat(F.lit("BIN  number\tand  Note \nrest"), F.lit("")))
            .otherwise(F.lit("plain text with a BIN in it")))
    rows = o.select("o_orderkey", text.alias("text"))
    found = labelled_value("text", "Plan Type")
    return rows.select("o_orderkey", looks_like_table("text").alias("is_table"), F.coalesce(found, F.lit(DM.NOT_FOUND)).alias("plan_type"))


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(key: str):
        k = F.col(key)
        return F.concat_ws(", ", F.concat(F.lit("pdf_"), (k % 97).cast("string"), F.lit(".pdf")), F.lit(""), F.when(k % 2 == 0, F.concat(F.lit("vol2_pdf_"), k.cast("string"), F.lit(".PDF"))), F.when(k % 3 == 0, F.lit("none.pdf")))

    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), names("c_custkey").alias("files"), F.col("c_custkey").alias("c_key"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"), names("s_suppkey").alias("files"), F.col("s_suppkey").alias("s_key"))
    both = union_all([a, b])
    rows = both.select("source", "c_key", "s_key", F.explode(split_list(first_existing(both, ["listed", "files"]))).alias("file_name"))
    return rows.withColumn("number", natural_key("file_name"))


def last_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.last_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


QUERIES = {"download_queue": download_queue, "table_pages": table_pages, "listed_files": listed_files, "last_orders": last_orders,
           "line_routes": line_routes, "row_numbers": row_numbers, "profile_orders": profile_orders,
           "last_payer_match": last_payer_match, "backfill_merged": backfill_merged}

_ORDER_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                  ("o_orderdate", "{date}"), ("o_orderpriority", "string")]


def _profile_sql() -> str:
    parts = []
    for i, (c, kind) in enumerate(_ORDER_COLUMNS):
        kind = "CASE WHEN typeof(min(o_orderdate)) = 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE 'timestamp_ntz' END" if kind == "{date}" else f"'{kind}'"
        parts.append(f"SELECT {i} AS position, '{c}' AS column, {kind} AS type, count(*) AS rows, count({c}) AS non_null, "
                     f"count(DISTINCT {c}) AS distinct, arg_min(CAST({c} AS VARCHAR), o_orderkey) AS first FROM orders")
    return "\nUNION ALL ".join(parts)


_LINES = _K[:_K.index("s AS (")].rstrip().rstrip(",") + """,
l AS (SELECT row_number() OVER (ORDER BY seq) AS line_no, CASE WHEN seq % 50 = 0 THEN '' ELSE bpg END AS line FROM k),
s AS (SELECT line_no, line, string_split(line, '~') AS parts FROM l)"""

SQL = {
    "line_routes": _LINES + """
SELECT line_no, line, """ + ", ".join(
        f"CASE WHEN parts[{i}] = 'NULL' OR trim(parts[{i}]) = '' THEN NULL ELSE trim(parts[{i}]) END AS {n}" for i, n in enumerate(("bin", "pcn", "grp"), 1)) + """,
       CASE WHEN len(parts) = 3 THEN 'valid' ELSE 'invalid' END AS route
FROM s""",
    "row_numbers": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_no FROM orders",
    "profile_orders": _profile_sql(),
    "last_payer_match": f"""
WITH p AS (SELECT page_id, lower({sql_visible_text('html')}) AS t FROM pages),
n AS (
  SELECT item_id AS pos, unnest(['payer', 'processor']) AS kind,
         unnest([regexp_extract(text, '^([A-Za-z]+) ([A-Za-z]+)', 1), regexp_extract(text, '^([A-Za-z]+) ([A-Za-z]+)', 2)]) AS name
  FROM benchmark),
h AS (SELECT p.page_id, n.kind, n.pos, n.name FROM p JOIN n ON n.name <> '' AND contains(p.t, lower(n.name))),
b AS (SELECT page_id, kind, arg_max(name, pos) AS name FROM h GROUP BY page_id, kind)
SELECT page_id, coalesce((SELECT name FROM b WHERE b.page_id = p.page_id AND kind = 'payer'), '') AS matched_payer,
       coalesce((SELECT name FROM b WHERE b.page_id = p.page_id AND kind = 'processor'), '') AS matched_processor
FROM p""",
}


def _merged_sql() -> str:
    from .records_plans import SQL as RECORDS

    return f"SELECT DISTINCT document_name, processor, payer FROM ({RECORDS['doc_backfill']})"


SQL["backfill_merged"] = _merged_sql()
SQL["download_queue"] = """
SELECT * FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ann' WHEN 'O' THEN 'ben' END AS assigned_to,
         CASE o_orderkey % 3 WHEN 0 THEN 'http://docs.example/' || CAST(o_orderkey AS VARCHAR) || '.pdf' WHEN 1 THEN ' ' END AS pdf_links,
         CASE o_orderkey % 4 WHEN 0 THEN 'not found' WHEN 1 THEN 'again' END AS comments
  FROM orders)
WHERE assigned_to = 'ann' AND (pdf_links IS NULL OR trim(pdf_links) = '') AND comments IS DISTINCT FROM 'not found'"""
_TABLES = " OR ".join(f"regexp_matches(text, '(?im){p}')" for p in TABLE_PATTERNS)
SQL["table_pages"] = f"""
WITH t AS (
  SELECT o_orderkey, CASE o_orderkey % 5
      WHEN 0 THEN 'Payer sheet' || chr(10) || 'bin and pcn Combinations' || chr(10) || 'Plan Type: ' || o_orderpriority
      WHEN 1 THEN 'codes' || chr(10) || '  ' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ' ABC ' || chr(10) || 'Note: none'
      WHEN 2 THEN '  Plan Type:  ' || o_orderstatus || '  ' || chr(10) || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ' A'
      WHEN 3 THEN 'BIN  number' || chr(9) || 'and  Note ' || chr(10) || 'rest'
      ELSE 'plain text with a BIN in it' END AS text
  FROM orders)
SELECT o_orderkey, ({_TABLES}) AS is_table,
       coalesce(nullif(regexp_extract(text, '(?m)^\\s*Plan Type:\\s*(.*?)\\s*$', 1), ''), 'Not Found') AS plan_type
FROM t"""
_FILES = ("concat_ws(', ', 'pdf_' || CAST({k} % 97 AS VARCHAR) || '.pdf', '', CASE WHEN {k} % 2 = 0 THEN 'vol2_pdf_' || CAST({k} AS VARCHAR) || '.PDF' END, "
          "CASE WHEN {k} % 3 = 0 THEN 'none.pdf' END)")
SQL["listed_files"] = f"""
WITH f AS (
  SELECT 'customer' AS source, {_FILES.format(k='c_custkey')} AS files, c_custkey AS c_key, NULL::BIGINT AS s_key FROM customer
  UNION ALL SELECT 'supplier', {_FILES.format(k='s_suppkey')}, NULL, s_suppkey FROM supplier),
e AS (SELECT source, c_key, s_key, unnest(string_split(files, ', ')) AS file_name FROM f)
SELECT *, TRY_CAST(nullif(regexp_extract(file_name, '(\\d+)\\D*$', 1), '') AS BIGINT) AS number FROM e WHERE file_name <> ''"""
SQL["last_orders"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 100"
