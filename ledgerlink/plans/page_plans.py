"""Page text -> records and rejects (L2: I2 B35 B36 B38 B9 F5 C8 B13-B15 B39 F1; H3 H4 K2 for what is pending).

A document is a turn of ``conversations``; its pages are two lines each.  Every third page (page_no mod 3 = 0) has a grid
of its lines' words, every third (page_no mod 3 = 2) a grid of one row, which is not used (B36).  Page numbers are read
from the split pages' names (B35).  Per page: empty pages are skipped, 'Ø' is read as '0', wrapped lines are merged, and
the three dictionaries derived from ``benchmark`` are matched (first processor; joined payer parents and payers; 'Not
Found' when none).  The model answer of a page is derived from it: a fenced JSON list with one record (payer name = the
page's first ASCII word, plan name = the role, effective date on page 2 only), cut short on page 4, an empty list on page
5, none on page 6; system turns answer with prose.  Answers are parsed once into records and rejects.  Records take their
page's document, number and match strings (B39), then the document-level fields are backfilled from the first page that
has them (F1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dictionary as DM
from ..operators import pages as P
from ..operators.ordered import doc_backfill, merge_wrapped_lines
from ..operators.records import parse_records
from ..streaming.incremental import pending
from ..streaming.page_job import rebuilt_ledger
from .base import table
from .dictionary_plans import dictionaries

PAGE_SCHEMA = "array<struct<payer_name:string,plan_name:string,effective_date:string>>"
DOC_FIELDS = ["payer_name", "effective_date"]
PAGE = ["document_name", "page_no"]


def page_documents(spark, sf_dir) -> DataFrame:
    """document_name, role, pages: array of (text, grid)."""
    c = table(spark, sf_dir, "conversations")
    lines = F.split("text", "\n", -1)

    def page(i: Column) -> Column:
        own = F.slice(F.col("_lines"), i * 2 + 1, F.lit(2))
        words = F.transform(own, lambda x: F.split(x, " ", -1))
        grid = F.when(i % 3 == 2, words).when(i % 3 == 1, F.slice(words, 1, 1))
        return F.struct(F.array_join(own, "\n").alias("text"), grid.alias("grid"))

    name = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(".pdf"))
    n = F.ceil(F.size("_lines") / 2).cast("int")
    return c.withColumn("_lines", lines).select(name.alias("document_name"), "role", F.transform(F.sequence(F.lit(0), n - 1), page).alias("pages"))


def _pages(spark, sf_dir) -> DataFrame:
    return P.readable_pages(P.split_pages(page_documents(spark, sf_dir))).drop("page_name")


def page_matches(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    merged = merge_wrapped_lines(pages.select("document_name", "page_no", "text"), "text", "merged")
    lines = merged.select("document_name", "page_no",
                          F.posexplode(F.split("merged", "\n", -1)).alias("line_no", "line"))
    keys = ["document_name", "page_no"]
    hits = DM.word_matches(lines, dictionaries(spark, sf_dir), keys + ["line_no"], "line", "name")
    hl = DM.hit_list(hits, keys + ["dict"], "name", ["line_no", "offset"], out_col="joined", first_col="first")
    return hl.groupBy(*keys).agg(
        F.max(F.when(F.col("dict") == "processor", F.col("first"))).alias("matched_processor"),
        F.max(F.when(F.col("dict") == "payer_parent", F.col("joined"))).alias("matched_payer_parents"),
        F.max(F.when(F.col("dict") == "payer", F.col("joined"))).alias("matched_payers"))


def page_answers(pages: DataFrame) -> DataFrame:
    """document_name, page_no, raw: the model's answer to each page."""
    word = F.regexp_extract("text", r"^([A-Za-z]+)", 1)
    date = F.when(F.col("page_no") == 2, F.lit("January 1, 2024")).otherwise(F.lit(""))
    record = F.concat(F.lit('[{"payer_name": "'), word, F.lit('", "plan_name": "'), F.col("role"), F.lit('", "effective_date": "'), date, F.lit('"}'))
    raw = (F.when(F.col("role") == "system", F.lit("No records on this page."))
           .when(F.col("page_no") == 4, F.concat(F.lit("```json\n"), record))
           .when(F.col("page_no") == 5, F.lit("```json\n[]\n```"))
           .when(F.col("page_no") != 6, F.concat(F.lit("```json\n"), record, F.lit("]\n```"))))
    return pages.select("document_name", "page_no", raw.alias("raw"))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.outcomes(page_answers(_pages(spark, sf_dir)), PAGE_SCHEMA)


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    recs = P.records_of(P.outcomes(page_answers(pages), PAGE_SCHEMA), PAGE)
    matched = page_matches(spark, sf_dir, pages)
    nf = F.lit(DM.NOT_FOUND)
    out = recs.join(matched, PAGE, "left").select(
        *PAGE, "rec_idx", "payer_name", "plan_name", "effective_date",
        *[F.coalesce(c, nf).alias(c) for c in ("matched_processor", "matched_payer_parents", "matched_payers")])
    return doc_backfill(out, "document_name", DOC_FIELDS, page_col="page_no", seq_col="rec_idx")


def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose answer is missing or no list, with the reason."""
    return P.rejects_of(page_outcomes(spark, sf_dir), PAGE)


def page_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 as a table: documents and pages read, pages rejected, records.  The job itself (streaming.page_job) observes
    the same counters while it writes its outcomes."""
    answers = page_answers(_pages(spark, sf_dir)).withColumn("recs", parse_records("raw", PAGE_SCHEMA))
    rejected = F.col("raw").isNull() | F.col("recs").isNull()
    return answers.agg(
        F.count_distinct("document_name").alias("documents"),
        F.count(F.lit(1)).alias("pages"),
        F.count_if(rejected).cast("long").alias("rejected_pages"),
        F.coalesce(F.sum(F.when(~rejected, F.size("recs"))), F.lit(0)).cast("long").alias("records"))


def pages_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, H3, H4: the documents a run still has to read.  The earlier run had the conversations of even number: those
    with records are processed (rebuilt from that output), those with nothing but rejects failed."""
    docs = page_documents(spark, sf_dir).select("document_name")
    earlier = F.regexp_extract("document_name", r"^conv_(\d+)_", 1).cast("long") % 2 == 0
    ledger = rebuilt_ledger(page_outcomes(spark, sf_dir).where(earlier))
    return pending(docs, ledger, "document_name")


def page_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: document, status (processed or failed) and reason, rebuilt from the outcomes of a run over all documents."""
    return rebuilt_ledger(page_outcomes(spark, sf_dir))


QUERIES = {"page_records": page_records, "page_rejects": page_rejects, "page_run_counters": page_run_counters, "pages_pending": pages_pending, "page_ledger": page_ledger}

_W = r"[^\pL\p{Nd}_]"

SQL = {
    "page_records": r"""
WITH src AS (
  SELECT 'conv_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.pdf' AS document_name, role,
         string_split(text, chr(10)) AS ls
  FROM conversations WHERE text IS NOT NULL),
pg AS (SELECT *, unnest(range(0, CAST(ceil(len(ls) / 2) AS BIGINT))) AS i FROM src),
cut AS (SELECT document_name, role, i, list_slice(ls, i * 2 + 1, i * 2 + 2) AS own FROM pg),
pages AS (
  SELECT document_name, CAST(i + 1 AS INTEGER) AS page_no, role, text FROM (
    SELECT *, replace(CASE WHEN i % 3 = 2 AND len(own) > 1
                           THEN array_to_string(list_transform(own, lambda x: array_to_string(string_split(x, ' '), ' | ')), chr(10))
                           ELSE array_to_string(own, chr(10)) END, 'Ø', '0') AS text FROM cut)
  WHERE trim(text) <> ''),
lines AS (
  SELECT document_name, page_no, generate_subscripts(string_split(text, chr(10)), 1) AS j,
         unnest(string_split(text, chr(10))) AS raw
  FROM pages),
s AS (SELECT document_name, page_no, j, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM lines),
e AS (
  SELECT *, coalesce(j > 1 AND NOT regexp_matches(lag(line) OVER w, '\d{5,}') AND length(line) < 40
                     AND NOT regexp_matches(line, 'BIN|PCN|GRP|Effective'), false) AS edge
  FROM s WINDOW w AS (PARTITION BY document_name, page_no ORDER BY j)),
r AS (
  SELECT *, max(CASE WHEN edge AND NOT coalesce(prev_edge, false) THEN j END)
              OVER (PARTITION BY document_name, page_no ORDER BY j
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_start
  FROM (SELECT *, lag(edge) OVER (PARTITION BY document_name, page_no ORDER BY j) AS prev_edge FROM e)),
h AS (
  SELECT *, sum(CASE WHEN edge AND (j - run_start) % 2 = 0 THEN 0 ELSE 1 END)
              OVER (PARTITION BY document_name, page_no ORDER BY j
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head
  FROM r),
ml AS (
  SELECT document_name, page_no, head - 1 AS line_no, string_agg(line, ' ' ORDER BY j) AS line
  FROM h GROUP BY document_name, page_no, head),
b AS (
  SELECT regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1) AS processor,
         regexp_extract(text, '^[A-Za-z]+ [A-Za-z]+ ([A-Za-z]+)', 1) AS payer_parent,
         regexp_extract(text, '([A-Za-z]+ [A-Za-z]+)[^A-Za-z]*$', 1) AS payer
  FROM benchmark),
dict AS (
  SELECT DISTINCT 'processor' AS d, processor AS name FROM b WHERE processor <> ''
  UNION SELECT DISTINCT 'payer_parent', payer_parent FROM b WHERE payer_parent <> ''
  UNION SELECT DISTINCT 'payer', payer FROM b WHERE payer <> ''),
cand AS (
  SELECT ml.document_name, ml.page_no, ml.line_no, ml.line, dict.d, dict.name
  FROM ml, dict WHERE contains(lower(ml.line), lower(dict.name))),
occ AS (
  SELECT document_name, page_no, line_no, d, name,
         list_filter(range(1, length(line) - length(name) + 2), lambda i:
           lower(substring(line, i, length(name))) = lower(name)
           AND (i = 1 OR NOT regexp_full_match(substring(line, i - 1, 1), '[\pL\p{Nd}_]'))
           AND (i + length(name) > length(line)
                OR NOT regexp_full_match(substring(line, i + length(name), 1), '[\pL\p{Nd}_]'))) AS ps
  FROM cand),
hits AS (SELECT document_name, page_no, line_no, d, name, ps[1] AS off FROM occ WHERE len(ps) > 0),
firsts AS (SELECT document_name, page_no, d, name, min((line_no, off)) AS o FROM hits GROUP BY ALL),
agg AS (
  SELECT document_name, page_no, d, string_agg(name, ', ' ORDER BY o, name) AS names,
         arg_min(name, (o, name)) AS first_name
  FROM firsts GROUP BY document_name, page_no, d),
pm AS (
  SELECT document_name, page_no,
         max(first_name) FILTER (WHERE d = 'processor') AS matched_processor,
         max(names) FILTER (WHERE d = 'payer_parent') AS matched_payer_parents,
         max(names) FILTER (WHERE d = 'payer') AS matched_payers
  FROM agg GROUP BY document_name, page_no),
ans AS (
  SELECT document_name, page_no,
         CASE WHEN role = 'system' THEN 'No records on this page.'
              WHEN page_no = 4 THEN '```json' || chr(10) || rec
              WHEN page_no = 5 THEN '```json' || chr(10) || '[]' || chr(10) || '```'
              WHEN page_no <> 6 THEN '```json' || chr(10) || rec || ']' || chr(10) || '```' END AS raw
  FROM (SELECT *, '[{"payer_name": "' || regexp_extract(text, '^([A-Za-z]+)', 1) || '", "plan_name": "' || role
                  || '", "effective_date": "' || CASE WHEN page_no = 2 THEN 'January 1, 2024' ELSE '' END || '"}' AS rec FROM pages)),
f AS (
  SELECT *, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(trim(raw, ' ' || chr(10)),
              '^```json', '')), '^```', '')), '```$', ''), ' ' || chr(10)) AS unfenced
  FROM ans),
g AS (
  SELECT *, trim(CASE WHEN regexp_extract(unfenced, '(?s)\[.*\]', 0) <> '' THEN regexp_extract(unfenced, '(?s)\[.*\]', 0)
                      ELSE unfenced END, ' ' || chr(10)) AS body
  FROM f),
p AS (
  SELECT document_name, page_no, raw,
         CASE WHEN starts_with(body, '[') AND ends_with(body, ']') AND json_valid(body)
              THEN from_json(body, '[{"payer_name":"VARCHAR","plan_name":"VARCHAR","effective_date":"VARCHAR"}]') END AS recs
  FROM g),
recs AS (
  SELECT document_name, page_no, CAST(i - 1 AS INTEGER) AS rec_idx, recs[i].payer_name AS payer_name,
         recs[i].plan_name AS plan_name, recs[i].effective_date AS effective_date
  FROM (SELECT *, generate_subscripts(recs, 1) AS i FROM p WHERE recs IS NOT NULL)),
o AS (
  SELECT recs.*, coalesce(pm.matched_processor, 'Not Found') AS matched_processor,
         coalesce(pm.matched_payer_parents, 'Not Found') AS matched_payer_parents,
         coalesce(pm.matched_payers, 'Not Found') AS matched_payers
  FROM recs LEFT JOIN pm ON recs.document_name = pm.document_name AND recs.page_no = pm.page_no)
SELECT document_name, page_no, rec_idx,
       coalesce(regexp_replace(first_value(CASE WHEN length(payer_name) > 0 THEN payer_name END IGNORE NULLS) OVER w,
                               '^\s+|\s+$', '', 'g'), '') AS payer_name,
       plan_name,
       coalesce(regexp_replace(first_value(CASE WHEN length(effective_date) > 0 THEN effective_date END IGNORE NULLS) OVER w,
                               '^\s+|\s+$', '', 'g'), '') AS effective_date,
       matched_processor, matched_payer_parents, matched_payers
FROM o
WINDOW w AS (PARTITION BY document_name ORDER BY page_no NULLS LAST, rec_idx
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
}

# the pages and their answers as in page_records, parsed or not
_PARSED = SQL["page_records"]
_PARSED = (_PARSED[:_PARSED.index("lines AS (")] + _PARSED[_PARSED.index("ans AS ("):_PARSED.index("recs AS (")]).rstrip().rstrip(",")
_LEDGER = _PARSED + """,
ledger AS (
  SELECT document_name, CASE WHEN bool_or(len(recs) > 0) THEN 'processed' ELSE 'failed' END AS status,
         CASE WHEN NOT coalesce(bool_or(len(recs) > 0), false) THEN min(CASE WHEN raw IS NULL THEN 'no answer' ELSE 'unparseable answer' END) END AS reason
  FROM p WHERE recs IS NULL OR len(recs) > 0 GROUP BY document_name)"""
SQL["page_rejects"] = _PARSED + """
SELECT document_name, page_no, CASE WHEN raw IS NULL THEN 'no answer' ELSE 'unparseable answer' END AS reason FROM p WHERE recs IS NULL"""
SQL["page_run_counters"] = _PARSED + """
SELECT CAST(count(DISTINCT document_name) AS BIGINT) AS documents, CAST(count(*) AS BIGINT) AS pages,
       CAST(count(*) FILTER (WHERE recs IS NULL) AS BIGINT) AS rejected_pages,
       CAST(coalesce(sum(len(recs)), 0) AS BIGINT) AS records
FROM p"""
SQL["page_ledger"] = _LEDGER + "\nSELECT document_name, status, reason FROM ledger"
SQL["pages_pending"] = _LEDGER + """
SELECT document_name FROM src ANTI JOIN (
  SELECT document_name FROM ledger WHERE CAST(regexp_extract(document_name, '^conv_(\\d+)_', 1) AS BIGINT) % 2 = 0) USING (document_name)"""
