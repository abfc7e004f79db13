"""Dictionary and indicator matching (C8 C13 B9 F5 E6) over documents, benchmark, pages.

dictionary_match: every document's text, with 'Ø' read as '0' and wrapped
  lines merged, is split into lines; three dictionaries derived from
  ``benchmark`` (first two words, third word, last two words of each item) are
  matched case-insensitively on word boundaries.  Per document: the first
  processor hit, and the ", "-joined payer-parent and payer hits, in (line,
  offset, name) order; 'Not Found' when none.
network_indicator: ``pages`` as ranked search results (query = page_id div
  10, position = page_id mod 10); per query the first result (by position)
  whose lower-cased title/link/snippet contains an indicator, and the first
  indicator (by priority) inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import visible_text, zero_for_slashed_o
from ..operators import dictionary as DM
from ..operators.ordered import merge_wrapped_lines
from .base import param_table, sql_visible_text, table

WORD2 = r"^([A-Za-z]+ [A-Za-z]+)"
WORD3 = r"^[A-Za-z]+ [A-Za-z]+ ([A-Za-z]+)"
LAST2 = r"([A-Za-z]+ [A-Za-z]+)[^A-Za-z]*$"


def dictionaries(spark, sf_dir) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    rows = b.select("item_id",
                    F.regexp_extract("text", WORD2, 1).alias("processor"),
                    F.regexp_extract("text", WORD3, 1).alias("payer_parent"),
                    F.regexp_extract("text", LAST2, 1).alias("payer"))
    out = None
    for d in ("processor", "payer_parent", "payer"):
        part = (rows.select(F.lit(d).alias("dict"), F.col(d).alias("name"))
                .where(F.col("name") != "").distinct())
        out = part if out is None else out.unionByName(part)
    return out


def doc_lines(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", zero_for_slashed_o("text").alias("text"))
    merged = merge_wrapped_lines(d, "text", "merged").select("doc_id", "merged")
    return merged.select("doc_id", F.posexplode(F.split("merged", "\n", -1)).alias("line_no", "line"))


def dictionary_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = doc_lines(spark, sf_dir)
    hits = DM.word_matches(lines, dictionaries(spark, sf_dir), ["doc_id", "line_no"], "line", "name")
    # one hit list per (document, dictionary), folded into columns: the token
    # join runs once for all three dictionaries
    hl = DM.hit_list(hits, ["doc_id", "dict"], "name", ["line_no", "offset"], out_col="joined",
                     first_col="first")
    per_doc = hl.groupBy("doc_id").agg(
        F.max(F.when(F.col("dict") == "processor", F.col("first"))).alias("matched_processor"),
        F.max(F.when(F.col("dict") == "payer_parent", F.col("joined"))).alias("matched_payer_parents"),
        F.max(F.when(F.col("dict") == "payer", F.col("joined"))).alias("matched_payers"))
    docs = table(spark, sf_dir, "documents").select("doc_id")
    out = docs.join(per_doc, "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(DM.NOT_FOUND)).alias(c) for c in
                                  ("matched_processor", "matched_payer_parents", "matched_payers")])


# Invented parameter table for the registered query: (priority, indicator, network).
INDICATORS = [(1, ".org/", "Org Network"), (2, "/de/", "German Network"),
              (3, "m.", "Mobile Network"), (4, "example.net", "Net Network")]


def search_results(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.select(
        (F.col("page_id") / 10).cast("long").alias("query_id"),
        (F.col("page_id") % 10 + 1).cast("int").alias("pos"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.col("url").alias("link"),
        visible_text("html").alias("snippet"))


def network_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = search_results(spark, sf_dir)
    ind = param_table(spark, INDICATORS, ["priority", "indicator", "network"])
    combined = res.select("query_id", "pos", "link",
                          F.concat_ws(" ", "title", "link", "snippet").alias("text"))
    hits = DM.substring_matches(combined, ind, ["query_id", "pos", "link"], "text", "indicator")
    best = DM.first_by_priority(hits, ["query_id"], ["pos", "priority"], ["pos", "network", "link"])
    queries = res.select("query_id").distinct()
    return (queries.join(best, "query_id", "left")
            .select("query_id", F.coalesce("network", F.lit(DM.NOT_FOUND)).alias("network"),
                    F.col("pos").alias("result_pos"), F.col("link").alias("result_link")))


QUERIES = {"dictionary_match": dictionary_match, "network_indicator": network_indicator}

_W = r"[^\pL\p{Nd}_]"

SQL = {
    "dictionary_match": r"""
WITH docs AS (SELECT doc_id, replace(text, 'Ø', '0') AS text FROM documents),
lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS j,
         unnest(string_split(text, chr(10))) AS raw
  FROM docs),
s AS (SELECT doc_id, j, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM lines),
e AS (
  SELECT *, coalesce(j > 1 AND NOT regexp_matches(lag(line) OVER w, '\d{5,}') AND length(line) < 40
                     AND NOT regexp_matches(line, 'BIN|PCN|GRP|Effective'), false) AS edge
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY j)),
r AS (
  SELECT *, max(CASE WHEN edge AND NOT coalesce(prev_edge, false) THEN j END)
              OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_start
  FROM (SELECT *, lag(edge) OVER (PARTITION BY doc_id ORDER BY j) AS prev_edge FROM e)),
h AS (
  SELECT *, sum(CASE WHEN edge AND (j - run_start) % 2 = 0 THEN 0 ELSE 1 END)
              OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head
  FROM r),
ml AS (SELECT doc_id, head - 1 AS line_no, string_agg(line, ' ' ORDER BY j) AS line FROM h GROUP BY doc_id, head),
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
  SELECT ml.doc_id, ml.line_no, ml.line, dict.d, dict.name
  FROM ml, dict WHERE contains(lower(ml.line), lower(dict.name))),
occ AS (
  SELECT doc_id, line_no, d, name,
         list_filter(range(1, length(line) - length(name) + 2), lambda i:
           lower(substring(line, i, length(name))) = lower(name)
           AND (i = 1 OR NOT regexp_full_match(substring(line, i - 1, 1), '[\pL\p{Nd}_]'))
           AND (i + length(name) > length(line)
                OR NOT regexp_full_match(substring(line, i + length(name), 1), '[\pL\p{Nd}_]'))) AS ps
  FROM cand),
hits AS (SELECT doc_id, line_no, d, name, ps[1] AS off FROM occ WHERE len(ps) > 0),
firsts AS (SELECT doc_id, d, name, min((line_no, off)) AS o FROM hits GROUP BY ALL),
agg AS (
  SELECT doc_id, d, string_agg(name, ', ' ORDER BY o, name) AS names, arg_min(name, (o, name)) AS first_name
  FROM firsts GROUP BY doc_id, d)
SELECT documents.doc_id,
       coalesce(max(first_name) FILTER (WHERE d = 'processor'), 'Not Found') AS matched_processor,
       coalesce(max(names) FILTER (WHERE d = 'payer_parent'), 'Not Found') AS matched_payer_parents,
       coalesce(max(names) FILTER (WHERE d = 'payer'), 'Not Found') AS matched_payers
FROM documents LEFT JOIN agg ON documents.doc_id = agg.doc_id
GROUP BY documents.doc_id""",
    "network_indicator": f"""
WITH res AS (
  SELECT CAST(page_id // 10 AS BIGINT) AS query_id, CAST(page_id % 10 + 1 AS INTEGER) AS pos, url AS link,
         lower(concat_ws(' ', regexp_extract(html, '(?s)<title>(.*?)</title>', 1), url,
                         {sql_visible_text('html')})) AS t
  FROM pages),
""" + r"""ind AS (SELECT * FROM (VALUES (1, '.org/', 'Org Network'), (2, '/de/', 'German Network'),
                              (3, 'm.', 'Mobile Network'), (4, 'example.net', 'Net Network')) v(priority, indicator, network)),
hits AS (SELECT res.query_id, res.pos, res.link, ind.priority, ind.network
         FROM res JOIN ind ON contains(res.t, lower(ind.indicator))),
best AS (SELECT query_id, arg_min((pos, network, link), (pos, priority)) AS b FROM hits GROUP BY query_id)
SELECT q.query_id, coalesce(b.b[2], 'Not Found') AS network, b.b[1] AS result_pos, b.b[3] AS result_link
FROM (SELECT DISTINCT query_id FROM res) q LEFT JOIN best b ON q.query_id = b.query_id""",
}
