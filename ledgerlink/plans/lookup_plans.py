"""Search-result and small-column plans (L8 L10 pieces: B10 B18-B20 B23 B24 B26 B27
B29 C13 C14 F6) over orders, pages, customer and the parsed records.

Search results are the pages: query = page_id div 10, position = page_id mod
10 + 1, title text = the page title's ASCII letters plus a layout suffix
chosen by page_id mod 6, link = the URL (with '.pdf' added when page_id mod 3
is 0), sitelinks = the page's anchors (with '.pdf' added to even-length ones),
snippet = all text the page shows, with a last paragraph chosen by page_id mod 7.
Keyword and domain tables below are invented parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lookup as LK
from ..functions.rules import Rule, rules_of, sql_first_rule
from ..functions.text import file_name_from_url, prefix_when, url_type, visible_text
from ..operators.conform import conform as _conform
from ..operators.dictionary import first_by_priority, substring_matches
from ..operators.links import pick_document_link
from .base import param_table, sql_visible_text, table
from .dictionary_plans import INDICATORS
from .extract_plans import parse_records
from .keys_plans import _keys

# Invented parameter tables for the registered queries.
# (priority, pattern, group, longer_than, stop_words, label)
TITLE_RULES = [
    (1, r"(?i)^([A-Z][A-Za-z ]+?)\s+Formulary\b", 1, 2, ["download", "file"], None),
    (2, r"(?i)^([A-Z][A-Za-z ]+?)\s+Preferred\s+Drug\s+List", 1, 2, ["download"], None),
    (3, r"(?i)^([A-Z][A-Za-z ]+?)\s+PDL\s+\d+", 1, 4, [], None),
    (4, r"(?i)ththth", 0, 0, [], "Thread Health"),
    (5, r"(?i)onen", 0, 0, [], "Onen Benefits"),
    (6, r"(?i)([A-Z][a-z]+)\s+Medicaid", 1, 0, [], "{} State Plan"),
]
TRUSTED_DOMAINS = ["example.org", "m."]
CHANNEL_KEYWORDS = [("house", "Household"), ("mach", "Machinery"), ("auto", "Automotive"), ("build", "Building")]
LATE_PARAGRAPHS = ["Effective 12 March 2021", "", "Choice Coverage for 2020-07-09", "", "Union Members", "Revised 3/14/2019", ""]
SUFFIXES = [" Formulary", " Preferred Drug List", " PDL 2024", " Download Formulary", " Medicaid", ""]


def _date_texts(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    y, m, dd = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    mn = F.date_format(d, "MMMM")
    pr = F.col("o_orderpriority")
    text = (F.when(pr == "1-URGENT", F.concat(F.lit("Updated "), mn, F.lit(" "), dd, F.lit(", "), y))
            .when(pr == "2-HIGH", F.concat(F.lit("Effective "), dd, F.lit(" "), F.lower(mn), F.lit(" "), y))
            .when(pr == "3-MEDIUM", F.concat(F.lit("Date: "), m, F.lit("/"), dd, F.lit("/"), y))
            .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("Rev "), y, F.lit("-"), F.lpad(m, 2, "0"),
                                                    F.lit("-"), F.lpad(dd, 2, "0")))
            .otherwise(F.concat(F.lit("due 13/40/"), y, F.lit(" and "), m, F.lit("/"), dd, F.lit("/"), y)))
    return o.select("o_orderkey", text.alias("text"))


def date_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _date_texts(spark, sf_dir)
    return t.select("o_orderkey", "text", LK.extract_date("text").alias("document_date"))


def late_paragraph():
    """A last paragraph whose hits stand nowhere else on the page, chosen by page_id mod 7."""
    return F.element_at(F.array(*[F.lit(f"<p>{x}</p>") for x in LATE_PARAGRAPHS]), (F.col("page_id") % 7 + 1).cast("int"))


def search_results(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("page_id") % 6 + 1).cast("int"))
    html = F.concat("html", late_paragraph())
    raw_title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    title = F.concat(F.trim(F.regexp_replace(raw_title, "[^A-Za-z ]", " ")), suffix)
    link = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit(".pdf"))).otherwise(F.col("url"))
    anchors = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)
    sitelinks = F.transform(anchors, lambda a: F.struct(
        F.when(F.length(a) % 2 == 0, F.concat(a, F.lit(".pdf"))).otherwise(a).alias("link")))
    return p.select("page_id", (F.col("page_id") / 10).cast("long").alias("query_id"),
                    (F.col("page_id") % 10 + 1).cast("int").alias("pos"), title.alias("title"),
                    link.alias("link"), visible_text(html).alias("snippet"),
                    sitelinks.alias("sitelinks"))


def title_rule_table(spark) -> DataFrame:
    return param_table(spark, [(*r[:4], F.array(*[F.lit(w) for w in r[4]]).cast("array<string>"), F.lit(r[5]).cast("string")) for r in TITLE_RULES],
                       ["priority", "pattern", "group", "longer_than", "stop_words", "label"])


def plan_name(spark, title):
    """B27 by the rules of the table."""
    return LK.plan_name_from_title(title, rules_of(title_rule_table(spark)))


def title_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = search_results(spark, sf_dir)
    return r.select("page_id", "title", plan_name(spark, "title").alias("plan_name"))


def link_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = search_results(spark, sf_dir)
    return r.select("page_id", "link",
                    F.coalesce(pick_document_link("link", "sitelinks"), F.lit(LK.NOT_FOUND)).alias("picked_link"))


def plan_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 core: trusted-first result with a plan name (F6); else the network
    indicator result (C13); plus the document link (B29), date (B26) and the
    trusted-title verification flag (C14, D15)."""
    r = search_results(spark, sf_dir)
    trusted = F.lit(False)
    for dom in TRUSTED_DOMAINS:
        trusted = trusted | F.lower("link").contains(dom)
    r = (r.withColumn("trusted", trusted)
         .withColumn("plan_name", plan_name(spark, "title"))
         .withColumn("pdf_link", F.coalesce(pick_document_link("link", "sitelinks"), F.lit(LK.NOT_FOUND)))
         .withColumn("doc_date", LK.extract_date(F.concat_ws(" ", "title", "snippet"))))
    named = r.where(F.col("plan_name") != LK.NOT_FOUND).withColumn("untrusted", ~F.col("trusted"))
    pick = first_by_priority(named, ["query_id"], ["untrusted", "pos"], ["plan_name", "pdf_link", "doc_date"])
    ind = param_table(spark, INDICATORS, ["priority", "indicator", "network"])
    hits = substring_matches(r.select("query_id", "pos", "pdf_link", "doc_date",
                                      F.concat_ws(" ", "title", "link", "snippet").alias("text")),
                             ind, ["query_id", "pos", "pdf_link", "doc_date"], "text", "indicator")
    net = first_by_priority(hits, ["query_id"], ["pos", "priority"], ["network", "pdf_link", "doc_date"]) \
        .select("query_id", F.col("network").alias("n_plan"), F.col("pdf_link").alias("n_link"),
                F.col("doc_date").alias("n_date"))
    out = (r.select("query_id").distinct().join(pick, "query_id", "left").join(net, "query_id", "left")
           .select("query_id",
                   F.coalesce("plan_name", "n_plan", F.lit(LK.NOT_FOUND)).alias("plan_type"),
                   F.when(F.col("plan_name").isNotNull(), F.col("pdf_link"))
                    .otherwise(F.coalesce("n_link", F.lit(LK.NOT_FOUND))).alias("pdf_link"),
                   F.when(F.col("plan_name").isNotNull(), F.col("doc_date"))
                    .otherwise(F.coalesce("n_date", F.lit(LK.NOT_FOUND))).alias("document_date")))
    ver = (r.where("trusted").select("query_id", F.lower("title").alias("lt"))
           .join(out.select("query_id", "plan_type"), "query_id")
           .where((F.col("plan_type") != LK.NOT_FOUND) & F.col("lt").contains(F.lower("plan_type")))
           .select("query_id").distinct().withColumn("verified", F.lit(True)))
    return (out.join(ver, "query_id", "left")
            .withColumn("verified", F.coalesce("verified", F.lit(False))))


def channel_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    k = F.col("c_custkey") % 4
    raw = (F.when(k == 0, F.lower(seg)).when(k == 1, F.concat(F.lit("  "), seg, F.lit(" dept")))
           .when(k == 2, F.lit("")).otherwise(seg))
    return c.select("c_custkey", raw.alias("raw")).withColumn(
        "channel", LK.normalize_channel("raw", CHANNEL_KEYWORDS))


def url_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id") % 3
    url = (F.when(k == 0, F.concat("url", F.lit(".pdf")))
           .when(k == 1, F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit(".xlsx")))
           .otherwise(F.col("url")))
    r = p.select("page_id", url.alias("url"))
    name = file_name_from_url("url")
    return r.select("page_id", "url", url_type("url").alias("url_type"), name.alias("file_name"),
                    file_name_from_url("url", F.concat(F.lit("p"), F.col("page_id").cast("string")))
                    .alias("prefixed_name"),
                    prefix_when(name, "1", "vol2_").alias("renamed"))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key; an invalid key has the status 'invalid_key' and no query."""
    from ..functions.keys import is_valid_bpg, parse_bpg
    k = _keys(spark, sf_dir).withColumn("p", parse_bpg("bpg")).withColumn("valid", is_valid_bpg("bpg"))
    query = F.when(F.col("valid"), LK.compose_query(F.col("p.bin"), F.col("p.pcn"), F.col("p.grp")))
    return k.select("seq", "bpg", query.alias("query"),
                    F.when(F.col("valid"), F.lit("ok")).otherwise(F.lit("invalid_key")).alias("status"))


CONFORM_COLUMNS = ["document_name", "page_no", "bin", "pcn", "grp", "plan_name", "effective_date", "channel"]


def conform_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(parse_records(spark, sf_dir), CONFORM_COLUMNS, "(NULL)")


QUERIES = {
    "date_extract": date_extract,
    "title_plan": title_plan,
    "link_pick": link_pick,
    "plan_lookup": plan_lookup,
    "channel_normalize": channel_normalize,
    "url_report": url_report,
    "search_queries": search_queries,
    "conform_records": conform_records,
}

# ---------------------------------------------------------------- oracle SQL
_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in LK.MONTHS) + "]"


def _date_sql(expr: str) -> str:
    found = []
    for pattern, month, day, year, numeric in LK.DATE_LAYOUTS:
        p = pattern.replace("'", "''")
        m, d, y = (f"regexp_extract(x, '{p}', {k})" for k in (month, day, year))
        out = (f"{_MONTHS_SQL}[CAST({m} AS INTEGER)]" if numeric else m) + f" || ' ' || {d} || ', ' || {y}"
        if numeric:
            out = (f"CASE WHEN CAST({m} AS INTEGER) BETWEEN 1 AND 12 AND CAST({d} AS INTEGER) BETWEEN 1 AND 31 "
                   f"AND CAST({y} AS INTEGER) BETWEEN {LK.YEARS[0]} AND {LK.YEARS[1]} THEN {out} END")
        found.append(f"list_filter(list_transform(regexp_extract_all({expr}, '{p}', 0), lambda x: {out}), lambda x: x IS NOT NULL)[1]")
    return f"coalesce({', '.join(found)}, 'Not Found')"


def _title_sql(expr: str) -> str:
    return f"coalesce({sql_first_rule(expr, [Rule(r[1], r[2], r[3], tuple(r[4]), r[5]) for r in TITLE_RULES])}, 'Not Found')"


SQL_HTML = "(html || [" + ", ".join(f"'<p>{x}</p>'" for x in LATE_PARAGRAPHS) + "][page_id % 7 + 1])"
_SUFFIX_SQL = "[" + ", ".join(f"'{s}'" for s in SUFFIXES) + "]"
_RESULTS = f"""
WITH r0 AS (
  SELECT page_id, CAST(page_id // 10 AS BIGINT) AS query_id, CAST(page_id % 10 + 1 AS INTEGER) AS pos,
         trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '[^A-Za-z ]', ' ', 'g'))
           || {_SUFFIX_SQL}[page_id % 6 + 1] AS title,
         CASE WHEN page_id % 3 = 0 THEN url || '.pdf' ELSE url END AS link,
         {sql_visible_text(SQL_HTML)} AS snippet,
         list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1),
                        lambda a: CASE WHEN length(a) % 2 = 0 THEN a || '.pdf' ELSE a END) AS sitelinks
  FROM pages),
r1 AS (
  SELECT *, coalesce(CASE WHEN lower(link) LIKE '%.pdf' THEN link END,
                     list_filter(sitelinks, lambda s: lower(s) LIKE '%.pdf')[1], nullif(link, ''), 'Not Found') AS pdf_link
  FROM r0)
"""

_DATES = """
WITH o AS (
  SELECT o_orderkey, o_orderpriority AS pr, CAST(year(o_orderdate) AS VARCHAR) AS y,
         CAST(month(o_orderdate) AS VARCHAR) AS m, CAST(day(o_orderdate) AS VARCHAR) AS d,
         strftime(o_orderdate, '%B') AS mn
  FROM orders),
t AS (
  SELECT o_orderkey,
         CASE WHEN pr = '1-URGENT' THEN 'Updated ' || mn || ' ' || d || ', ' || y
              WHEN pr = '2-HIGH' THEN 'Effective ' || d || ' ' || lower(mn) || ' ' || y
              WHEN pr = '3-MEDIUM' THEN 'Date: ' || m || '/' || d || '/' || y
              WHEN pr = '4-NOT SPECIFIED' THEN 'Rev ' || y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0')
              ELSE 'due 13/40/' || y || ' and ' || m || '/' || d || '/' || y END AS text
  FROM o)
"""

_TRUSTED = " OR ".join(f"contains(lower(link), '{d}')" for d in TRUSTED_DOMAINS)
_IND = ", ".join(f"({p}, '{i}', '{n}')" for p, i, n in INDICATORS)
_CHANNEL = " ".join(f"WHEN contains(lower(trim(raw)), '{k}') THEN '{c}'" for k, c in CHANNEL_KEYWORDS)

SQL = {
    "date_extract": _DATES + f"SELECT o_orderkey, text, {_date_sql('text')} AS document_date FROM t",
    "title_plan": _RESULTS + f"SELECT page_id, title, {_title_sql('title')} AS plan_name FROM r1",
    "link_pick": _RESULTS + "SELECT page_id, link, pdf_link AS picked_link FROM r1",
    "plan_lookup": _RESULTS + f""",
r AS (
  SELECT *, ({_TRUSTED}) AS trusted, {_title_sql('title')} AS plan_name,
         {_date_sql("concat_ws(' ', title, snippet)")} AS doc_date
  FROM r1),
pick AS (
  SELECT query_id, arg_min((plan_name, pdf_link, doc_date), (NOT trusted, pos)) AS b
  FROM r WHERE plan_name <> 'Not Found' GROUP BY query_id),
ind AS (SELECT * FROM (VALUES {_IND}) v(priority, indicator, network)),
hits AS (
  SELECT r.query_id, r.pos, ind.priority, ind.network, r.pdf_link, r.doc_date
  FROM r JOIN ind ON contains(lower(concat_ws(' ', r.title, r.link, r.snippet)), lower(ind.indicator))),
net AS (SELECT query_id, arg_min((network, pdf_link, doc_date), (pos, priority)) AS n FROM hits GROUP BY query_id),
res AS (
  SELECT q.query_id, coalesce(pick.b[1], net.n[1], 'Not Found') AS plan_type,
         CASE WHEN pick.b IS NOT NULL THEN pick.b[2] ELSE coalesce(net.n[2], 'Not Found') END AS pdf_link,
         CASE WHEN pick.b IS NOT NULL THEN pick.b[3] ELSE coalesce(net.n[3], 'Not Found') END AS document_date
  FROM (SELECT DISTINCT query_id FROM r) q
  LEFT JOIN pick ON q.query_id = pick.query_id LEFT JOIN net ON q.query_id = net.query_id),
ver AS (
  SELECT DISTINCT r.query_id FROM r JOIN res ON r.query_id = res.query_id
  WHERE r.trusted AND res.plan_type <> 'Not Found' AND contains(lower(r.title), lower(res.plan_type)))
SELECT res.*, ver.query_id IS NOT NULL AS verified FROM res LEFT JOIN ver ON res.query_id = ver.query_id""",
    "channel_normalize": f"""
WITH c AS (
  SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment)
                         WHEN c_custkey % 4 = 1 THEN '  ' || c_mktsegment || ' dept'
                         WHEN c_custkey % 4 = 2 THEN '' ELSE c_mktsegment END AS raw
  FROM customer)
SELECT c_custkey, raw, CASE WHEN raw IS NULL OR trim(raw) = '' THEN '' {_CHANNEL} ELSE raw END AS channel FROM c""",
    "url_report": r"""
WITH u AS (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '.pdf'
                       WHEN page_id % 3 = 1 THEN regexp_replace(url, '[?#].*$', '') || '.xlsx'
                       ELSE url END AS url
  FROM pages),
n AS (SELECT *, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) AS file_name FROM u)
SELECT page_id, url,
       CASE WHEN contains(lower(url), '.pdf') THEN 'pdf' WHEN contains(lower(url), '.xls') THEN 'excel' END AS url_type,
       file_name, 'p' || CAST(page_id AS VARCHAR) || '_' || file_name AS prefixed_name,
       CASE WHEN starts_with(file_name, '1') THEN 'vol2_' || file_name ELSE file_name END AS renamed
FROM n""",
}

def _more_sql():
    from .extract_plans import SQL as XS
    from .keys_plans import _K
    sq = _K + """
SELECT seq, bpg, CASE WHEN is_valid THEN trim(concat_ws(' ', coalesce('BIN ' || bin, ''), coalesce('PCN ' || pcn, ''),
                                 coalesce('GroupID ' || grp, ''), 'filetype:pdf')) END AS query,
       CASE WHEN is_valid THEN 'ok' ELSE 'invalid_key' END AS status
FROM q"""
    pr = XS["parse_records"]
    cols = ", ".join(
        "page_no" if c == "page_no" else
        (f"coalesce({c}, '(NULL)') AS {c}" if c in ("document_name", "bin", "pcn", "grp", "plan_name")
         else f"'(NULL)' AS {c}") for c in CONFORM_COLUMNS)
    head, tail = pr.rsplit("SELECT document_name, page_no, CAST(i - 1", 1)
    conf = head + "SELECT " + cols + " FROM (SELECT document_name, page_no, CAST(i - 1" + tail + ")"
    return {"search_queries": sq, "conform_records": conf}


SQL.update(_more_sql())
