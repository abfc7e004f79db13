"""Search-result plans (B28 C12 F8 G6) over pages, orders and customer.

plan_variants: per query (pages as results), the first benefit-variant and
  group-variant phrase by result position; the group id of a query is
  'q<query_id>'.  Each result's text is its title and snippet plus a phrase
  chosen by page_id mod 5.
known_codes: every order's key (BIN = padded customer key, GRP = 'G' ||
  order key) looked up in a code table derived from the customers and
  in an invented group-rule table.
top_links: per query, the results of the first template that returned any
  (template 1 = PDF links, 2 = the rest), at most 3 by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import format_bin
from ..operators import search as S
from .base import param_table, sql_pad6, sql_visible_text, table
from ..functions import lookup as LK
from ..operators.dictionary import first_by_priority, substring_matches
from ..operators.links import pick_document_link
from .lookup_plans import (_RESULTS, _TRUSTED, SQL_HTML, TRUSTED_DOMAINS, _date_sql, _title_sql, plan_name,
                           search_results)

# Invented phrase patterns of benefit and group variants, tried in this order.
BENEFIT_PATTERNS = (r"(Premium|Choice|Silver)\s*(Benefits?|Coverage)", r"(Tier\s*\d+)", r"(Low|High)\s*Deductible")
GROUP_PATTERNS = (r"(Union|Retiree|Staff)\s*Members?", r"(Group\s*\w+)")
PHRASES = ["Premium Benefits", "Tier ", "low deductible", "Retiree Members", "ref q"]
GROUP_RULES = [(1, "G7", "exact", "Seven"), (2, "G1", "contains", "One family"), (3, "99", "contains", "Nines")]


def _variant_texts(spark, sf_dir) -> DataFrame:
    r = search_results(spark, sf_dir)
    k = (F.col("page_id") % 5).cast("int")
    phrase = (F.when(k == 0, F.lit("Premium Benefits"))
              .when(k == 1, F.concat(F.lit("Tier "), (F.col("page_id") % 4).cast("string")))
              .when(k == 2, F.lit("low deductible"))
              .when(k == 3, F.lit("Retiree Members"))
              .otherwise(F.concat(F.lit("ref q"), F.col("query_id").cast("string"), F.lit("AB7"))))
    return r.select("query_id", "pos", F.concat(F.lit("q"), F.col("query_id").cast("string")).alias("group_id"),
                    F.concat_ws(" ", "title", "snippet", phrase).alias("text"))


def plan_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _variant_texts(spark, sf_dir)
    ben = S.first_variant(t, "query_id", "pos", "text", BENEFIT_PATTERNS, out_col="benefit_variant")
    grp = S.first_variant(t, "query_id", "pos", "text", GROUP_PATTERNS, id_col="group_id",
                          out_col="group_variant")
    return ben.join(grp, "query_id")


def known_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    keys = o.select(F.col("o_orderkey").alias("row_id"), format_bin("o_custkey").alias("bin"),
                    F.concat(F.lit("G"), F.col("o_orderkey").cast("string")).alias("grp"))
    c = table(spark, sf_dir, "customer")
    codes = c.select(format_bin("c_custkey").alias("code"),
                     F.concat(F.lit("Building nation "), F.col("c_nationkey").cast("string")).alias("label"))
    coded = S.known_code_lookup(keys, "bin", codes).withColumnRenamed("label", "code_label")
    rules = param_table(spark, GROUP_RULES, ["priority", "pattern", "kind", "label"])
    out = S.group_rule_lookup(coded, ["row_id"], "grp", rules)
    return out.select("row_id", "bin", "grp", "code_label", F.col("label").alias("group_label"))


def top_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = search_results(spark, sf_dir).select(
        "query_id", "pos", "link",
        F.when(F.lower("link").endswith(".pdf"), F.lit(1)).otherwise(F.lit(2)).alias("template_priority"))
    first = S.first_template_with_results(r, "query_id", "template_priority")
    return S.top_n_per_group(first, "query_id", "pos", 3)


# Invented parameter tables for bin_lookup: network indicators and the group
# rules of its fallback step.
BIN_INDICATORS = [(1, "example.com/fr", "French Com Network")]
BIN_GROUP_RULES = [(1, "Q1", "contains", "Q-one group"), (2, "Q2", "exact", "Q-two plan")]


def bin_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key (one per query: BIN, PCN on even queries, group id), the BIN
    network from the results (C13); when found, refined by the PCN benefit
    variant (' - v') and then the group variant (' (g)'), each appended only
    when found and different (D16).  Otherwise the known group rules (C12),
    then the trusted-first plan name (F6), else 'Not Found'."""
    nf = F.lit(LK.NOT_FOUND)
    r = search_results(spark, sf_dir)
    trusted = F.lit(False)
    for dom in TRUSTED_DOMAINS:
        trusted = trusted | F.lower("link").contains(dom)
    k = (F.col("page_id") % 5).cast("int")
    phrase = (F.when(k == 0, F.lit("Premium Benefits"))
              .when(k == 1, F.concat(F.lit("Tier "), (F.col("page_id") % 4).cast("string")))
              .when(k == 2, F.lit("low deductible"))
              .when(k == 3, F.lit("Retiree Members"))
              .otherwise(F.concat(F.lit("ref q"), F.col("query_id").cast("string"), F.lit("AB7"))))
    r = (r.withColumn("trusted", trusted)
         .withColumn("plan_name", plan_name(spark, "title"))
         .withColumn("pdf_link", F.coalesce(pick_document_link("link", "sitelinks"), nf))
         .withColumn("doc_date", LK.extract_date(F.concat_ws(" ", "title", "snippet")))
         .withColumn("group_id", F.concat(F.lit("q"), F.col("query_id").cast("string")))
         .withColumn("vtext", F.concat_ws(" ", "title", "snippet", phrase)))
    keys = r.select("query_id").distinct().select(
        "query_id", F.when(F.col("query_id") % 2 == 0, F.concat(F.lit("P"), F.col("query_id").cast("string")))
        .alias("pcn"), F.concat(F.lit("q"), F.col("query_id").cast("string")).alias("grp"))
    ind = param_table(spark, BIN_INDICATORS, ["priority", "indicator", "network"])
    hits = substring_matches(r.select("query_id", "pos", "pdf_link", "doc_date",
                                      F.concat_ws(" ", "title", "link", "snippet").alias("text")),
                             ind, ["query_id", "pos", "pdf_link", "doc_date"], "text", "indicator")
    net = first_by_priority(hits, ["query_id"], ["pos", "priority"], ["network", "pdf_link", "doc_date"]).select(
        "query_id", F.col("network").alias("n_plan"), F.col("pdf_link").alias("n_link"),
        F.col("doc_date").alias("n_date"))
    ben = S.first_variant(r, "query_id", "pos", "vtext", BENEFIT_PATTERNS, out_col="ben")
    gvar = S.first_variant(r, "query_id", "pos", "vtext", GROUP_PATTERNS, id_col="group_id", out_col="gv")
    named = r.where(F.col("plan_name") != LK.NOT_FOUND).withColumn("untrusted", ~F.col("trusted"))
    pick = first_by_priority(named, ["query_id"], ["untrusted", "pos"], ["plan_name", "pdf_link", "doc_date"]).select(
        "query_id", F.col("plan_name").alias("p_plan"), F.col("pdf_link").alias("p_link"),
        F.col("doc_date").alias("p_date"))
    rules = param_table(spark, BIN_GROUP_RULES, ["priority", "pattern", "kind", "label"])
    grules = S.group_rule_lookup(keys.select("query_id", "grp"), ["query_id"], "grp", rules).select("query_id", "label")
    j = (keys.join(net, "query_id", "left").join(ben, "query_id", "left").join(gvar, "query_id", "left")
         .join(pick, "query_id", "left").join(grules, "query_id", "left"))
    found = lambda c: F.col(c).isNotNull() & (F.col(c) != LK.NOT_FOUND)
    step1 = F.when(F.col("pcn").isNotNull() & found("ben") & (F.col("ben") != F.col("n_plan")),
                   F.concat(F.col("n_plan"), F.lit(" - "), F.col("ben"))).otherwise(F.col("n_plan"))
    j = j.withColumn("step1", step1)
    step2 = F.when(F.col("grp").isNotNull() & found("gv") & (F.col("gv") != F.col("step1")),
                   F.concat(F.col("step1"), F.lit(" ("), F.col("gv"), F.lit(")"))).otherwise(F.col("step1"))
    has_net, has_rule, has_pick = F.col("n_plan").isNotNull(), F.col("label").isNotNull(), F.col("p_plan").isNotNull()
    return j.select(
        "query_id",
        F.when(has_net, step2).when(has_rule, F.col("label")).when(has_pick, F.col("p_plan")).otherwise(nf)
        .alias("plan_type"),
        F.when(has_net, F.col("n_link")).when(has_rule, nf).when(has_pick, F.col("p_link")).otherwise(nf)
        .alias("pdf_link"),
        F.when(has_net, F.col("n_date")).when(has_rule, nf).when(has_pick, F.col("p_date")).otherwise(nf)
        .alias("document_date"))


QUERIES = {"plan_variants": plan_variants, "known_codes": known_codes, "top_links": top_links,
           "bin_lookup": bin_lookup}


def _first_pattern_sql(text: str, patterns, extra: str | None = None) -> str:
    hits = [f"nullif(trim(regexp_extract({text}, '(?i){p}', 0)), '')" for p in patterns]
    if extra:
        hits.append(f"nullif(trim(regexp_extract({text}, {extra}, 0)), '')")
    return "coalesce(" + ", ".join(hits) + ")"


_RES = f"""
WITH r AS (
  SELECT CAST(page_id // 10 AS BIGINT) AS query_id, CAST(page_id % 10 + 1 AS INTEGER) AS pos,
         'q' || CAST(page_id // 10 AS VARCHAR) AS group_id,
         concat_ws(' ',
           trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '[^A-Za-z ]', ' ', 'g'))
             || [' Formulary', ' Preferred Drug List', ' PDL 2024', ' Download Formulary', ' Medicaid', ''][page_id % 6 + 1],
           {sql_visible_text(SQL_HTML)},
           CASE page_id % 5 WHEN 0 THEN 'Premium Benefits' WHEN 1 THEN 'Tier ' || CAST(page_id % 4 AS VARCHAR)
                            WHEN 2 THEN 'low deductible' WHEN 3 THEN 'Retiree Members'
                            ELSE 'ref q' || CAST(page_id // 10 AS VARCHAR) || 'AB7' END) AS text,
         CASE WHEN page_id % 3 = 0 THEN url || '.pdf' ELSE url END AS link
  FROM pages)
"""

_RULES = ", ".join(f"({p}, '{pat}', '{k}', '{lab}')" for p, pat, k, lab in GROUP_RULES)

SQL = {
    "plan_variants": _RES + f""",
v AS (
  SELECT query_id, pos, {_first_pattern_sql('text', BENEFIT_PATTERNS)} AS bv,
         {_first_pattern_sql('text', GROUP_PATTERNS, "'(?i)(' || group_id || '[A-Z]*\\d*)'")} AS gv
  FROM r)
SELECT q.query_id,
       coalesce((SELECT arg_min(bv, pos) FROM v WHERE v.query_id = q.query_id AND bv IS NOT NULL), 'Not Found') AS benefit_variant,
       coalesce((SELECT arg_min(gv, pos) FROM v WHERE v.query_id = q.query_id AND gv IS NOT NULL), 'Not Found') AS group_variant
FROM (SELECT DISTINCT query_id FROM r) q""",
    "known_codes": f"""
WITH k AS (
  SELECT o_orderkey AS row_id, {sql_pad6('o_custkey')} AS bin, 'G' || CAST(o_orderkey AS VARCHAR) AS grp FROM orders),
codes AS (
  SELECT {sql_pad6('c_custkey')} AS code, min('Building nation ' || CAST(c_nationkey AS VARCHAR)) AS label
  FROM customer GROUP BY 1),
rules AS (SELECT * FROM (VALUES {_RULES}) v(priority, pattern, kind, label)),
hits AS (
  SELECT k.row_id, rules.priority, rules.label FROM k JOIN rules
    ON (rules.kind = 'exact' AND upper(k.grp) = upper(rules.pattern))
    OR (rules.kind = 'contains' AND contains(upper(k.grp), rules.pattern))),
best AS (SELECT row_id, arg_min(label, priority) AS label FROM hits GROUP BY row_id)
SELECT k.row_id, k.bin, k.grp, codes.label AS code_label, best.label AS group_label
FROM k LEFT JOIN codes ON k.bin = codes.code LEFT JOIN best ON k.row_id = best.row_id""",
    "top_links": _RES + """,
t AS (SELECT query_id, pos, link, CASE WHEN lower(link) LIKE '%.pdf' THEN 1 ELSE 2 END AS template_priority FROM r),
f AS (SELECT t.* FROM t JOIN (SELECT query_id, min(template_priority) AS mp FROM t GROUP BY 1) m
      ON t.query_id = m.query_id AND t.template_priority = m.mp)
SELECT query_id, pos, link, template_priority FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos) AS rn FROM f) WHERE rn <= 3""",
}

_BIN_RULES = ", ".join(f"({p}, '{pat}', '{k}', '{lab}')" for p, pat, k, lab in BIN_GROUP_RULES)
_BIN_IND = ", ".join(f"({p}, '{i}', '{n}')" for p, i, n in BIN_INDICATORS)

SQL["bin_lookup"] = _RESULTS + f""",
r AS (
  SELECT *, ({_TRUSTED}) AS trusted, {_title_sql('title')} AS plan_name,
         {_date_sql("concat_ws(' ', title, snippet)")} AS doc_date,
         'q' || CAST(query_id AS VARCHAR) AS group_id,
         concat_ws(' ', title, snippet,
           CASE page_id % 5 WHEN 0 THEN 'Premium Benefits' WHEN 1 THEN 'Tier ' || CAST(page_id % 4 AS VARCHAR)
                            WHEN 2 THEN 'low deductible' WHEN 3 THEN 'Retiree Members'
                            ELSE 'ref q' || CAST(page_id // 10 AS VARCHAR) || 'AB7' END) AS vtext
  FROM r1),
keys AS (
  SELECT DISTINCT query_id, CASE WHEN query_id % 2 = 0 THEN 'P' || CAST(query_id AS VARCHAR) END AS pcn,
         'q' || CAST(query_id AS VARCHAR) AS grp
  FROM r),
ind AS (SELECT * FROM (VALUES {_BIN_IND}) v(priority, indicator, network)),
hits AS (
  SELECT r.query_id, r.pos, ind.priority, ind.network, r.pdf_link, r.doc_date
  FROM r JOIN ind ON contains(lower(concat_ws(' ', r.title, r.link, r.snippet)), lower(ind.indicator))),
net AS (SELECT query_id, arg_min((network, pdf_link, doc_date), (pos, priority)) AS n FROM hits GROUP BY query_id),
v AS (
  SELECT query_id, pos, {_first_pattern_sql('vtext', BENEFIT_PATTERNS)} AS bv,
         {_first_pattern_sql('vtext', GROUP_PATTERNS, "'(?i)(' || group_id || '[A-Z]*\\d*)'")} AS gv
  FROM r),
ben AS (SELECT query_id, arg_min(bv, pos) AS ben FROM v WHERE bv IS NOT NULL GROUP BY query_id),
gvs AS (SELECT query_id, arg_min(gv, pos) AS gv FROM v WHERE gv IS NOT NULL GROUP BY query_id),
pick AS (
  SELECT query_id, arg_min((plan_name, pdf_link, doc_date), (NOT trusted, pos)) AS p
  FROM r WHERE plan_name <> 'Not Found' GROUP BY query_id),
rules AS (SELECT * FROM (VALUES {_BIN_RULES}) v(priority, pattern, kind, label)),
gr AS (
  SELECT keys.query_id, arg_min(rules.label, rules.priority) AS label FROM keys JOIN rules
    ON (rules.kind = 'exact' AND upper(keys.grp) = upper(rules.pattern))
    OR (rules.kind = 'contains' AND contains(upper(keys.grp), rules.pattern))
  GROUP BY keys.query_id),
j AS (
  SELECT keys.*, net.n, ben.ben, gvs.gv, pick.p, gr.label FROM keys
  LEFT JOIN net ON keys.query_id = net.query_id LEFT JOIN ben ON keys.query_id = ben.query_id
  LEFT JOIN gvs ON keys.query_id = gvs.query_id LEFT JOIN pick ON keys.query_id = pick.query_id
  LEFT JOIN gr ON keys.query_id = gr.query_id),
s1 AS (
  SELECT *, CASE WHEN n IS NOT NULL AND pcn IS NOT NULL AND ben IS NOT NULL AND ben <> n[1]
                 THEN n[1] || ' - ' || ben ELSE n[1] END AS step1
  FROM j),
s2 AS (
  SELECT *, CASE WHEN step1 IS NOT NULL AND grp IS NOT NULL AND gv IS NOT NULL AND gv <> step1
                 THEN step1 || ' (' || gv || ')' ELSE step1 END AS step2
  FROM s1)
SELECT query_id,
       CASE WHEN n IS NOT NULL THEN step2 WHEN label IS NOT NULL THEN label
            WHEN p IS NOT NULL THEN p[1] ELSE 'Not Found' END AS plan_type,
       CASE WHEN n IS NOT NULL THEN n[2] WHEN label IS NOT NULL THEN 'Not Found'
            WHEN p IS NOT NULL THEN p[2] ELSE 'Not Found' END AS pdf_link,
       CASE WHEN n IS NOT NULL THEN n[3] WHEN label IS NOT NULL THEN 'Not Found'
            WHEN p IS NOT NULL THEN p[3] ELSE 'Not Found' END AS document_date
FROM s2"""
