"""The staged plan lookup (L8: B18 F8 C12 C13 B28 F6 B26 B29 C14) over keys and searches derived from ``pages``.

A key is a query of ten pages: BIN (none on every eighth), PCN (even ones) and group id.  ``searches`` lists each page as
a result of some query texts: by key mod 6 under a BIN text, a PCN text or the text of any part, and under texts that name
a network or the page's own plan.  Stages:

1. ``bin``: the network of the first BIN template whose results show an indicator (C13, F8);
2. ``known_bin``: a table of known BINs;
3. ``known_group``: group rules (C12);
4. ``pcn``: the trusted-first pick (F6) of the first PCN template that has one;
5. ``any``: the pick of the text made of all parts there are.

Networks of the first two stages are refined by searches that name them: ' - variant' from the first PCN template with a
benefit variant, then ' (variant)' from the first group template with a group variant, each only where it differs (D16).
A plan is verified if a trusted result of a search for it has it in its title (C14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lookup as LK
from ..operators import search as S
from ..operators.dictionary import first_by_priority, substring_matches
from ..operators.ladder import climb
from ..operators.links import pick_document_link
from ..operators.templates import issue
from ..session import cut_lineage
from .base import param_table
from .dictionary_plans import INDICATORS
from .lookup_plans import _RESULTS, _TRUSTED, TRUSTED_DOMAINS, _date_sql, _title_sql, plan_name, search_results
from .search_plans import BENEFIT_PATTERNS, GROUP_PATTERNS, _first_pattern_sql

# Invented parameters: (priority, template, needs).
BIN_TEMPLATES = [(1, "BIN {bin} pharmacy network database", 0), (2, "BIN {bin} benefit manager", 0), (3, '"{bin}" pharmacy benefits network', 0)]
PCN_REFINERS = [(1, '"{plan}" PCN {pcn} benefit design', 0), (2, 'PCN {pcn} "{plan}" formulary', 0)]
GROUP_REFINERS = [(1, '"{plan}" Group {grp} coverage', 0), (2, 'Group {grp} employer plan "{plan}"', 0)]
PCN_TEMPLATES = [(1, "PCN {pcn} pharmacy formulary", 0), (2, "PCN {pcn} prescription benefits", 0)]
ANY_TEMPLATES = [(1, "[BIN {bin} ][PCN {pcn} ][Group {grp} ]pharmacy benefits", 1)]
CHECK_TEMPLATES = [(1, '"{plan}" pharmacy formulary official', 0)]
KNOWN_BINS = [("000002", "Second Network"), ("000008", "Eighth Network"), ("000020", "Twentieth Network")]
GROUP_RULES = [(1, "Q3", "exact", "Q-three plan"), (2, "Q9", "contains", "Nines group")]
#: Fixed value: the link of a known BIN.
KNOWN_LINK = "Known Pattern - Search Needed"
ANSWER = ["plan_type", "pdf_link", "document_date"]


def _templates(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return param_table(spark, rows, ["priority", "template", "needs"])


def ladder_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = search_results(spark, sf_dir).select("query_id").distinct()
    return q.select("query_id", *_key_parts("query_id"))


def _key_parts(query_id: str) -> list[Column]:
    q = F.col(query_id)
    text = q.cast("string")
    return [F.when(q % 8 != 7, F.lpad(text, 6, "0")).alias("bin"), F.when(q % 2 == 0, F.concat(F.lit("P"), text)).alias("pcn"),
            F.concat(F.lit("q"), text).alias("grp")]


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query (text), pos, title, link, snippet, pdf_link, doc_date, plan_name, trusted: one row per text and result."""
    r = search_results(spark, sf_dir).select("*", *_key_parts("query_id"))
    phrase = F.element_at(F.array(*[F.lit(x) for x in ("Premium Benefits", "Tier 2", "low deductible", "Retiree Members", "")]), (F.col("page_id") % 5 + 1).cast("int"))
    trusted = F.lit(False)
    for domain in TRUSTED_DOMAINS:
        trusted = trusted | F.lower("link").contains(domain)
    r = r.withColumns({
        "snippet": F.concat_ws(" ", "snippet", phrase), "trusted": trusted, "plan_name": plan_name(spark, "title"),
        "pdf_link": F.coalesce(pick_document_link("link", "sitelinks"), F.lit(LK.NOT_FOUND)),
        "doc_date": LK.extract_date(F.concat_ws(" ", "title", "snippet"))})
    m, early = F.col("query_id") % 6, F.col("pos") <= 5
    texts = [F.when(m == 0, F.concat(F.lit("BIN "), "bin", F.lit(" pharmacy network database"))),
             F.when(m == 1, F.concat(F.lit('"'), "bin", F.lit('" pharmacy benefits network'))),
             F.when(m == 4, F.concat(F.lit("PCN "), "pcn", F.lit(" prescription benefits"))),
             F.when(m == 5, F.concat(F.coalesce(F.concat(F.lit("BIN "), "bin", F.lit(" ")), F.lit("")), F.lit("Group "), "grp", F.lit(" pharmacy benefits"))),
             F.when(F.col("plan_name") != LK.NOT_FOUND, F.concat(F.lit('"'), "plan_name", F.lit('" pharmacy formulary official')))]
    for name in _networks():
        texts += [F.when(early, F.concat(F.lit(f'"{name}" PCN '), "pcn", F.lit(" benefit design"))),
                  F.when(~early, F.concat(F.lit("Group "), "grp", F.lit(f' employer plan "{name}"'))),
                  F.when(~early, F.concat(F.lit(f'"{name} - Tier 2" Group '), "grp", F.lit(" coverage")))]
    # each page is read and parsed once, for all searches that list it
    shown = ["pos", "title", "link", "snippet", "pdf_link", "doc_date", "plan_name", "trusted"]
    r = cut_lineage(r.select(F.array_compact(F.array(*texts)).alias("queries"), *shown))
    made = r.withColumn("query", F.explode_outer("queries")).where(F.col("query").isNotNull())
    return made.select("query", *shown)


def _networks() -> list[str]:
    return [n for _, _, n in INDICATORS] + [n for _, n in KNOWN_BINS]


def found_by(keys: DataFrame, fields: dict, templates: DataFrame, results: DataFrame) -> DataFrame:
    """The results of the keys' queries: an equi-join on the query's text."""
    return issue(keys, fields, templates).join(results, "query")


def networks_of(hits: DataFrame, indicators: DataFrame) -> DataFrame:
    """Per key the network of the first template that shows one, in its first such result."""
    line = ["query_id", "priority", "pos", "pdf_link", "doc_date"]
    text = hits.select(*line, F.concat_ws(" ", "title", "link", "snippet").alias("text"))
    found = substring_matches(text, indicators.withColumnRenamed("priority", "place"), line, "text", "indicator")
    best = first_by_priority(found, ["query_id"], ["priority", "pos", "place"], ["network", "pdf_link", "doc_date"])
    return best.select("query_id", F.col("network").alias("plan_type"), "pdf_link", F.col("doc_date").alias("document_date"))


def picks_of(hits: DataFrame) -> DataFrame:
    """Per key the plan name of the first template that has one, trusted results first."""
    named = hits.where(F.col("plan_name") != LK.NOT_FOUND).withColumn("untrusted", ~F.col("trusted"))
    best = first_by_priority(named, ["query_id"], ["priority", "untrusted", "pos"], ["plan_name", "pdf_link", "doc_date"])
    return best.select("query_id", F.col("plan_name").alias("plan_type"), "pdf_link", F.col("doc_date").alias("document_date"))


def with_variant(found: DataFrame, fields: dict, templates: DataFrame, results: DataFrame, patterns, before: str, after: str, id_col: str | None = None) -> DataFrame:
    """``plan_type`` with the variant of the first template and result that has one, where it differs."""
    hits = found_by(found, fields, templates, results).withColumn("text", F.concat_ws(" ", "title", "snippet"))
    if id_col:
        hits = hits.withColumn("own", S.id_pattern(id_col))
    hits = hits.withColumn("variant", S.variant_phrase("text", patterns, "own" if id_col else None)).where(F.col("variant").isNotNull())
    best = first_by_priority(hits, ["query_id"], ["priority", "pos"], ["variant"])
    more = F.when(F.col("variant") != F.col("plan_type"), F.concat("plan_type", F.lit(before), "variant", F.lit(after)))
    return found.join(best, "query_id", "left").withColumn("plan_type", F.coalesce(more, "plan_type")).drop("variant")


def plan_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = searches(spark, sf_dir)
    keys = ladder_keys(spark, sf_dir)
    own = {"bin": "bin", "pcn": "pcn", "grp": "grp"}
    named = own | {"plan": "plan_type"}
    indicators = param_table(spark, INDICATORS, ["priority", "indicator", "network"])
    rules = param_table(spark, GROUP_RULES, ["priority", "pattern", "kind", "label"])
    known = param_table(spark, KNOWN_BINS, ["code", "label"])
    nothing = F.lit(LK.NOT_FOUND)

    def refined(found: DataFrame) -> DataFrame:
        out = found.join(keys, "query_id")
        out = with_variant(out, named, _templates(spark, PCN_REFINERS), results, BENEFIT_PATTERNS, " - ", "")
        return with_variant(out, named, _templates(spark, GROUP_REFINERS), results, GROUP_PATTERNS, " (", ")", "grp")

    def by_bin(open_: DataFrame) -> DataFrame:
        return refined(networks_of(found_by(open_, own, _templates(spark, BIN_TEMPLATES), results), indicators))

    def by_known_bin(open_: DataFrame) -> DataFrame:
        hit = S.known_code_lookup(open_, "bin", known).where(F.col("label").isNotNull())
        return refined(hit.select("query_id", F.col("label").alias("plan_type"), F.lit(KNOWN_LINK).alias("pdf_link"), nothing.alias("document_date")))

    def by_group(open_: DataFrame) -> DataFrame:
        hit = S.group_rule_lookup(open_, ["query_id"], "grp", rules).where(F.col("label").isNotNull())
        return hit.select("query_id", F.col("label").alias("plan_type"), nothing.alias("pdf_link"), nothing.alias("document_date"))

    def by_pcn(open_: DataFrame) -> DataFrame:
        return picks_of(found_by(open_, own, _templates(spark, PCN_TEMPLATES), results))

    def by_any(open_: DataFrame) -> DataFrame:
        return picks_of(found_by(open_, own, _templates(spark, ANY_TEMPLATES), results))

    stages = [("bin", by_bin), ("known_bin", by_known_bin), ("known_group", by_group), ("pcn", by_pcn), ("any", by_any)]
    out = climb(keys, "query_id", stages, ANSWER)
    checks = found_by(out.select("query_id", "plan_type"), {"plan": "plan_type"}, _templates(spark, CHECK_TEMPLATES), results)
    confirmed = checks.groupBy("query_id").agg(F.bool_or(F.col("trusted") & F.lower("title").contains(F.lower("plan_type"))).alias("verified"))
    return out.join(confirmed, "query_id", "left").select(
        "query_id", "bin", "pcn", "grp", "stage_no", "stage", *[F.coalesce(c, nothing).alias(c) for c in ANSWER], F.coalesce("verified", F.lit(False)).alias("verified"))


def issued_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query that the templates of the first and the last stages make of a key, by stage and priority."""
    keys = ladder_keys(spark, sf_dir)
    own = {"bin": "bin", "pcn": "pcn", "grp": "grp"}
    out = None
    for stage, rows in (("bin", BIN_TEMPLATES), ("pcn", PCN_TEMPLATES), ("any", ANY_TEMPLATES)):
        part = issue(keys, own, _templates(spark, rows)).select("query_id", F.lit(stage).alias("stage"), "priority", "query")
        out = part if out is None else out.unionByName(part)
    return out


def first_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: per key and stage the first template whose search yields results, how many, and the first three links."""
    results = searches(spark, sf_dir).select("query", "pos", "link")
    hits = issued_queries(spark, sf_dir).join(results, "query")
    per = hits.groupBy("query_id", "stage", "priority").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("pos", "link"))), 1, 3).alias("top"))
    best = first_by_priority(per, ["query_id", "stage"], ["priority"], ["priority", "n", "top"])
    return best.select("query_id", "stage", "priority", F.col("n").alias("n_results"), F.array_join(F.transform("top", lambda x: x["link"]), " ").alias("top_links"))


QUERIES = {"plan_ladder": plan_ladder, "issued_queries": issued_queries, "first_yield": first_yield}

# ---------------------------------------------------------------- oracle SQL


def _filled_sql(template: str) -> str:
    """SQL text of a template of this module: required parts are null where missing, bracketed ones fall away."""
    import re

    out = []
    for part in re.findall(r"\[[^\]]*\]|[^\[]+", template):
        inner = part.strip("[]") if part[0] == "[" else part
        pieces = [f"nullif({x[1:-1]}, '')" if x[0] == "{" else "'" + x.replace("'", "''") + "'" for x in re.findall(r"\{\w+\}|[^{]+", inner)]
        text = "(" + " || ".join(pieces) + ")"
        out.append(f"coalesce({text}, '')" if part[0] == "[" else text)
    return " || ".join(out)


def _issue_sql(source: str, rows: list[tuple], columns: str) -> str:
    """The filled queries of a relation; the templates here that need a part always have the group id."""
    return " UNION ALL ".join(f"SELECT {columns}, {p} AS priority, {_filled_sql(t)} AS query FROM {source}" for p, t, _ in rows)


_NAMES = "[" + ", ".join(f"'{n}'" for n in _networks()) + "]"
_LADDER = _RESULTS + f""",
keys AS (
  SELECT DISTINCT query_id, CASE WHEN query_id % 8 <> 7 THEN lpad(CAST(query_id AS VARCHAR), 6, '0') END AS bin,
         CASE WHEN query_id % 2 = 0 THEN 'P' || CAST(query_id AS VARCHAR) END AS pcn, 'q' || CAST(query_id AS VARCHAR) AS grp
  FROM r1),
r2 AS (
  SELECT r1.* EXCLUDE (snippet), concat_ws(' ', snippet, ['Premium Benefits', 'Tier 2', 'low deductible', 'Retiree Members', ''][page_id % 5 + 1]) AS snippet,
         keys.bin, keys.pcn, keys.grp, ({_TRUSTED}) AS trusted, {_title_sql('title')} AS plan_name
  FROM r1 JOIN keys USING (query_id)),
r AS (SELECT *, {_date_sql("concat_ws(' ', title, snippet)")} AS doc_date FROM r2),
t AS (
  SELECT *, unnest(list_filter([
      CASE WHEN query_id % 6 = 0 THEN 'BIN ' || bin || ' pharmacy network database' END,
      CASE WHEN query_id % 6 = 1 THEN '"' || bin || '" pharmacy benefits network' END,
      CASE WHEN query_id % 6 = 4 THEN 'PCN ' || pcn || ' prescription benefits' END,
      CASE WHEN query_id % 6 = 5 THEN coalesce('BIN ' || bin || ' ', '') || 'Group ' || grp || ' pharmacy benefits' END,
      CASE WHEN plan_name <> 'Not Found' THEN '"' || plan_name || '" pharmacy formulary official' END]
    || list_transform({_NAMES}, lambda n: CASE WHEN pos <= 5 THEN '"' || n || '" PCN ' || pcn || ' benefit design' END)
    || list_transform({_NAMES}, lambda n: CASE WHEN pos > 5 THEN 'Group ' || grp || ' employer plan "' || n || '"' END)
    || list_transform({_NAMES}, lambda n: CASE WHEN pos > 5 THEN '"' || n || ' - Tier 2" Group ' || grp || ' coverage' END),
    lambda x: x IS NOT NULL)) AS query
  FROM r),
s AS (SELECT query, pos, title, link, snippet, pdf_link, doc_date, plan_name, trusted FROM t)
"""
_IND = ", ".join(f"({p}, '{i}', '{n}')" for p, i, n in INDICATORS)
_RULES = ", ".join(f"({p}, '{pat}', '{k}', '{lab}')" for p, pat, k, lab in GROUP_RULES)
_KNOWN = ", ".join(f"('{c}', '{n}')" for c, n in KNOWN_BINS)
_KEY = "query_id, bin, pcn, grp"


def _refine_sql(source: str, out: str) -> str:
    variant = lambda q, pats, extra: _first_pattern_sql("concat_ws(' ', s.title, s.snippet)", pats, extra)
    own = "'(?i)(' || grp || '[A-Z]*\\d*)'"
    return f"""
{out}_b AS (
  SELECT query_id, arg_min(v, (priority, pos)) AS v FROM (
    SELECT i.query_id, i.priority, s.pos, {variant('i', BENEFIT_PATTERNS, None)} AS v
    FROM ({_issue_sql(f'(SELECT *, plan_type AS plan FROM {source})', PCN_REFINERS, 'query_id')}) i JOIN s USING (query))
  WHERE v IS NOT NULL GROUP BY query_id),
{out}_1 AS (
  SELECT x.* EXCLUDE (plan_type), CASE WHEN v IS NOT NULL AND v <> plan_type THEN plan_type || ' - ' || v ELSE plan_type END AS plan_type
  FROM {source} x LEFT JOIN {out}_b USING (query_id)),
{out}_g AS (
  SELECT query_id, arg_min(v, (priority, pos)) AS v FROM (
    SELECT i.query_id, i.priority, s.pos, {variant('i', GROUP_PATTERNS, own)} AS v
    FROM ({_issue_sql(f'(SELECT *, plan_type AS plan FROM {out}_1)', GROUP_REFINERS, 'query_id, grp')}) i JOIN s USING (query))
  WHERE v IS NOT NULL GROUP BY query_id),
{out} AS (
  SELECT query_id, CASE WHEN v IS NOT NULL AND v <> plan_type THEN plan_type || ' (' || v || ')' ELSE plan_type END AS plan_type,
         pdf_link, document_date
  FROM {out}_1 LEFT JOIN {out}_g USING (query_id))"""


def _pick_sql(source: str, rows: list[tuple]) -> str:
    return f"""
  SELECT query_id, b[1] AS plan_type, b[2] AS pdf_link, b[3] AS document_date FROM (
    SELECT i.query_id, arg_min((s.plan_name, s.pdf_link, s.doc_date), (i.priority, NOT s.trusted, s.pos)) AS b
    FROM ({_issue_sql(source, rows, 'query_id')}) i JOIN s USING (query) WHERE s.plan_name <> 'Not Found' GROUP BY i.query_id)"""


SQL = {
    "plan_ladder": _LADDER + f""",
ind AS (SELECT * FROM (VALUES {_IND}) v(place, indicator, network)),
net AS (
  SELECT query_id, b[1] AS plan_type, b[2] AS pdf_link, b[3] AS document_date FROM (
    SELECT i.query_id, arg_min((ind.network, s.pdf_link, s.doc_date), (i.priority, s.pos, ind.place)) AS b
    FROM ({_issue_sql('keys', BIN_TEMPLATES, 'query_id')}) i JOIN s USING (query)
    JOIN ind ON contains(lower(concat_ws(' ', s.title, s.link, s.snippet)), lower(ind.indicator)) GROUP BY i.query_id)),
a1k AS (SELECT * FROM net JOIN keys USING (query_id)),
{_refine_sql('a1k', 'a1')},
a2k AS (
  SELECT keys.*, k.label AS plan_type, '{KNOWN_LINK}' AS pdf_link, 'Not Found' AS document_date
  FROM keys JOIN (VALUES {_KNOWN}) k(code, label) ON keys.bin = k.code ANTI JOIN a1 USING (query_id)),
{_refine_sql('a2k', 'a2')},
rules AS (SELECT * FROM (VALUES {_RULES}) v(priority, pattern, kind, label)),
a3 AS (
  SELECT o.query_id, arg_min(rules.label, rules.priority) AS plan_type, 'Not Found' AS pdf_link, 'Not Found' AS document_date
  FROM (SELECT * FROM keys ANTI JOIN a1 USING (query_id) ANTI JOIN a2 USING (query_id)) o JOIN rules
    ON (rules.kind = 'exact' AND upper(o.grp) = upper(rules.pattern)) OR (rules.kind = 'contains' AND contains(upper(o.grp), rules.pattern))
  GROUP BY o.query_id),
o4 AS (SELECT * FROM keys ANTI JOIN a1 USING (query_id) ANTI JOIN a2 USING (query_id) ANTI JOIN a3 USING (query_id)),
a4 AS ({_pick_sql('o4', PCN_TEMPLATES)}),
o5 AS (SELECT * FROM o4 ANTI JOIN a4 USING (query_id)),
a5 AS ({_pick_sql('o5', ANY_TEMPLATES)}),
every AS (
  SELECT *, 1 AS stage_no, 'bin' AS stage FROM a1 UNION ALL BY NAME SELECT *, 2 AS stage_no, 'known_bin' AS stage FROM a2
  UNION ALL BY NAME SELECT *, 3 AS stage_no, 'known_group' AS stage FROM a3 UNION ALL BY NAME SELECT *, 4 AS stage_no, 'pcn' AS stage FROM a4
  UNION ALL BY NAME SELECT *, 5 AS stage_no, 'any' AS stage FROM a5),
ver AS (
  SELECT DISTINCT e.query_id FROM every e JOIN s ON s.query = '"' || e.plan_type || '" pharmacy formulary official'
  WHERE s.trusted AND contains(lower(s.title), lower(e.plan_type)))
SELECT {_KEY}, coalesce(stage_no, 0) AS stage_no, coalesce(stage, 'none') AS stage, coalesce(plan_type, 'Not Found') AS plan_type,
       coalesce(pdf_link, 'Not Found') AS pdf_link, coalesce(document_date, 'Not Found') AS document_date, ver.query_id IS NOT NULL AS verified
FROM keys LEFT JOIN every USING (query_id) LEFT JOIN ver USING (query_id)""",
}
_ISSUED = ",\nissued AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({_issue_sql('keys', rows, f'''query_id, '{stage}' AS stage''')}) WHERE query IS NOT NULL"
    for stage, rows in (("bin", BIN_TEMPLATES), ("pcn", PCN_TEMPLATES), ("any", ANY_TEMPLATES))) + ")"
SQL["issued_queries"] = _LADDER + _ISSUED + "\nSELECT query_id, stage, priority, query FROM issued"
SQL["first_yield"] = _LADDER + _ISSUED + """,
per AS (
  SELECT query_id, stage, priority, count(*) AS n_results, array_to_string(list_slice(list(link ORDER BY pos, link), 1, 3), ' ') AS top_links
  FROM issued JOIN s USING (query) GROUP BY ALL)
SELECT * FROM per QUALIFY row_number() OVER (PARTITION BY query_id, stage ORDER BY priority) = 1"""
