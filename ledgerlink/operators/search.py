"""Search-result operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dictionary import _quote, first_by_priority, substring_matches
from .sizes import small_side

# Plan-variant phrases, tried in this order (case-insensitive).
BENEFIT_PATTERNS = (
    r"(Standard|Premium|Basic|Enhanced|Plus|Select|Choice)\s*(Plan|Benefits?|Coverage)",
    r"(Tier\s*\d+)",
    r"(Low|High|Standard)\s*Deductible",
    r"(Commercial|Government|Federal|State)\s*(Plan|Benefits?)",
)
GROUP_PATTERNS = (
    r"(Employee|Employer|Union|Government|Federal|State|Municipal)\s*(Plan|Benefits?|Coverage)",
    r"(Active|Retired|Retiree)\s*(Members?|Benefits?)",
    r"(Group\s*\w+)",
)


def variant_phrase(text_col: str, patterns=BENEFIT_PATTERNS, pattern_col: str | None = None) -> Column:
    """B28 per result: the whole match of the first pattern (in order) found in
    the text, stripped.  ``pattern_col`` names a column holding one more,
    per-row pattern (tried last), e.g. the caller's id."""
    t = F.col(text_col)
    hits = [F.nullif(F.trim(F.regexp_extract(t, "(?i)" + p, 0)), F.lit("")) for p in patterns]
    if pattern_col is not None:
        hits.append(F.nullif(F.trim(F.expr(f"regexp_extract(`{text_col}`, `{pattern_col}`, 0)")), F.lit("")))
    return F.coalesce(*hits)


def id_pattern(id_col: str) -> Column:
    """'(?i)(<id>[A-Z]*\\d*)' with the id quoted (the reference inserts it raw)."""
    return F.concat(F.lit("(?i)("), _quote(F.col(id_col)), F.lit(r"[A-Z]*\d*)"))


def first_variant(results: DataFrame, query_col: str, pos_col: str, text_col: str,
                  patterns=BENEFIT_PATTERNS, id_col: str | None = None, out_col: str = "variant") -> DataFrame:
    """B28 per query: the first result (by position) with a variant phrase."""
    r = results
    if id_col is not None:
        r = r.withColumn("_sv_pat", id_pattern(id_col))
    r = r.withColumn("_sv_v", variant_phrase(text_col, patterns, "_sv_pat" if id_col else None))
    best = first_by_priority(r.where(F.col("_sv_v").isNotNull()), [query_col], [pos_col], ["_sv_v"])
    return (results.select(query_col).distinct().join(best, query_col, "left")
            .select(query_col, F.coalesce("_sv_v", F.lit("Not Found")).alias(out_col)))


def known_code_lookup(keys: DataFrame, key_col: str, codes: DataFrame, code_col: str = "code",
                      label_col: str = "label") -> DataFrame:
    """C12 exact: left join to a code table reduced to one label per code."""
    one = codes.groupBy(code_col).agg(F.min(label_col).alias(label_col))
    return keys.join(one.withColumnRenamed(code_col, key_col), key_col, "left")


def group_rule_lookup(keys: DataFrame, id_cols: list[str], group_col: str, rules: DataFrame) -> DataFrame:
    """C12 rules ``(priority, pattern, kind, label)``: kind 'exact' compares the
    upper-cased id, 'contains' looks for the pattern inside it; the first rule
    by priority wins; no rule -> null label."""
    up = keys.select(*id_cols, F.upper(F.col(group_col)).alias("_gr_id"))
    exact = (up.join(small_side(rules.where(F.col("kind") == "exact")
                                       .select("priority", F.upper("pattern").alias("_gr_id"), "label")), "_gr_id"))
    contains = substring_matches(up, rules.where(F.col("kind") == "contains"), list(id_cols), "_gr_id",
                                 "pattern", lower=False)
    hits = exact.select(*id_cols, "priority", "label").unionByName(contains.select(*id_cols, "priority", "label"))
    best = first_by_priority(hits, list(id_cols), ["priority"], ["label"])
    return keys.join(best, list(id_cols), "left")


def first_template_with_results(results: DataFrame, key_col: str, priority_col: str) -> DataFrame:
    """F8: per key, only the results of the first template (by priority) that returned any."""
    first = results.groupBy(key_col).agg(F.min(priority_col).alias(priority_col))
    return results.join(first, [key_col, priority_col])


def top_n_per_group(df: DataFrame, group_col: str, order_col: str, n: int) -> DataFrame:
    """At most ``n`` rows per group, lowest ``order_col`` first (result lists
    are bounded per query, so the window partition is too)."""
    w = Window.partitionBy(group_col).orderBy(F.col(order_col).asc())
    return df.withColumn("_tn", F.row_number().over(w)).where(F.col("_tn") <= n).drop("_tn")


def last_n(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The last ``n`` rows by ``order_col`` (a top-k: each task keeps n)."""
    return df.orderBy(F.col(order_col).desc()).limit(n)


def download_candidates(df: DataFrame, assignee: str, assigned_col: str = "assigned_to",
                        links_col: str = "pdf_links", comment_col: str = "comments") -> DataFrame:
    """Rows assigned to ``assignee`` with no link yet and a comment other
    than 'not found' (a null comment counts as other)."""
    no_link = F.col(links_col).isNull() | (F.trim(F.col(links_col)) == "")
    return df.where((F.col(assigned_col) == assignee) & no_link & ~F.col(comment_col).eqNullSafe("not found"))


def pages_of(docs: DataFrame, doc_col: str, pages_col: str) -> DataFrame:
    """I2 + B38: one row per non-empty page, page numbers from 1."""
    out = docs.select(doc_col, F.posexplode(pages_col).alias("_p", "text"))
    return out.select(doc_col, (F.col("_p") + 1).alias("page_no"), "text").where(F.trim("text") != "")
