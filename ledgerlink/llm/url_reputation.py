"""Empirical-Bayes host reputation for URL filters (operator 2).

Labelled pages are good or bad.  A host's share of good pages is shrunk to that of its registered domain, the domain's
to its suffix and the suffix's to that of all pages, each through a beta prior around the level above.  How strongly a
level shrinks is estimated from the data: the beta-binomial's intra-class correlation by moments, weighted by pages.
A host is blocked where the upper bound of its posterior share, mean plus Z standard deviations, is below GOOD.
Rules of the caller come first, the longest that fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import keep, read

GOOD, Z = 0.8, 1.645
#: host, path, verdict
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(rest) + 4)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], column: int | None = None) -> Column:
    """The longest rule that fits, as written or (column 2) its verdict; null where none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later ones are asked first
        h, p, verdict = rule
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p if column is None else verdict)).otherwise(out)
    return out


def _strength(level: DataFrame) -> float:
    """How many pages the prior of a level weighs, from rows of n, good and the mean above (m)."""
    v = F.col("m") * (1 - F.col("m"))
    p = F.col("good") / F.col("n")
    s = level.where("n > 0").agg(F.sum(F.col("n") * (p - F.col("m")) ** 2 / v).alias("s"), F.sum("n").alias("w"), F.sum(F.col("n") * F.col("n")).alias("w2"), F.count("*").alias("k")).first()
    if not s["k"] or s["k"] < 2:
        return 1.0
    room = s["w"] - s["w2"] / s["w"] - (s["k"] - 1)
    rho = (s["s"] - (s["k"] - 1)) / room if room > 0 else 0.0
    rho = min(max(rho, 0.001), 0.999)
    return 1 / rho - 1


def suffix_of(host: Column, known: Sequence[str]) -> Column:
    """The longest of the known suffixes (such as ``co.uk``) that the host ends with, else its last label."""
    out = F.substring_index(host, ".", -1)
    for s in sorted(known, key=len):  # later ones are asked first
        out = F.when((host == s) | host.endswith("." + s), F.lit(s)).otherwise(out)
    return out


def reputations(pages: DataFrame, labels: DataFrame, suffixes_known: Sequence[str] = ()) -> DataFrame:
    """(host, low, mean, high) for every host of ``pages``.  One without a labelled page has its domain's mean, at the
    weight of the prior; a domain or suffix without any has that of the level above.

    ``pages`` has page_id and host, ``labels`` page_id and good (0 or 1); rows of one page_id count once, as bad if
    any says so.  A registered domain is one label before the suffix; suffixes of several labels are the caller's.
    Hosts, domains and suffixes stay tables; the driver gets sums over each level.  Empty tables give no rows."""
    labels = labels.where("good in (0, 1) and page_id is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    hosts = pages.join(labels, "page_id", "left").groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    suffix = suffix_of(F.col("host"), suffixes_known)
    domain = F.when(F.col("suffix") == F.col("host"), F.col("host")).otherwise(F.concat_ws(".", F.regexp_extract(F.expr("substr(host, 1, length(host) - length(suffix) - 1)"), r"([^.]*)$", 1), "suffix"))
    hosts = keep(hosts.withColumn("suffix", suffix).withColumn("domain", domain), "hosts")
    domains = keep(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = suffixes.agg(F.sum("n"), F.sum("good")).first()
    mean = ((total[1] or 0) + 1) / ((total[0] or 0) + 2)

    def shrunk(level: DataFrame) -> DataFrame:
        a = _strength(level)
        return level.withColumn("prior", F.lit(a)).withColumn("mean", (F.lit(a) * F.col("m") + F.col("good")) / (F.lit(a) + F.col("n")))

    suffixes = shrunk(suffixes.withColumn("m", F.lit(mean)))
    domains = shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("m")), "suffix"))
    hosts = shrunk(hosts.join(domains.select("domain", F.col("mean").alias("m")), "domain"))
    weight = F.col("prior") + F.col("n")
    spread = F.lit(Z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return hosts.select("host", (F.col("mean") - spread).alias("low"), "mean", (F.col("mean") + spread).alias("high"))


def judged(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, suffixes_known: Sequence[str] = ()) -> DataFrame:
    """``pages`` (page_id, url) as page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path.  A host without labelled pages is judged by its
    domain's posterior, or its suffix's or all pages'.  Repeated rows are each judged; other columns are left out."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    blocked = reputations(pages, labels, suffixes_known).where(F.col("high") < GOOD).select("host", F.lit("block").alias("found"))
    host, path = F.col("host"), F.col("path")
    verdict = F.coalesce(fitting_rule(host, path, rules, 2), F.col("found"), F.lit("allow"))
    return pages.join(blocked, "host", "left").select("page_id", "host", "path", fitting_rule(host, path, rules).alias("rule"), verdict.alias("verdict"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judged(read(spark, sf_dir, "pages"), labels)


def _level(name: str, above: str, keys: str, join: str) -> str:
    moments = f"sum(n * (good / n - m) ** 2 / (m * (1 - m))) AS s, sum(n) AS w, sum(n * n) AS w2, count(*) AS k"
    return f"""{name}_m AS (SELECT x.*, {above} AS m FROM {name}_n x {join}),
{name}_s AS (SELECT {moments} FROM {name}_m WHERE n > 0),
{name}_a AS (SELECT CASE WHEN k < 2 THEN 1.0 ELSE 1 / least(greatest(CASE WHEN w - w2 / w - (k - 1) > 0 THEN (s - (k - 1)) / (w - w2 / w - (k - 1)) ELSE 0 END, 0.001), 0.999) - 1 END AS a FROM {name}_s),
{name} AS (SELECT x.*, a, (a * m + good) / (a + n) AS mean FROM {name}_m x, {name}_a),"""


OP2_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
l AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id),
host_n AS (SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix, count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS good FROM p LEFT JOIN l USING (page_id) GROUP BY ALL),
domain_n AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM host_n GROUP BY ALL),
suffix_n AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domain_n GROUP BY ALL),
total AS (SELECT (sum(good) + 1) / (sum(n) + 2) AS mean FROM suffix_n),
{_level("suffix", "t.mean", "suffix", ", total t")}
{_level("domain", "y.mean", "domain", "JOIN suffix y USING (suffix)")}
{_level("host", "y.mean", "host", "JOIN domain y USING (domain)")}
bad AS (SELECT host FROM host WHERE mean + {Z} * sqrt(mean * (1 - mean) / (a + n + 1)) < {GOOD}),
r AS (SELECT p.*, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
