"""Plan-name matching over ``part`` (L6: B11 B12 C5 C6 C7).

Choices are the part names (position = p_partkey).  Names to match are every
part row's name with one kind of noise chosen by p_size % 4: words swapped,
second letter dropped, ``/`` pair with the brand, first word abbreviated to
two letters.  The abbreviation dictionary is derived from the part-name words
(two-letter prefix -> word, position = first part key using the word).

The oracle computes LCS by a recursive CTE over the part's characters whose
state is one row of the dynamic programme.  tests/test_fuzzy.py checks the
results against a brute force as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fuzzy import fuzzy_best as _best
from ..operators.fuzzy import fuzzy_top_k
from .base import table


def fuzzy_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    name = F.col("p_name")
    first_space = F.instr(name, " ")
    noisy = (F.when(F.col("p_size") % 4 == 0, F.array_join(F.reverse(F.split(name, " ")), " "))
             .when(F.col("p_size") % 4 == 1, F.concat(F.substring(name, 1, 1), F.substr(name, F.lit(3))))
             .when(F.col("p_size") % 4 == 2, F.concat(name, F.lit(" / "), F.col("p_brand")))
             .otherwise(F.concat(F.substring(name, 1, 2), F.substr(name, first_space))))
    names = p.select(F.col("p_partkey").alias("seq"), noisy.alias("plan_name"))
    choices = p.select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("plan"))
    words = p.select("p_partkey", F.explode(F.split(name, " ")).alias("w")).where(F.col("w") != "")
    abbrevs = words.groupBy("w").agg(F.min("p_partkey").alias("seq")).select(
        "seq", F.substring("w", 1, 2).alias("abbreviation"), F.col("w").alias("full_form"))
    return names, choices, abbrevs


def fuzzy_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, choices, abbrevs = fuzzy_inputs(spark, sf_dir)
    return _best(spark, names, choices, abbrevs)


def fuzzy_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, choices, abbrevs = fuzzy_inputs(spark, sf_dir)
    return fuzzy_top_k(spark, names, choices, abbrevs, k=3)


QUERIES = {"fuzzy_best": fuzzy_best, "fuzzy_top3": fuzzy_top3}

_SCORES = r"""
WITH RECURSIVE nm AS (
  SELECT p_partkey AS seq,
         CASE p_size % 4 WHEN 0 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ')
              WHEN 1 THEN substring(p_name, 1, 1) || substring(p_name, 3)
              WHEN 2 THEN p_name || ' / ' || p_brand
              ELSE substring(p_name, 1, 2) || substring(p_name, greatest(instr(p_name, ' '), 1)) END AS plan_name
  FROM part),
words AS (
  SELECT w, min(p_partkey) AS seq FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
  WHERE w <> '' GROUP BY w),
ab AS (
  SELECT tok, w AS full_form FROM (
    SELECT lower(trim(substring(w, 1, 2))) AS tok, lower(trim(w)) AS w,
           row_number() OVER (PARTITION BY lower(trim(substring(w, 1, 2))) ORDER BY seq DESC, lower(trim(w)) DESC) AS n
    FROM words) WHERE n = 1),
parts AS (
  SELECT seq, i - 1 AS part_idx, raws[i] AS raw
  FROM (SELECT seq, string_split(plan_name, '/') AS raws, generate_subscripts(string_split(plan_name, '/'), 1) AS i
        FROM nm WHERE plan_name IS NOT NULL)),
raw AS (SELECT DISTINCT raw FROM parts UNION SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL),
cl AS (
  SELECT raw, string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower(raw), '\(.*?\)', '', 'g'),
                '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')), ' ') AS toks
  FROM raw),
tk AS (SELECT raw, generate_subscripts(toks, 1) AS i, unnest(toks) AS tok FROM cl),
pr AS (
  SELECT tk.raw, string_agg(coalesce(ab.full_form, tk.tok), ' ' ORDER BY tk.i) AS cleaned
  FROM tk LEFT JOIN ab ON ab.tok = tk.tok GROUP BY tk.raw),
ch AS (
  SELECT pr.cleaned, min(p_partkey) AS choice_pos, arg_min(p_name, p_partkey) AS original
  FROM part JOIN pr ON pr.raw = p_name GROUP BY pr.cleaned),
pp AS (SELECT seq, part_idx, cleaned AS part FROM parts JOIN pr USING (raw)),
pairs AS (
  SELECT part, choice_pos, array_to_string(list_sort(string_split(part, ' ')), ' ') AS a,
         array_to_string(list_sort(string_split(cleaned, ' ')), ' ') AS b
  FROM (SELECT DISTINCT part FROM pp), ch),
lcs AS (
  SELECT part, choice_pos, a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) AS r FROM pairs
  UNION ALL
  SELECT part, choice_pos, a, b, i + 1,
         list_reduce(list_transform(range(1, length(b) + 1), lambda j: [j]),
                     lambda acc, x: list_append(acc, CASE WHEN substring(a, i + 1, 1) = substring(b, x[1], 1) THEN r[x[1]] + 1
                                                          ELSE greatest(r[x[1] + 1], acc[-1]) END), [0::BIGINT])
  FROM lcs WHERE i < length(a)),
sc AS (
  SELECT part, choice_pos, CASE WHEN length(a) + length(b) = 0 THEN 100::DOUBLE
                                ELSE 200::DOUBLE * r[-1] / (length(a) + length(b)) END AS score
  FROM lcs WHERE i = length(a)),
top AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY score DESC, choice_pos) AS rnk FROM sc QUALIFY rnk <= 3),
hits AS (
  SELECT pp.seq, pp.part_idx, top.rnk, top.score, top.choice_pos, ch.original
  FROM pp JOIN top ON top.part = pp.part JOIN ch ON ch.choice_pos = top.choice_pos)
"""

SQL = {
    "fuzzy_best": _SCORES + """,
best AS (
  SELECT *, row_number() OVER (PARTITION BY seq ORDER BY score DESC, part_idx, choice_pos) AS n FROM hits QUALIFY n = 1)
SELECT nm.seq, nm.plan_name, CASE WHEN best.score >= 85 THEN best.original END AS best_match, best.score AS match_score
FROM nm LEFT JOIN best ON best.seq = nm.seq""",
    "fuzzy_top3": _SCORES + """,
once AS (
  SELECT *, row_number() OVER (PARTITION BY seq, choice_pos ORDER BY score DESC, part_idx, rnk) AS n FROM hits QUALIFY n = 1),
m AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY score DESC, part_idx, rnk) AS k FROM once)
SELECT nm.seq, nm.plan_name,
       max(original) FILTER (WHERE k = 1) AS match1_plan, max(score) FILTER (WHERE k = 1) AS match1_score,
       max(original) FILTER (WHERE k = 2) AS match2_plan, max(score) FILTER (WHERE k = 2) AS match2_score,
       max(original) FILTER (WHERE k = 3) AS match3_plan, max(score) FILTER (WHERE k = 3) AS match3_score
FROM nm LEFT JOIN m ON m.seq = nm.seq GROUP BY nm.seq, nm.plan_name""",
}
