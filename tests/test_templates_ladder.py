"""Query templates (B18) and the staged resolver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators.ladder import climb
from ledgerlink.operators.templates import MOST_TEMPLATES, issue

FIELDS = {"bin": "bin", "pcn": "pcn", "grp": "grp"}
KEYS = "id int, bin string, pcn string, grp string"
TEMPLATES = "priority int, template string, needs int"


def queries(spark, keys, templates):
    got = issue(spark.createDataFrame(keys, KEYS), FIELDS, spark.createDataFrame(templates, TEMPLATES))
    return sorted((r["id"], r["priority"], r["query"]) for r in got.collect())


def test_required_parts_decide_and_bracketed_parts_fall_away(spark):
    keys = [(1, "004336", "AB", "G1"), (2, None, "AB", ""), (3, "", None, None), (4, "a{pcn}b", "X", None)]
    templates = [(1, "BIN {bin} network", 0), (2, '"{bin}" PCN {pcn}', 0), (3, "[BIN {bin} ][PCN {pcn} ][Group {grp} ]benefits", 1),
                 (4, "[{bin}/{pcn} ]any", 0), (5, "{unknown}", 0), (6, "plain", 0)]
    assert queries(spark, keys, templates) == [
        (1, 1, "BIN 004336 network"), (1, 2, '"004336" PCN AB'), (1, 3, "BIN 004336 PCN AB Group G1 benefits"), (1, 4, "004336/AB any"), (1, 6, "plain"),
        (2, 3, "PCN AB benefits"), (2, 4, "any"), (2, 6, "plain"),
        (3, 4, "any"), (3, 6, "plain"),  # no part: the text that needs one is not issued
        (4, 1, "BIN a{pcn}b network"), (4, 2, '"a{pcn}b" PCN X'), (4, 3, "BIN a{pcn}b PCN X benefits"), (4, 4, "a{pcn}b/X any"), (4, 6, "plain")]  # values are no templates


def test_no_and_too_many_templates(spark):
    assert queries(spark, [(1, "1", "2", "3")], []) == []
    many = spark.range(MOST_TEMPLATES + 1).select(F.col("id").cast("int").alias("priority"), F.lit("x").alias("template"), F.lit(0).alias("needs"))
    with pytest.raises(ValueError, match="templates"):
        issue(spark.createDataFrame([], KEYS), FIELDS, many)


def test_queries_are_made_without_a_join(spark):
    keys = spark.range(10).select(F.col("id").cast("int"), F.lit("1").alias("bin"), F.lit("2").alias("pcn"), F.lit("3").alias("grp"))
    plan = issue(keys, FIELDS, spark.createDataFrame([(1, "{bin}", 0)], TEMPLATES))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_stages_see_open_keys_only(spark):
    seen = []

    def stage(rule):
        def resolve(open_):
            seen.append(sorted(r["id"] for r in open_.collect()))
            return open_.where(rule).select("id", F.concat(F.lit("by "), F.lit(rule)).alias("answer"))
        return resolve

    keys = spark.range(1, 13).withColumnRenamed("id", "id")
    out = climb(keys, "id", [("two", stage("id % 2 = 0")), ("three", stage("id % 3 = 0")), ("none left", stage("false"))], ["answer"])
    got = {r["id"]: (r["stage_no"], r["stage"], r["answer"]) for r in out.collect()}
    assert seen == [list(range(1, 13)), [1, 3, 5, 7, 9, 11], [1, 5, 7, 11]]
    assert got[6] == (1, "two", "by id % 2 = 0") and got[9] == (2, "three", "by id % 3 = 0") and got[7] == (0, "none", None)
    assert len(got) == 12


def test_every_stage_of_the_plan_ladder_is_reached(spark):
    from ledgerlink.plans.ladder_plans import plan_ladder

    rows = plan_ladder(spark, "/root/testdata/sf0.01").collect()
    assert {r["stage_no"] for r in rows} == {0, 1, 2, 3, 4, 5}
    assert any(" - " in r["plan_type"] for r in rows) and any("(" in r["plan_type"] for r in rows) and any(r["verified"] for r in rows)
