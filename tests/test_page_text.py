"""Page lookups read all text that a page shows."""

from ledgerlink.functions.text import visible_text
from ledgerlink.operators import dictionary
from ledgerlink.plans.base import param_table
from ledgerlink.plans.dictionary_plans import network_indicator
from ledgerlink.plans.lookup_plans import plan_lookup
from ledgerlink.plans.search_plans import bin_lookup, plan_variants

PAGE = ("<html><head><title>Some page</title><script>var t='</p> Tier 9';</script></head><body><!-- Tier 8 --><h1>A</h1>"
        "<p>first\nlines</p><p class='x'>On <b>exam</b>ple.com/fr/de/ &amp; more\n<p>Updated March 3, 2021 Tier 2</p></body></html>")


def test_visible_text(spark):
    html = [PAGE, "", None, "a&#65;&#x1F600;&#xZ;&lt;b&gt;<p", "&amp;lt; <!-- cut off"]
    got = [r[0] for r in spark.createDataFrame([(i, h) for i, h in enumerate(html)], "i int, h string").coalesce(1)
           .orderBy("i").select(visible_text("h")).collect()]
    assert got == ["A first lines On example.com/fr/de/ & more Updated March 3, 2021 Tier 2", "", None,
                   "aA\U0001F600&#xZ;<b>", "&lt;"]


def test_lookups_search_later_paragraphs(spark, tmp_path):
    spark.createDataFrame([(10, "http://h/", PAGE)], "page_id long, url string, html string") \
        .write.parquet(f"{tmp_path}/pages.parquet")
    one = lambda q: q(spark, str(tmp_path)).first().asDict()
    assert one(network_indicator)["network"] == "German Network"
    assert one(plan_variants)["benefit_variant"] != "Not Found"
    assert one(bin_lookup)["document_date"] == "March 3, 2021"
    assert one(bin_lookup)["plan_type"].startswith("French Com Network")
    assert one(plan_lookup)["document_date"] == "March 3, 2021"


def test_long_texts_are_searched_whole(spark, monkeypatch):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(3000)) + "Żółw" + "x" * 300
    lines = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    pats = [text[k:k + n] for k, n in ((0, 4), (254, 9), (250, 300), (2990, 14), (3303, 1), (511, 2))] + ["-"]
    for few in (64, 0):
        monkeypatch.setattr(dictionary, "FEW_PATTERNS", few)
        got = dictionary.substring_matches(lines, param_table(spark, [(p,) for p in pats], ["pattern"]), ["id"], "text", "pattern")
        assert {(r["id"], r["pattern"]): r["offset"] for r in got.collect()} == {(1, p): text.lower().find(p.lower()) + 1 for p in pats if p != "-"}
