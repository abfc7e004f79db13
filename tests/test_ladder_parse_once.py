"""The staged lookup reads and parses each page once, not once per search."""

from ledgerlink.plans.ladder_plans import searches


def test_pages_are_parsed_once(spark, tmp_path):
    html = '<html><head><title>Onen Plan</title></head><body><a href="ab">x</a><p>Tier 2</p></body></html>'
    pages = spark.createDataFrame([(i, f"http://m.example.org/{i}", html if i % 4 else None) for i in range(40)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    made = searches(spark, str(tmp_path))
    assert "FileScan" not in made._jdf.queryExecution().sparkPlan().toString()
    assert made.where("query like 'BIN %'").count() > 0
