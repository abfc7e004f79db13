"""Driver contract: entry() runs, every query has a callable, SQL keys are queries."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "matched_level" in df.columns


def test_registry_shapes():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 30


def test_every_query_runs_at_smallest_scale(spark):
    for name, fn in E.queries().items():
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.limit(1).count() >= 0, name
