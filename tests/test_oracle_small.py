"""The correctness gate inside pytest: every query with oracle SQL equals its
DuckDB result at sf0.001 (row count, columns, multiset of normalised rows)."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlink.plans.base import TABLES
from tools.oracle_check import norm


def test_all_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = []
    for name, text in sql.items():
        s = qs[name](spark, SF_SMALL).toPandas()
        d = con.sql(text).df()
        if sorted(s.columns) != sorted(d.columns) or len(s) != len(d) or norm(s) != norm(d):
            bad.append(name)
    assert not bad, bad
