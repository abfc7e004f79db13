"""Every key gets a row of search_queries."""

from conftest import SF_SMALL
from ledgerlink.plans.base import table
from ledgerlink.plans.lookup_plans import search_queries


def test_invalid_keys_have_a_status(spark):
    rows = search_queries(spark, SF_SMALL).collect()
    assert len(rows) == table(spark, SF_SMALL, "orders").count()
    for r in rows:
        valid = r["bpg"].count("~") == 2
        assert r["status"] == ("ok" if valid else "invalid_key") and (r["query"] is not None) == valid
    assert {r["status"] for r in rows} == {"ok", "invalid_key"}
