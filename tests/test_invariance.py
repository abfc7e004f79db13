"""Every registered query gives the same rows (as a multiset) with 1 and with
8 shuffle partitions and with broadcasts off: no result depends on partitioning,
tie order or the physical join strategy."""

from collections import Counter

import __spark_entry__ as E
from conftest import SF_SMALL


def _rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(r[c] if not isinstance(r[c], float) else round(r[c], 9) for c in cols)
                   for r in df.select(*cols).collect())


def test_registered_queries_invariant(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        results = {}
        for conf in ({"spark.sql.shuffle.partitions": "1"},
                     {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
            for k, v in conf.items():
                spark.conf.set(k, v)
            for name, fn in E.queries().items():
                results.setdefault(name, []).append(_rows(fn(spark, SF_SMALL)))
        bad = [n for n, (a, b) in results.items() if a != b]
        assert not bad, bad
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
