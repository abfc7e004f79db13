"""A key holding a third of all rows: results stay whole and exact when AQE
splits the skewed join partitions (thresholds lowered so splitting happens)."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import dedup as D
from ledgerlink.operators import ordered as O
from ledgerlink.operators.cascade import cascade_counts, cascade_join
from test_operators import _brute_cascade

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_cascade_hot_key(skewed):
    rng = random.Random(21)
    left, right = [], []
    for i in range(900):
        hot = i % 3 == 0
        left.append((i, "000001" if hot else str(rng.randint(2, 60)).zfill(6),
                     rng.choice(["a", "b", None]), rng.choice([None, f"g{rng.randint(0, 30)}"])))
    for j in range(600):
        hot = j % 3 == 0
        right.append((10_000 + j, "000001" if hot else str(rng.randint(2, 80)).zfill(6),
                      rng.choice(["a", "b", "c"]), rng.choice([None, f"g{rng.randint(0, 40)}"])))
    l = skewed.createDataFrame(left, "row_id long, bin string, pcn string, grp string").repartition(8)
    r = skewed.createDataFrame(right, "right_id long, bin string, pcn string, grp string").repartition(8)
    got = [(x["row_id"], x["matched_level"], x["right_id"]) for x in cascade_join(l, r).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _brute_cascade(left, right)


def test_cascade_hot_right_key(skewed):
    """A third of the right rows share a BIN that two left rows ask for: the payload join is inner, so either side
    can be split, and the counts agree with the joined rows."""
    left = [(1, "000001", None, None), (2, "000001", "zz", None), (3, "000002", None, None), (4, None, None, None)]
    right = [(j, "000001" if j % 3 == 0 else str(2 + j % 50).zfill(6), "a", None) for j in range(3000)]
    l = skewed.createDataFrame(left, "row_id long, bin string, pcn string, grp string")
    r = skewed.createDataFrame(right, "right_id long, bin string, pcn string, grp string").repartition(8)
    joined = cascade_join(l, r)
    got = joined.collect()
    assert {(x["row_id"], x["matched_level"], x["right_id"]) for x in got} == _brute_cascade(left, right)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" not in plan and "skew=true" in plan
    per_row = {x["row_id"]: sum(y["row_id"] == x["row_id"] and y["right_id"] is not None for y in got) for x in got}
    assert {x["row_id"]: x["match_count"] for x in cascade_counts(l, r).collect()} == per_row


def test_dedup_hot_hash(skewed):
    rows = [(f"f{i:04d}", "hot" if i % 3 == 0 else f"h{i % 97}", i) for i in range(3000)]
    files = skewed.createDataFrame(rows, "file_name string, content_hash string, seq int").repartition(8)
    got = {(r["file_name"], r["original"]) for r in D.assign_originals(files, ("seq",)).collect()}
    first = {}
    for name, h, seq in sorted(rows, key=lambda x: x[2]):
        first.setdefault(h, name)
    assert got == {(n, first[h]) for n, h, _ in rows}
    rep = D.duplicate_report(D.assign_originals(files, ("seq",)).where(~F.col("is_duplicate")),
                             D.duplicate_pairs(D.assign_originals(files, ("seq",))))
    counts = {r["original_file"]: r["duplicate_count"] for r in rep.select("original_file", "duplicate_count").distinct().collect()}
    assert counts[first["hot"]] == 999


def test_gap_fill_hot_group_blocked(skewed):
    rng = random.Random(4)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 20), i, rng.choice([None, None, str(i)]), rng.choice(["", "x"]))
            for i in range(3000)]
    df = skewed.createDataFrame(rows, "g int, seq long, bin string, pcn string")
    plain = {(r["seq"], r["bin"]) for r in O.gap_fill(df, ["g"], "seq").collect()}
    blocked = {(r["seq"], r["bin"]) for r in O.gap_fill(df.withColumn("blk", (F.col("seq") / 64).cast("long")),
                                                         ["g"], "seq", block_col="blk").collect()}
    assert plain == blocked


def test_word_matches_hot_token(skewed):
    import re
    from ledgerlink.operators.dictionary import word_matches
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "care", "mark"]
    lines = []
    for i in range(1500):
        toks = [rng.choice(words) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            toks.insert(rng.randint(0, len(toks)), "hot")
        lines.append((i, " ".join(toks)))
    names = ["hot", "beta gamma", "care-mark", "Delta", "hot alpha"]
    l = skewed.createDataFrame(lines, "id long, line string").repartition(8)
    n = skewed.createDataFrame([(x,) for x in names], "name string")
    got = {(r["id"], r["name"]) for r in word_matches(l, n, ["id"], "line", "name").collect()}
    want = {(i, x) for i, t in lines for x in names if re.search(r"(?i)\b" + re.escape(x) + r"\b", t)}
    assert got == want


def test_gap_fill_many_levels(skewed):
    """Blocks of 3, levels of 4: values travel over several levels; a group's first rows lie far apart from its last."""
    rng = random.Random(6)
    rows = [(0 if i % 3 == 0 else rng.randint(1, 5), i * (1 if i < 1500 else 7), rng.choice([None] * 40 + [str(i)]), rng.choice(["", "x"])) for i in range(3000)]
    df = skewed.createDataFrame(rows, "g int, seq long, bin string, pcn string")
    plain = {(r["seq"], r["bin"]) for r in O.gap_fill(df, ["g"], "seq").collect()}
    blocked = df.withColumn("blk", F.floor(F.col("seq") / 3))
    filled = O.gap_fill(blocked, ["g"], "seq", block_col="blk", fan=4)
    assert {(r["seq"], r["bin"]) for r in filled.collect()} == plain
    # three levels above the blocks' own: ceil(log4 of 3,500 blocks) sweeps
    assert filled._jdf.queryExecution().optimizedPlan().toString().count("Window [") >= 6
