"""The cascade shuffles each side no more often than it must."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import cascade
from ledgerlink.operators.cascade import bpg_levels, cascade_counts, cascade_join, precomputed_levels

ROW = "bin string, pcn string, grp string"


def _tables(spark):
    left = spark.createDataFrame([(i, str(i % 7), "A", f"g{i % 40}" if i % 3 else None) for i in range(200)], f"row_id long, {ROW}")
    right = spark.createDataFrame([(i, str(i % 9), "AB"[i % 2], f"g{i % 50}" if i % 4 else None) for i in range(300)], f"right_id long, {ROW}")
    return left, right


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_keys_are_dealt_out_once(spark):
    """Distinct left keys are found where the join wants them: by the anchor, not by the whole key before that."""
    assert "hashpartitioning(row_id" in (plan := _plan(cascade_counts(*_tables(spark))))
    assert not [x for x in plan.splitlines() if "hashpartitioning(row_id" in x and "_cj_a" in x]


def test_one_payload_join_for_all_families(spark):
    plan = _plan(cascade_join(*_tables(spark)))
    assert sum("ShuffledHashJoin" in x and "_cj_rf" in x for x in plan.splitlines()) == 1


def test_one_pass_sizes_the_anchors_of_all_families(spark, monkeypatch):
    """Anchors of many left rows, blanks aside, are found per family; blank anchors never count."""
    left = spark.createDataFrame([(i, "1" if i < 6 else " ", None, "g" if i < 2 else None) for i in range(40)], f"row_id long, {ROW}")
    monkeypatch.setattr(cascade, "MOST_PER_ANCHOR", 5)
    grp, bin_ = cascade._families(bpg_levels(), left)
    assert grp.hot is None and bin_.hot.count() == 1 and (grp.counted, bin_.counted) == (False, True)
    empty = cascade._families(bpg_levels(), left.where("false"))
    assert [(f.hot, f.counted) for f in empty] == [(None, False)] * 2


def test_anchors_of_many_left_rows_are_not_hashed(spark, monkeypatch):
    """They meet by their keys; the hashed side of the payload join holds few rows per anchor."""
    left, right = _tables(spark)
    monkeypatch.setattr(cascade, "MOST_PER_ANCHOR", 6)
    assert [f.hot is None for f in cascade._families(bpg_levels(), left)] == [True, False]
    plan = _plan(cascade_join(left, right))
    assert [x for x in plan.splitlines() if "LeftAnti" in x and "_cj_f" in x]


def _made(spark, seed: int, n: int, id_col: str):
    """Rows with keys made of their parts: with the anchor ("g", "gg" or "h") in front, at the end, in the middle, or not at all."""
    r, out = random.Random(seed), []
    for i in range(n):
        g, x, y = r.choice([None, "", "g", "gg", " h"]), r.choice([None, "", "g", "<", "b"]), r.choice([None, "", "g", "c"])
        a = (g or "").strip()
        make = lambda *parts: None if "" in parts or None in parts else "~".join(parts)
        out.append((i, make(a, x, y), r.choice([make(x, a), (make(x, a) or "") + " "]) if x else None, g, make(x, y), x))
    return spark.createDataFrame(out, f"{id_col} long, k1 string, k2 string, k3 string, k4 string, k5 string")


@pytest.mark.parametrize("most", [256, 3])
def test_keys_made_beforehand_travel_without_their_anchor(spark, monkeypatch, most):
    monkeypatch.setattr(cascade, "MOST_PER_ANCHOR", most)
    keys = ("k1", "k2", "k3", "k4", "k5")
    levels = precomputed_levels(left_cols=keys, anchors=("k3", "k3", "k3", "k5", "k5"))
    left, right = _made(spark, 1, 60, "row_id"), _made(spark, 2, 50, "right_id")
    joined = cascade_join(left, right, levels).select("row_id", "right_id", "matched_level")
    clean = lambda row: [(row[k] or "").strip() for k in keys]
    want, others = [], [(clean(x), x["right_id"]) for x in right.collect()]
    for row in left.collect():
        hits = [[i for key, i in others if key[n] and key[n] == mine] for n, mine in enumerate(clean(row))]
        n = next((n for n, found in enumerate(hits) if found), None)
        want += [(row["row_id"], None, "Unmatched")] if n is None else [(row["row_id"], i, levels[n].name) for i in hits[n]]
    assert sorted(map(str, map(tuple, joined.collect()))) == sorted(map(str, want))
    assert len({w[2] for w in want}) == 6
    if most == 256:  # of the right rows the payload join deals out the id, the anchor and what the keys have besides
        dealt = [x for x in _plan(joined).splitlines() if "AS _cj_rf" in x and "Project" in x]
        assert len(dealt) >= 2 and all(re.findall(r"AS (_cj_r\d+)#", x) == ["_cj_r0"] for x in dealt)


def test_short_texts_agree_where_whole_ones_do(spark):
    texts = ["", "a", "aa", "ab", "ba", "aba", "<a", ">b", "=b", "b", "abab", "bab", "<", "=", "aab", "baa", "\x01", "\x02", "\x01\x02", "\x01\x03", "a\x01", "\x01a", "\x03", "\x02\x02"]
    df = spark.createDataFrame([(t, a) for t in texts for a in ("a", "ab", "\x01", "\x02")], "t string, a string")
    got = df.select("t", "a", cascade._short(F.col("t"), F.col("a")).alias("s")).collect()
    for a in ("a", "ab", "\x01", "\x02"):
        mine = [x["s"] for x in got if x["a"] == a]
        assert len(set(mine)) == len(texts) and mine[0] == ""
