"""The cascade by families: rows meet on the anchor; anchors of many left rows by their keys."""

import random

import pytest

from ledgerlink.operators import cascade
from ledgerlink.operators.cascade import Level, cascade_counts, cascade_join, precomputed_levels

PARTS = ("bin", "pcn", "grp")
LEVELS = [("BPG", (0, 1, 2)), ("BIN_GRP", (0, 2)), ("GRP", (2,)), ("BIN_PCN", (0, 1)), ("BIN", (0,))]
ROW = "bin string, pcn string, grp string"


def _rows(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    pick = lambda *xs: r.choice([None, "", *xs, *xs])
    return [(i, pick("1", " 1", "2", "3"), pick("A", "B ", "B"), pick("g", "h", "i")) for i in range(n)]


def _clean(row):
    return [(x or "").strip() or None for x in row[1:]]


def _expected(left, right) -> set:
    out = set()
    for row in left:
        for name, at in LEVELS:
            key = [_clean(row)[i] for i in at]
            hits = [x[0] for x in right if None not in key and [_clean(x)[i] for i in at] == key]
            if hits:
                out |= {(row[0], name, h) for h in hits}
                break
        else:
            out.add((row[0], "Unmatched", None))
    return out


@pytest.mark.parametrize("most", [256, 12, 0])
@pytest.mark.parametrize("count_from", [0, 1000])
def test_families_against_all_pairs(spark, monkeypatch, most, count_from):
    monkeypatch.setattr(cascade, "MOST_PER_ANCHOR", most)
    monkeypatch.setattr(cascade, "COUNT_FROM", count_from)
    left, right = _rows(1, 70), _rows(2, 40)
    l, r = spark.createDataFrame(left, f"row_id long, {ROW}"), spark.createDataFrame(right, f"right_id long, {ROW}")
    want = _expected(left, right)
    got = [(x["row_id"], x["matched_level"], x["right_id"]) for x in cascade_join(l, r).collect()]
    assert len(got) == len(want) and set(got) == want
    counts = {(x["row_id"], x["matched_level"], x["match_count"]) for x in cascade_counts(l, r).collect()}
    assert counts == {(i, lv, sum(w[0] == i and w[2] is not None for w in want)) for i, lv, _ in want}


def test_anchor_of_the_callers_levels(spark):
    left = spark.createDataFrame([(1, "ag", "g"), (2, "xg", "g"), (3, "x", None)], "row_id long, fine string, coarse string")
    right = spark.createDataFrame([(7, "ag", "g"), (8, "bg", "g"), (9, "x", None)], "right_id long, fine string, coarse string")
    levels = precomputed_levels(("FINE", "COARSE"), ("fine", "coarse"), anchors=("coarse", "coarse"))
    got = {(x["row_id"], x["matched_level"], x["right_id"]) for x in cascade_join(left, right, levels).collect()}
    assert got == {(1, "FINE", 7), (2, "COARSE", 7), (2, "COARSE", 8), (3, "Unmatched", None)}
    own = precomputed_levels(("FINE", "COARSE"), ("fine", "coarse"))  # each level meets on its own key
    got = {(x["row_id"], x["matched_level"], x["right_id"]) for x in cascade_join(left, right, own).collect()}
    assert got == {(1, "FINE", 7), (2, "COARSE", 7), (2, "COARSE", 8), (3, "FINE", 9)}
    assert Level("L", ("a", "b"), ("c", "d")).meets_on == ("a", "c")


def test_ids_that_repeat_or_are_null(spark):
    left = spark.createDataFrame([(1, "1", "A", "g"), (1, "1", "A", "g"), (2, "1", None, None), (2, "2", None, "g"), (None, "1", "A", "g")],
                                 f"row_id long, {ROW}")
    right = spark.createDataFrame([(7, "1", "A", "g"), (8, "1", "A", "g"), (9, "1", "B", None)], f"right_id long, {ROW}")
    got = sorted((x["row_id"] or 0, x["bin"], x["matched_level"], x["match_count"]) for x in cascade_counts(left, right).collect())
    assert got == [(0, "1", "Unmatched", 0), (1, "1", "BPG", 2), (1, "1", "BPG", 2), (2, "1", "GRP", 2), (2, "2", "GRP", 2)]


def test_right_rows_are_not_multiplied_by_levels(spark):
    """Without anchors of many left rows, nothing is exploded into one row per level."""
    l = spark.createDataFrame(_rows(1, 30), f"row_id long, {ROW}")
    r = spark.createDataFrame(_rows(2, 30), f"right_id long, {ROW}")
    for out in (cascade_join(l, r), cascade_counts(l, r)):
        assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
