"""Matching by position (C8, C9) and scans inside a row (F5, F9): against brute force, and linear in the text."""

from __future__ import annotations

import random
import re
import time

from ledgerlink.operators import dictionary as DM
from ledgerlink.operators import ordered as O
from ledgerlink.operators.sizes import measured, small_side


def brute(lines, names):
    out = set()
    for i, t in lines:
        for n in names:
            m = re.search(r"\b" + re.escape(n) + r"\b", t, re.IGNORECASE)
            if m:
                out.add((i, n, m.start() + 1))
    return out


def test_names_at_every_place_against_the_pattern(spark):
    rng = random.Random(5)
    words = ["care", "Mark", "a", "É té", "x1", "care-mark", "plus+", "_u", "12", "(b)"]
    lines = [(i, rng.choice(["", " ", "- "]) + rng.choice([" ", ", ", "  "]).join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    lines += [(900, "carecare mark"), (901, None), (902, ""), (903, "Care  Mark care mark")]
    names = ["care", "care mark", "CARE-MARK", "mark, a", "a a", "é TÉ", "_u 12", "(b)", "plus+", "x1", "care  mark", "zzz"]
    l = spark.createDataFrame(lines, "id int, line string")
    n = spark.createDataFrame([(x,) for x in [*names, None, " "]], "name string")
    want = brute([x for x in lines if x[1] is not None], names)
    assert {tuple(r) for r in DM.word_matches(l, n, ["id"]).select("id", "name", "offset").collect()} == want
    old, DM.BROADCAST_BYTES = DM.BROADCAST_BYTES, -1  # names too large to send: candidates go back to their lines
    try:
        assert {tuple(r) for r in DM.word_matches(l, n, ["id"]).select("id", "name", "offset").collect()} == want
    finally:
        DM.BROADCAST_BYTES = old


def test_last_listed_substring_wins(spark):
    names = [(1, "alpha"), (2, "beta"), (3, "lph"), (4, None), (5, "")]
    texts = [("a", "ALPHA and beta"), ("b", "only beta"), ("c", "nothing"), ("d", None)]
    hits = DM.substring_matches(spark.createDataFrame(texts, "id string, text string"), spark.createDataFrame(names, "pos int, name string"), ["id"], "text", "name")
    got = {(r["id"], r["best"]) for r in DM.last_in_list(hits, ["id"], "pos", "name", "best").collect()}
    assert got == {("a", "lph"), ("b", "beta")}


def test_no_broadcast_beyond_the_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "name string")
    assert 50_000 <= measured(df) <= 60_000
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(small_side(df)) and not hint(small_side(df, 40_000))


def seconds(df):
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def test_one_long_text_takes_time_in_proportion(spark):
    """Ten times the lines of one text: quadratic work would take a hundred times as long."""
    def text(n):
        return "\n".join(f"line {i}" if i % 3 else f"{10000 + i} Code" for i in range(n))

    def frame(n):
        return spark.createDataFrame([(1, text(n))], "id int, text string")

    for run in (lambda d: O.merge_wrapped_lines(d, "text", "m"), lambda d: O.carry_down(d, "id", "text", r"(\d{5,6})", r"^([A-Z][a-z]+|\d+)")):
        small, large = frame(8_000), frame(80_000)
        seconds(run(small))
        a, b = min(seconds(run(small)) for _ in range(3)), min(seconds(run(large)) for _ in range(2))
        assert b < 30 * max(a, 0.05), (a, b)


def test_carry_down_against_the_loop(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice(["12345 Alpha", "Beta", "no code", "99999", "Gamma 1", ""]) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, ""]
    want = set()
    for i, t in enumerate(texts):
        key = None
        for j, line in enumerate((t or "").split("\n") if t is not None else []):
            m = re.search(r"(\d{5,6})", line)
            key = m[1] if m else key
            c = re.search(r"^([A-Z][a-z]+)", line)
            if c and key:
                want.add((i, j, key, c[1]))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = O.carry_down(df, "id", "text", r"(\d{5,6})", r"^([A-Z][a-z]+)")
    assert {tuple(r) for r in out.collect()} == want
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
