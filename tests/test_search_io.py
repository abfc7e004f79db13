"""Search-result operators, sources/sinks and profile."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import search as S
from ledgerlink.operators.conform import conform, first_existing, union_all
from ledgerlink.operators.dictionary import first_by_priority, hit_list, substring_matches, word_matches
from ledgerlink.operators.links import link_report, natural_sort, pick_document_link
from ledgerlink.plans.base import param_table
from ledgerlink.sources import io as IO


def test_variant_phrases(spark):
    df = spark.createDataFrame([(1, 1, "nothing here", "g9"), (1, 2, "Premium Benefits and Tier 2", "g9"),
                                (2, 1, "ref G9AB7 and Group alpha", "g9")],
                               "q int, pos int, text string, gid string")
    b = {r["q"]: r["v"] for r in S.first_variant(df, "q", "pos", "text", out_col="v").collect()}
    assert b == {1: "Premium Benefits", 2: "Not Found"}
    g = {r["q"]: r["v"] for r in S.first_variant(df, "q", "pos", "text", S.GROUP_PATTERNS, id_col="gid",
                                                 out_col="v").collect()}
    assert g == {1: "Not Found", 2: "Group alpha"}


def test_group_rules_and_codes(spark):
    keys = spark.createDataFrame([(1, "000001", "G7"), (2, "000002", "XG19"), (3, "000003", "Z")],
                                 "row_id int, bin string, grp string")
    codes = spark.createDataFrame([("000001", "One")], "code string, label string")
    rules = param_table(spark, [(2, "G1", "contains", "Ones"), (1, "G7", "exact", "Seven")],
                        ["priority", "pattern", "kind", "label"])
    out = S.group_rule_lookup(S.known_code_lookup(keys, "bin", codes).withColumnRenamed("label", "code"),
                              ["row_id"], "grp", rules)
    got = {r["row_id"]: (r["code"], r["label"]) for r in out.collect()}
    assert got == {1: ("One", "Seven"), 2: (None, "Ones"), 3: (None, None)}


def test_first_template_top_n_last_n(spark):
    df = spark.createDataFrame([("k", 2, 1), ("k", 1, 3), ("k", 1, 2), ("k", 1, 9), ("j", 2, 1)],
                               "key string, tp int, pos int")
    f = S.first_template_with_results(df, "key", "tp")
    top = S.top_n_per_group(f, "key", "pos", 2)
    assert sorted((r["key"], r["pos"]) for r in top.collect()) == [("j", 1), ("k", 2), ("k", 3)]
    assert [r["pos"] for r in S.last_n(df, "pos", 2).collect()] == [9, 3]


def test_download_candidates_and_pages(spark):
    df = spark.createDataFrame([("ann", None, None), ("ann", "", "not found"), ("ann", "x", None), ("bob", None, "")],
                               "assigned_to string, pdf_links string, comments string")
    assert S.download_candidates(df, "ann").count() == 1
    docs = spark.createDataFrame([("d", ["a", " ", "b"])], "doc string, pages array<string>")
    assert [(r["page_no"], r["text"]) for r in S.pages_of(docs, "doc", "pages").collect()] == [(1, "a"), (3, "b")]


def test_substring_and_word_matches(spark):
    lines = spark.createDataFrame([(1, "See CVS-Caremark and ACME today"), (2, "acmes only"), (3, "a & b")],
                                  "id int, line string")
    names = spark.createDataFrame([("ACME",), ("caremark",), ("&",), ("x",)], "name string")
    w = sorted((r["id"], r["name"]) for r in word_matches(lines, names, ["id"], "line", "name").collect())
    assert w == [(1, "ACME"), (1, "caremark"), (3, "&")] or w == [(1, "ACME"), (1, "caremark")]
    pats = param_table(spark, [(1, "mark"), (2, "acme"), (3, "b")], ["priority", "pattern"])
    s = substring_matches(lines.withColumnRenamed("line", "text"), pats, ["id"], "text", "pattern")
    got = sorted((r["id"], r["pattern"], r["offset"]) for r in s.collect())
    assert got == [(1, "acme", 22), (1, "mark", 13), (2, "acme", 1), (3, "b", 5)]
    best = first_by_priority(s, ["id"], ["priority"], ["pattern"])
    assert {r["id"]: r["pattern"] for r in best.collect()} == {1: "mark", 2: "acme", 3: "b"}
    hl = hit_list(s, ["id"], "pattern", ["offset"], out_col="m")
    assert {r["id"]: r["m"] for r in hl.collect()}[1] == "mark, acme"


def test_link_report_and_natural_sort(spark):
    ref = spark.createDataFrame([(1, "pdf_10.pdf", "L10"), (2, "pdf_2.pdf", "L2"), (3, "pdf_3.pdf", None),
                                 (4, "pdf_2.pdf", "L2b")], "seq int, file_name string, pdf_link string")
    pairs = spark.createDataFrame([("pdf_2.pdf", "pdf_3.pdf")], "original string, duplicate string")
    counts = spark.createDataFrame([("pdf_2.pdf", 1)], "original string, duplicate_count long")
    rep = {(r["seq"]): r for r in link_report(ref, pairs, counts).collect()}
    assert rep[3]["status"] == "Duplicate" and rep[3]["maps_to_original"] == "pdf_2.pdf"
    assert rep[3]["pdf_link"] == "Link Not Found" and rep[3]["original_link"] == "L2b"   # last value wins
    assert rep[1]["total_duplicates"] == 0 and rep[2]["total_duplicates"] == 1
    names = [r["f"] for r in natural_sort(spark.createDataFrame(
        [("vol2_pdf_12.pdf",), ("vol2_pdf_3.pdf",), ("none.pdf",)], "f string"), "f").collect()]
    assert names == ["vol2_pdf_3.pdf", "vol2_pdf_12.pdf", "none.pdf"]


def test_pick_document_link(spark):
    df = spark.createDataFrame([("a.PDF", []), ("a.html", [("x.html",), ("y.pdf",)]), ("a.html", []), ("", [])],
                               "link string, sitelinks array<struct<link:string>>")
    got = [r[0] for r in df.select(pick_document_link("link", "sitelinks")).collect()]
    assert got == ["a.PDF", "y.pdf", "a.html", None]


def test_conform_union_first_existing(spark):
    a = spark.createDataFrame([("x", None)], "a string, b string")
    b = spark.createDataFrame([(1,)], "c int")
    u = union_all([a, b])
    assert set(u.columns) == {"a", "b", "c"}
    out = conform(a, ["b", "a", "z"], "(NULL)").first()
    assert tuple(out) == ("(NULL)", "x", "(NULL)")
    assert first_existing(a, ["rule_applied", "b"]) == "b"


def test_sources_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="io-", dir="/tmp")
    folder = os.path.join(base, "in")
    os.makedirs(os.path.join(folder, "duplicates"))
    for name, body in (("a.pdf", b"1"), ("B.PDF", b"2"), ("c.txt", b"3"), ("duplicates/d.pdf", b"4")):
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(body)
    files = IO.scan_files(spark, folder)
    assert sorted(r["file_name"] for r in files.collect()) == ["B.PDF", "a.pdf"]
    with open(os.path.join(base, "lat.txt"), "wb") as fh:
        fh.write("caf\xe9\nline2\n".encode("latin-1"))
    lines = IO.scan_lines(spark, os.path.join(base, "lat.txt"))
    assert [(r["line_no"], r["line"]) for r in lines.orderBy("line_no").collect()] == [(1, "café"), (2, "line2")]
    reg = IO.load_or_empty(spark, os.path.join(base, "missing"), IO.REGISTRY_SCHEMA)
    assert reg.count() == 0 and reg.columns == ["content_hash", "original"]
    IO.write_report(os.path.join(base, "rep"), {"t1": files.select("file_name"), "t2": lines})
    assert spark.read.parquet(os.path.join(base, "rep", "t2")).count() == 2
    prof = {r["column"]: r for r in IO.profile(lines).collect()}
    assert prof["line"]["non_null"] == 2


def test_last_in_list_substring(spark):
    """Plain substring, the last dictionary entry (list order) that occurs wins; blanks never match."""
    from ledgerlink.operators.dictionary import last_in_list
    pages = spark.createDataFrame([(1, "Acme and Beta plans"), (2, "nothing")], "page int, text string")
    names = param_table(spark, [(1, "acme"), (2, ""), (3, "beta"), (4, "zed")], ["pos", "pattern"])
    hits = substring_matches(pages, names, ["page"], "text", "pattern")
    got = {r["page"]: r["payer"] for r in last_in_list(hits, ["page"], "pos", "pattern", "payer").collect()}
    assert got == {1: "beta"}


def test_split_list_drops_blanks(spark):
    """An empty duplicate cell never becomes a key."""
    from ledgerlink.operators.links import split_list
    df = spark.createDataFrame([("a.pdf, b.pdf",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(split_list("v")).collect()] == [["a.pdf", "b.pdf"], [], None]


def test_fuzzy_null_name(spark):
    """A null name gives a null match and a null score."""
    from ledgerlink.operators.fuzzy import fuzzy_best
    names = spark.createDataFrame([(1, "blue rod"), (2, None)], "seq int, plan_name string")
    choices = spark.createDataFrame([(1, "Rod Blue"), (2, "red gear")], "seq int, plan string")
    abbr = spark.createDataFrame([], "seq int, abbreviation string, full_form string")
    got = {r["seq"]: (r["best_match"], r["match_score"]) for r in fuzzy_best(spark, names, choices, abbr).collect()}
    assert got == {1: ("Rod Blue", 100.0), 2: (None, None)}


def test_load_first_existing(spark):
    base = tempfile.mkdtemp(prefix="a7-", dir="/tmp")
    report = os.path.join(base, "report")
    IO.write_table(spark.createDataFrame([("h", "a.pdf")], IO.REGISTRY_SCHEMA), report)
    got = IO.load_first_existing(spark, [os.path.join(base, "backup"), report], IO.REGISTRY_SCHEMA)
    assert [tuple(r) for r in got.collect()] == [("h", "a.pdf")]
    empty = IO.load_first_existing(spark, [os.path.join(base, "none")], IO.REGISTRY_SCHEMA)
    assert empty.count() == 0


def test_scan_lines_keeps_blank_lines(spark, tmp_path):
    path = tmp_path / "lat.txt"
    path.write_bytes("één\n\n  \nthird, \"quoted\"\n\xa0x".encode("latin-1"))
    got = [tuple(r) for r in IO.scan_lines(spark, str(path)).orderBy("line_no").collect()]
    assert got == [(1, "één"), (2, ""), (3, "  "), (4, 'third, "quoted"'), (5, "\xa0x")]


def test_scan_lines_over_several_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rng = random.Random(2)
    want, n = [], 0
    for k in range(7):
        lines = [rng.choice(["", " ", "caf\xe9", f"line {i}"]) for i in range(rng.choice([1, 3, 400]))]
        (folder / f"part-{k}.txt").write_bytes("".join(x + "\n" for x in lines).encode("latin-1"))
        for i, x in enumerate(lines, 1):
            n += 1
            want.append((n, x, f"part-{k}.txt", i))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # files of several blocks
        got = [(r["line_no"], r["line"], r["file"].rsplit("/", 1)[1], r["file_line_no"]) for r in IO.scan_lines(spark, str(folder), with_file=True).orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def test_numbers_and_routes(spark, tmp_path):
    from ledgerlink.operators import numbering as N
    rng = random.Random(4)
    values = [rng.randint(0, 50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(6)
    numbered = N.number_rows(df, [F.desc("v"), F.asc("id")])
    order = sorted(((i, v) for i, v in enumerate(values)), key=lambda x: (-x[1], x[0]))
    assert sorted(tuple(r) for r in numbered.collect()) == sorted((i, v, k) for k, (i, v) in enumerate(order, 1))
    assert [tuple(r) for r in N.restored(numbered.repartition(3)).collect()] == order
    assert N.number_rows(df.where("false"), ["v"]).count() == 0
    N.write_routed(numbered, F.when(F.col("v") < 40, F.col("v") % 2 == 0), str(tmp_path / "r"))
    valid, invalid = (N.read_routed(spark, str(tmp_path / "r"), numbered.schema.add("route", "string"), x) for x in ("valid", "invalid"))
    assert {r["id"] for r in valid.collect()} == {i for i, v in enumerate(values) if v < 40 and v % 2 == 0}
    assert valid.count() + invalid.count() == 500  # a null verdict is invalid


def test_exact_profile(spark):
    rows = [(i, None if i % 4 == 0 else f"v{i % 3}", [i % 2], bytearray([i % 5])) for i in range(100)]
    df = spark.createDataFrame(rows, "`a``b'c` int, s string, arr array<int>, bin binary")
    got = {r["column"]: (r["type"], r["rows"], r["non_null"], r["distinct"], r["first"]) for r in IO.profile(df, "a`b'c").collect()}
    assert got == {"a`b'c": ("int", 100, 100, 100, "0"), "s": ("string", 100, 75, 3, None), "arr": ("array<int>", 100, 100, 2, "[0]"), "bin": ("binary", 100, 100, 5, "00")}
    assert [tuple(r)[3:] for r in IO.profile(df.where("false")).collect()] == [(0, 0, 0, None)] * 4
    assert [r["s"] for r in IO.first_rows(df, 2, F.desc("`a``b'c`")).collect()] == ["v0", "v2"]


def test_rules_come_from_a_table(spark):
    from ledgerlink.functions.rules import MOST_RULES, first_rule, rules_of
    table = spark.createDataFrame([
        (2, r"(?i)(\w+) plan", 1, 2, ["free"], None), (1, r"^#(\d+)$", 1, 0, None, "Number {}"), (3, "(?i)plan", 0, 0, [], "Any plan")],
        "priority int, pattern string, group int, longer_than int, stop_words array<string>, label string")
    texts = [("#12",), ("Gold PLAN",), ("Free plan",), ("ab plan",), ("none",), (None,)]
    df = spark.createDataFrame(texts, "t string").select(first_rule("t", rules_of(table)).alias("v"))
    assert [r["v"] for r in df.collect()] == ["Number 12", "Gold", "Any plan", "Any plan", None, None]
    many = spark.range(MOST_RULES + 1).selectExpr("int(id) AS priority", "'x' AS pattern", "0 AS group", "0 AS longer_than", "array('') AS stop_words", "'y' AS label")
    with pytest.raises(ValueError, match="rules"):
        rules_of(many)


def test_parts_beyond_the_columns_are_kept(spark):
    from ledgerlink.operators.records import extra_parts, parse_pipe_table
    df = spark.createDataFrame([("a|b|c|d|e|f| g \nx|y",)], "raw string").select(F.explode(parse_pipe_table("raw", 5)).alias("p"))
    assert [r[0] for r in df.select(extra_parts("p", 5)).collect()] == [["f", "g"], []]
