"""Hand-worked rows from FIXTURES.md and the reference-defect decisions (D-items)."""

from pyspark.sql import functions as F

from ledgerlink.functions import keys as K
from ledgerlink.functions import lookup as LK
from ledgerlink.functions import text as T
from ledgerlink.operators.records import parse_pipe_table, parse_records, extraction_status


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("o")).first()["o"]


def test_parse_bpg(spark):
    r = one(spark, K.parse_bpg, "012345~NULL~ABC")
    assert (r["bin"], r["pcn"], r["grp"]) == ("012345", None, "ABC")


def test_is_valid_bpg(spark):
    assert [one(spark, K.is_valid_bpg, v) for v in ("1~2", "1~2~3", "1~2~3~4")] == [False, True, False]


def test_format_bin(spark):
    got = [one(spark, K.format_bin, v) for v in ("4336.0", "12", None, "1234567")]
    assert got == ["004336", "000012", None, "1234567"]


def test_split_cell(spark):
    assert one(spark, T.split_cell, "100200/300400") == ["100200", "300400"]
    assert one(spark, T.split_cell, "ABC (note) D") == ["ABC", "D"]
    assert one(spark, T.split_cell, "A or B") == ["A"]
    assert one(spark, T.split_cell, "OR") == []
    # Parentheses are removed before the "or" cut
    assert one(spark, T.split_cell, "ABC (or as on card)") == ["ABC"]
    assert one(spark, T.split_cell, None) == []


def test_blank_symbols(spark):
    # The intended symbol set, no crash on a reversed range
    assert [one(spark, T.blank_symbols, v) for v in ("##", "a#", "-:", "\\&")] == ["", "a#", "", ""]


def test_clean_name(spark):
    assert one(spark, T.clean_name, "Gold (HMO) Plan-1") == "gold plan1"


def test_extract_date(spark):
    assert one(spark, LK.extract_date, "due 13/40/2024 and 2/3/2024") == "February 3, 2024"
    assert one(spark, LK.extract_date, "as of march 5, 2021") == "march 5, 2021"
    assert one(spark, LK.extract_date, "on 7 June 2020") == "June 7, 2020"
    assert one(spark, LK.extract_date, "rev 2019-04-09") == "April 09, 2019"
    assert one(spark, LK.extract_date, "nothing") == "Not Found"


def test_plan_name_from_title(spark):
    f = lambda c: LK.plan_name_from_title(c, LK.title_rules([("acme", "Acme Rx")]))
    assert one(spark, f, "Blue Star Formulary 2024") == "Blue Star"
    assert one(spark, f, "Download Formulary") == "Not Found"
    assert one(spark, f, "the acme list") == "Acme Rx"
    assert one(spark, f, "Ohio Medicaid plans") == "Ohio Medicaid"


def test_normalize_channel(spark):
    kw = [("small group", "Small Group"), ("group", "Group")]
    f = lambda c: LK.normalize_channel(c, kw)
    assert [one(spark, f, v) for v in (" Small Group plan", "group", "retail", "", None)] == \
        ["Small Group", "Group", "retail", "", ""]


def test_compose_query(spark):
    df = spark.createDataFrame([("1", None, "g")], "b string, p string, g string")
    assert df.select(LK.compose_query("b", "p", "g")).first()[0] == "BIN 1  GroupID g filetype:pdf"


def test_parse_records_rejects(spark):
    schema = "array<struct<bin:string>>"
    f = lambda c: parse_records(c, schema)
    assert one(spark, f, '```json\n[{"bin": "1"}]\n```')[0]["bin"] == "1"
    assert one(spark, f, 'noise [{"bin": "2"}] tail')[0]["bin"] == "2"
    assert one(spark, f, '{"bin": "3"}') is None          # a lone object is not a list
    assert one(spark, f, '[{"bin": "4"') is None          # cut short


def test_parse_pipe_and_status(spark):
    rows = one(spark, lambda c: parse_pipe_table(c, 5), "a | b\nno pipe\n x|y|z|w ")
    assert rows == [["a", "b", "", "", "", ""], ["x", "y", "z", "w", "", ""]]
    df = spark.createDataFrame([("a", "b", "c", "d"), ("a", "", None, ""), ("", " ", None, "")], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(extraction_status("a", "b", "c", "d")).collect()] == ["success", "partial", "none"]


def test_looks_like_table(spark):
    assert one(spark, T.looks_like_table, "x\n610415 PCS\ny") is True
    assert one(spark, T.looks_like_table, "plain text") is False


def test_page_number_and_grid(spark):
    assert one(spark, T.page_number_from_name, "doc_page_12.pdf") == 12
    assert one(spark, T.page_number_from_name, "doc.pdf") == -1
    df = spark.createDataFrame([("t", [["a", "b"], ["c", "d"]]), ("t2", [["x"]])], "text string, grid array<array<string>>")
    assert [r[0] for r in df.select(T.page_text("text", "grid")).collect()] == ["a | b\nc | d", "t2"]


def test_normalize_channel_word_mode(spark):
    kw = [("ppo", "PPO"), ("group", "Group")]
    sub = lambda c: LK.normalize_channel(c, kw)
    word = lambda c: LK.normalize_channel(c, kw, mode="word")
    # Substring mode finds 'ppo' inside 'support'; word mode does not
    assert one(spark, sub, "Support group") == "PPO"
    assert one(spark, word, "Support group") == "Group"
