"""The page job: pages, outcomes, ledger, restart with failing files."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from ledgerlink.operators import pages as P
from ledgerlink.plans import page_plans as PP
from ledgerlink.streaming.page_job import PageJob, rebuilt_ledger

SCHEMA = "array<struct<name:string>>"
DOCS = "document_name string, pages array<struct<text:string,grid:array<array<string>>>>"


def answers(pages):
    """A record for each page; 'bad' pages are cut short, 'none' pages have no answer, 'empty' ones an empty list."""
    word = F.regexp_extract("text", r"^(\w*)", 1)
    raw = F.when(word == "bad", '[{"name": "x"').when(word == "none", F.lit(None).cast("string")).when(word == "empty", "[]").otherwise(F.concat(F.lit('[{"name": "'), word, F.lit('"}]')))
    return pages.select("document_name", "page_no", raw.alias("raw"))


def job(spark):
    return PageJob(spark, tempfile.mkdtemp(prefix="pages-"), SCHEMA, answers)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pages_of_documents(spark):
    docs = spark.createDataFrame([
        ("a.pdf", [("one", None), (" ", None), ("x", [["r1", "Ø2"], ["r3", "r4"]]), ("text", [["only", "row"]]), (None, None)]),
        ("b.c.PDF", [("b", [])]), ("none.pdf", []), ("null.pdf", None)], DOCS)
    pages = P.readable_pages(P.split_pages(docs))
    assert rows(pages) == [("a.pdf", "a_page_1.pdf", 1, "one"), ("a.pdf", "a_page_3.pdf", 3, "r1 | 02\nr3 | r4"), ("a.pdf", "a_page_4.pdf", 4, "text"), ("b.c.PDF", "b.c_page_1.pdf", 1, "b")]


def test_one_parse_feeds_records_and_rejects(spark):
    raw = spark.createDataFrame([("d", 1, '```json\n[{"name": "a"}, {"name": null}]\n```'), ("d", 2, "prose"), ("d", 3, None), ("d", 4, "  "), ("d", 5, "[]"), ("d", 6, '{"name": "alone"}')], "document_name string, page_no int, raw string")
    found = P.outcomes(raw, SCHEMA)
    assert rows(P.records_of(found, ["document_name", "page_no"])) == [("d", 1, 0, "a"), ("d", 1, 1, None)]
    assert rows(P.rejects_of(found, ["page_no"])) == [(2, "unparseable answer"), (3, "no answer"), (4, "no answer"), (6, "unparseable answer")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_counters_are_observed_and_failures_are_not_retried(spark):
    j = job(spark)
    first = spark.createDataFrame([("a", [("x", None), ("bad", None)]), ("b", [("bad", None), ("none", None)]), ("c", None), ("d", [("", None)]), ("e", [("empty", None)])], DOCS)
    assert j.process_batch(first, 0) == {"documents": 5, "failed_documents": 4, "records": 1, "rejected_pages": 3}
    assert rows(j.ledger()) == [("a", "processed", None), ("b", "failed", "no answer"), ("c", "failed", "unreadable"), ("d", "failed", "no pages"), ("e", "failed", "no pages")]
    more = spark.createDataFrame([("a", [("again", None)]), ("c", [("now", None)]), ("f", [("y", None)])], DOCS)
    assert j.process_batch(more, 1) == {"documents": 1, "failed_documents": 0, "records": 1, "rejected_pages": 0}
    assert rows(j.records()) == [("a", 1, 0, "x"), ("f", 1, 0, "y")]


def test_a_replay_gives_the_same_rows_and_a_lost_ledger_is_rebuilt(spark):
    j = job(spark)
    b0 = spark.createDataFrame([("a", [("x", None)]), ("b", [("bad", None)])], DOCS)
    b1 = spark.createDataFrame([("a", [("x2", None)]), ("c", [("y", None)])], DOCS)
    j.process_batch(b0, 0)
    j.process_batch(b1, 1)
    before = rows(j.records()), rows(j.rejects()), rows(j.ledger())
    j.process_batch(b1, 1)  # the batch failed after its writes
    assert (rows(j.records()), rows(j.rejects()), rows(j.ledger())) == before
    shutil.rmtree(j.ledger_path)
    assert rows(j.ledger()) == before[2]
    j.process_batch(spark.createDataFrame([("b", [("fine", None)]), ("g", [("z", None)])], DOCS), 2)
    assert [r[0] for r in rows(j.records())] == ["a", "c", "g"]


def test_an_empty_batch(spark):
    j = job(spark)
    assert j.process_batch(spark.createDataFrame([], DOCS), 0) == {"documents": 0, "failed_documents": 0, "records": 0, "rejected_pages": 0}
    assert rows(j.ledger()) == []


def test_restart_over_a_folder_with_a_failing_file(spark):
    j, inbox = job(spark), tempfile.mkdtemp(prefix="inbox-")

    def put(name, content):
        with open(os.path.join(inbox, name), "wb") as f:
            f.write(content)

    put("a.txt", b"one\ftwo")
    put("poison.txt", b"caf\xe9 \xff\xfe")
    j.run_folder(inbox)
    assert rows(j.ledger()) == [("a.txt", "processed", None), ("poison.txt", "failed", "unreadable")]
    put("b.txt", b"bad\fthree")
    again = PageJob(spark, j.state_dir, SCHEMA, answers)  # another application goes on
    again.run_folder(inbox)
    assert rows(again.records()) == [("a.txt", 1, 0, "one"), ("a.txt", 2, 0, "two"), ("b.txt", 2, 0, "three")]
    assert rows(again.rejects()) == [("b.txt", 1, "unparseable answer")]
    assert rows(again.ledger()) == [("a.txt", "processed", None), ("b.txt", "processed", None), ("poison.txt", "failed", "unreadable")]


def test_registered_rows_tell_the_cases_apart(spark):
    sf = "/root/testdata/sf0.01"
    found = PP.page_outcomes(spark, sf)
    assert {r[0] for r in found.select("reason").distinct().collect()} == {None, "no answer", "unparseable answer"}
    assert {r[0] for r in rebuilt_ledger(found).select("status").distinct().collect()} == {"processed", "failed"}
    pages = PP._pages(spark, sf)
    assert pages.where("text like '% | %'").count() > 0
