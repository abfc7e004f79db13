"""K1 streaming dedup over real files, replay idempotence, K2 and K3."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerlink.operators import dedup as D
from ledgerlink.streaming.incremental import DocumentFields, IncrementalDedup, pending
from ledgerlink.operators.ordered import doc_backfill
from conftest import SF_SMALL


def _write_files(folder, rows):
    for name, text in rows:
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(text.encode("utf-8"))


def test_stream_two_runs_equal_one_batch(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(120).collect()
    rows = [(f"doc_{r['doc_id']:04d}.PDF", r["text"]) for r in docs]
    # exact copies across the two runs and inside each run
    rows += [(f"doc_{9000 + i:04d}.pdf", rows[i][1]) for i in range(0, 120, 7)]
    base = tempfile.mkdtemp(prefix="k1-", dir="/tmp")
    inbox, state = os.path.join(base, "in"), os.path.join(base, "state")
    os.makedirs(inbox)
    half = len(rows) // 2
    dd = IncrementalDedup(spark, state, order_cols=("file_name",))
    _write_files(inbox, rows[:half])
    dd.run_folder(inbox, max_files_per_trigger=25)
    _write_files(inbox, rows[half:])
    dd.run_folder(inbox, max_files_per_trigger=25)
    got = {(r["file_name"], r["original"], r["status"]) for r in dd.results().collect()}
    assert len(got) == len(rows)
    # batch reference: each file's original is the first file (by arrival run,
    # then name) with the same content
    files = spark.createDataFrame(rows, "file_name string, content string")
    h = D.hash_files(files)
    first_run = {n for n, _ in rows[:half]}
    by_hash = {}
    for r in sorted(h.collect(), key=lambda r: (r["file_name"] not in first_run, r["file_name"])):
        by_hash.setdefault(r["content_hash"], r["file_name"])
    want = {(r["file_name"], by_hash[r["content_hash"]]) for r in h.collect()}
    assert {(a, b) for a, b, _ in got} == want


def test_replayed_batch_is_idempotent(spark):
    state = tempfile.mkdtemp(prefix="k1r-", dir="/tmp")
    dd = IncrementalDedup(spark, state, order_cols=("file_name",))
    x = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "one")], "file_name string, content string")
    y = spark.createDataFrame([("d", "two"), ("e", "three"), ("f", "three")], "file_name string, content string")
    dd.process_batch(x, 0)
    dd.process_batch(y, 1)
    snap = lambda: (sorted(tuple(r) for r in dd.registry().collect()),
                    sorted(tuple(r) for r in dd.results().collect()))
    first = snap()
    dd.process_batch(y, 1)          # foreachBatch may run a batch again after a failure
    assert snap() == first
    st = {r["file_name"]: (r["original"], r["status"]) for r in dd.results().collect()}
    assert st["c"] == ("a", "duplicate") and st["d"] == ("b", "duplicate")
    assert st["e"] == ("e", "new") and st["f"] == ("e", "duplicate")


def test_pending(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "doc string")
    done = spark.createDataFrame([("y",)], "doc string")
    assert sorted(r["doc"] for r in pending(a, done, "doc").collect()) == ["x", "z"]


ROW = "doc string, page_no int, seq int, f string, g string"


def _field_batches(spark):
    rows = [[("d1", 2, 1, "X", ""), ("d2", 1, 1, "", "g2"), (None, 1, 1, "lost", "")],
            [("d1", 1, 2, "W", None), ("d2", 3, 2, " Z ", "late"), ("d3", None, 1, "n", "")],
            [("d3", 9, 5, "paged", ""), ("d4", 1, 1, None, None)]]
    return [spark.createDataFrame(r, ROW) for r in rows]


def test_document_fields_over_batches_equal_a_full_recompute(spark):
    state = DocumentFields(spark, tempfile.mkdtemp(prefix="k3-", dir="/tmp"), "doc", ["f", "g"], n_buckets=8)
    seen = None
    for i, batch in enumerate(_field_batches(spark)):
        state.add(batch, i)
        if i == 1:
            state.add(batch, i)  # a replay
        seen = batch if seen is None else seen.unionByName(batch)
        full = sorted(map(str, doc_backfill(seen, "doc", ["f", "g"]).collect()))
        assert sorted(map(str, state.rows().collect())) == full
        touched = {r["doc"] for r in batch.collect()} - {None}
        want = {(r["doc"], r["f"], r["g"]) for r in doc_backfill(seen, "doc", ["f", "g"]).collect() if r["doc"] in touched}
        assert {tuple(r) for r in state.values(i).collect()} == want
    state.compact()
    state.compact()
    assert sorted(map(str, state.rows().collect())) == full
    state.add(spark.createDataFrame([("d4", 1, 2, "new", None)], ROW), 3)
    assert {tuple(r) for r in state.values(3).collect()} == {("d4", "new", "")}


def test_document_fields_read_the_batch_and_its_buckets_alone(spark):
    state = DocumentFields(spark, tempfile.mkdtemp(prefix="k3r-", dir="/tmp"), "doc", ["f"], n_buckets=32)
    many = spark.range(2000).selectExpr("concat('doc', id) AS doc", "1 AS page_no", "1 AS seq", "concat('v', id) AS f", "'' AS g")
    state.add(many, 0)
    state.add(spark.createDataFrame([("doc7", 0, 1, "first", "")], ROW), 1)
    got = state.values(1)
    assert [tuple(r) for r in got.collect()] == [("doc7", "first")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan and "/rows" not in plan
    read = got._jdf.queryExecution().toRdd().count() and state._partials().where(F.col("bucket").isin([r[0] for r in spark.read.parquet(f"{state.partials_path}/batch_id=1").select("bucket").collect()])).count()
    assert read < 200  # of 2,000 documents


def test_new_application_goes_on_where_the_last_ended(spark):
    """The stream's checkpoint lies beside the state, not in a folder of one application."""
    base = tempfile.mkdtemp(prefix="k1s-", dir="/tmp")
    inbox, state = os.path.join(base, "in"), os.path.join(base, "state")
    os.makedirs(inbox)
    _write_files(inbox, [("a.pdf", "one"), ("b.pdf", "two")])
    IncrementalDedup(spark, state, order_cols=("file_name",)).run_folder(inbox)
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(os.path.join(base, "other"))  # as a later application's
    try:
        os.unlink(os.path.join(inbox, "a.pdf"))
        _write_files(inbox, [("c.pdf", "one")])
        again = IncrementalDedup(spark, state, order_cols=("file_name",))
        again.run_folder(inbox)
        got = {r["file_name"]: (r["original"], r["status"]) for r in again.results().collect()}
    finally:
        spark.sparkContext.setCheckpointDir(before)
    assert set(got) == {"a.pdf", "b.pdf", "c.pdf"} and got["c.pdf"][0] == "a.pdf" and got["c.pdf"][1] != got["a.pdf"][1]
