"""Cases that the corpus operators once left out."""

from __future__ import annotations

import random

from ledgerlink.llm import decontaminate, line_dedup, url_reputation

WORDS = "the river runs past old stones while quiet birds watch grey water turn under bridges near villages where people sell bread".split()


def prose(rng, n):
    return [rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n)]


def test_unlabelled_subdomains_are_judged_by_their_domain(spark):
    pages = [(i, f"http://h{i % 12}.bad.org/{i}") for i in range(240)] + [(1000 + i, f"http://h{i % 12}.good.org/{i}") for i in range(240)]
    labels = [(i, 0) for i in range(240)] + [(1000 + i, 1) for i in range(240)]
    pages += [(5000, "http://new.bad.org/"), (5001, "http://new.good.org/"), (5002, "http://unknown.org/"), (5003, "http://a.nowhere/")]
    p = spark.createDataFrame(pages, "page_id long, url string")
    out = {r.page_id: r.verdict for r in url_reputation.judged(p, spark.createDataFrame(labels, "page_id long, good int"), ()).collect()}
    assert out[0] == out[5000] == "block" and out[1000] == out[5001] == "allow"
    of_hosts = p.select("page_id", url_reputation.host_and_path(p.url)[0].alias("host"))
    found = {r.host: r for r in url_reputation.reputations(of_hosts, spark.createDataFrame(labels, "page_id long, good int")).collect()}
    assert len(found) == 28 and found["new.bad.org"].mean < 0.1 < 0.9 < found["new.good.org"].mean
    assert 0.4 < found["unknown.org"].mean < 0.6 and 0.4 < found["a.nowhere"].mean < 0.6


def test_passages_cut_at_an_edge_are_found_at_any_distance(spark):
    rng = random.Random(3)
    items, docs = [], []
    for i in range(40):
        item = prose(rng, rng.choice([25, 39, 53]))
        cut = (len(item) - 4) // 7  # similarity 0.75 at least
        fill = [rng.choice(WORDS)] * 60
        items.append((i, " ".join(item)))
        docs.append((i, " ".join([*fill, *item[cut:]] if i % 2 else [*item[:-cut], *fill])))
    docs += [(100 + i, " ".join(prose(rng, 60))) for i in range(10)]
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.hits(spark.createDataFrame(docs, "doc_id long, text string"), b).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(40)}
    assert all(r.similarity >= 0.75 for r in found) and max(r.distance for r in found) > decontaminate.RADIUS


def test_equal_short_lines_are_copies(spark, tmp_path):
    long = "a line that is long enough to join"
    df = spark.createDataFrame([(1, f"Menu\n{long}\n\nMenu"), (2, f"Menu\nMenus\n{long}s\n"), (3, None), (4, "")], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:6] for r in line_dedup.op4(spark, str(tmp_path)).collect()}
    assert got == {1: (4, 1, 3, 1, 0), 2: (4, 1, 1, 2, 1), 3: (0, 0, 0, 0, 0), 4: (1, 0, 0, 1, 0)}
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(df, short_copies=True).collect()}
    assert left == {1: f"Menu\n{long}\n", 2: "Menus", 3: None, 4: ""}


def test_items_without_or_with_one_id_are_all_found(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(prose(rng, 30)) for _ in range(3))
    items = spark.createDataFrame([(None, a), (7, b), (7, c), (7, c)], "item_id long, text string")
    texts = [(1, "x y " + a), (2, b + " z"), (3, c), (4, b + " and " + c), (5, " ".join(prose(rng, 90))), (None, a), (6, None), (7, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = [(1, None), (2, 7), (3, 7), (4, 7), (4, 7), (None, None)]
    key = lambda r: (str(r[0]), str(r[1]))
    for most in (decontaminate.MOST_BROADCAST, -1):  # anchors too many to send: the words stay behind
        old, decontaminate.MOST_BROADCAST = decontaminate.MOST_BROADCAST, most
        try:
            found = decontaminate.hits(docs, items).collect()
        finally:
            decontaminate.MOST_BROADCAST = old
        assert sorted([(r.doc_id, r.item_id) for r in found], key=key) == sorted(want, key=key)
    left = decontaminate.decontaminated(docs, items)
    assert sorted((str(r.doc_id) for r in left.collect())) == ["5", "6", "7"]


def test_pipeline_stages_with_odd_rows_and_clashing_columns(spark, tmp_path):
    """Null and repeated ids, null and empty texts, and extra columns named like the stages' own."""
    import corpus_pipeline as cp

    rng = random.Random(21)
    rows = [(i, " ".join(prose(rng, 40)) + (" grobble snark" if i % 9 == 0 else ""), "en", "src0") for i in range(180)]
    rows += [(5, " ".join(prose(rng, 40)), "en", "src1"), (5, rows[5][1], "en", "src1"), (None, rows[7][1], "en", None), (None, None, None, None), (200, None, "en", "s"), (201, "", "en", "s"), (202, rows[8][1], "de", "s")]
    extra = {"n_chars": "long", "score": "double", "mix_tokens": "long", "mix_taken": "string", "hit": "string", "_hit": "string", "kept_id": "long", "kept_key": "string", "row_key": "string", "text_key": "string", "node": "string"}
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{k} {v}" for k, v in extra.items())
    df = spark.createDataFrame([(*r, k, 0.5, 1, "t", "h", "g", 2, "k", "r", "x", "n") for k, r in enumerate(rows)], schema)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(180)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[10][1]), (None, rows[11][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in cp.STAGES[:4]:
        step = cp.keep(stage(spark, step, str(tmp_path)), f"odd-{name}")
        assert step.columns == df.columns
        left[name] = [(r.doc_id, r.text, r.score, r.hit) for r in step.collect()]
    of = lambda name: {x[:2] for x in left[name]}
    every = {r[:2] for r in rows}
    assert of("toxicity") == {x for x in every if "grobble" not in (x[1] or "")}
    # one row of those equal in doc_id and text stays, another text of the same doc_id too, and what has no doc_id
    assert of("near_dedup") == of("toxicity") - {(202, rows[8][1])}
    assert sum(x[0] == 5 for x in left["near_dedup"]) == 2 and all(x[2:] == (0.5, "h") for x in left["near_dedup"])
    assert of("decontamination") == of("near_dedup") - {(10, rows[10][1]), (11, rows[11][1])}
    assert of("mixing") <= of("decontamination")
    tokens = cp.STAGES[4][1](spark, step, str(tmp_path))
    assert tokens.count() == step.count()


def test_shares_of_the_mix(spark):
    from ledgerlink.llm import raking

    rng = random.Random(5)
    rows = [(i, " ".join(prose(rng, rng.randint(5, 60))), rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "*": 0.5}, "lang": {"en": 0.7, "de": 0.3}}
    reached = raking.shares_reached(raking.mixed_sample(df, targets), targets).collect()
    assert {(r.dimension, r.value) for r in reached} == {("source", "a"), ("source", "*"), ("lang", "en"), ("lang", "de")}
    assert all(abs(r.expected - r.target) < 1e-6 and abs(r.drawn - r.target) < 0.05 for r in reached)
    bounded = raking.shares_reached(raking.mixed_sample(df, {"source": {"a": 0.99, "*": 0.01}}, most_weight=1.5), {"source": {"a": 0.99, "*": 0.01}})
    assert {r.value: r.expected < 0.985 for r in bounded.collect()}["a"]  # a bound that keeps the target from being met shows


def test_raking_against_plain_loops():
    import numpy as np

    from ledgerlink.llm import raking

    rng = np.random.default_rng(4)
    cells = np.array([(i, j) for i in range(3) for j in range(2)])
    totals, targets = rng.integers(1, 100, 6).astype(float), [np.array([0.2, 0.3, 0.5]), np.array([0.6, 0.4])]
    w = {tuple(c): 1.0 for c in cells.tolist()}
    share = {tuple(c): t / totals.sum() for c, t in zip(cells.tolist(), totals, strict=True)}
    for _ in range(500):
        for d, goal in enumerate(targets):
            for v in range(len(goal)):
                now = sum(share[c] * w[c] for c in w if c[d] == v)
                for c in w:
                    if c[d] == v:
                        w[c] *= goal[v] / now
    assert np.allclose(raking.rake(cells, totals, targets), [w[tuple(c)] for c in cells.tolist()], rtol=1e-6)


def test_ids_with_a_tokenizer_that_keeps_case_and_spaces():
    """The shortcut over words is taken for files that allow it alone; ids equal the library's for any file."""
    import numpy as np
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from ledgerlink.llm import simple8b

    rng = random.Random(9)
    marks = ["", ".", ",", "!!", "###", " |", "\n", "\u00c9", "\u00df", "\u2026", "'s", "\u4e2d", " <|endoftext|>"]
    texts = [" ".join(w.title() * (i % 3 == 0) + w * (i % 3 > 0) + rng.choice(marks) for w in prose(rng, rng.randint(0, 60))) for i in range(200)] + [None, "", " \t\n", "a" * 5000, "\u00e9t\u00e9." * 900]
    for name, by_word in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        ours, library = simple8b.WordIds(path, 1, most=500), Tokenizer.from_file(path)
        assert ours.by_word is by_word
        ids, sizes = ours(pa.array(texts, pa.string()))
        want = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x] and ids.dtype == np.int64


def test_host_reputation_against_its_sql(spark, tmp_path):
    """Hosts without labelled pages under bad, good and unknown domains and suffixes; the SQL judges them as well."""
    import duckdb

    rng = random.Random(6)
    rows, labels = [(None, None), (1, "no scheme"), (2, "http://")], []
    for i in range(900):
        domain, good = rng.choice([("bad.org", 0.05), ("good.org", 0.95), ("mixed.io", 0.6), ("worse.net", 0.1), ("x.dev", 0.5)])
        rows.append((10 + i, f"HTTPS://h{rng.randrange(25)}.{domain}/{rng.choice(['', 'es/', 'p?q=1', 'fr/x#y'])}"))
        if rng.random() < 0.4:
            labels.append((10 + i, int(rng.random() < good), 0))
    rows += [(5000, "http://new.bad.org/"), (5001, "http://new.worse.net/de"), (5002, "http://a.b.unknown/"), (5003, "http://deep.h3.bad.org"), (10, "http://new.bad.org/")]
    labels += [(12, None, 0), (None, 0, 0), (13, 1, 0), (13, 0, 0)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(map(str, (tuple(r) for r in url_reputation.op2(spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == sorted(map(str, con.sql(url_reputation.OP2_SQL).fetchall()))
    assert any("new.bad.org" in x and "block" in x for x in got) and any("good.org" in x and "allow" in x for x in got)


def test_registered_domains_by_a_suffix_table(spark):
    pages = [(i, f"http://s{i % 9}.bad.co.uk/") for i in range(120)] + [(500 + i, f"http://s{i % 9}.good.co.uk/") for i in range(120)] + [(900, "http://new.bad.co.uk/"), (901, "http://new.good.co.uk/"), (902, "http://co.uk/")]
    labels = [(i, 0) for i in range(120)] + [(500 + i, 1) for i in range(120)]
    p, l = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int")
    out = {r.page_id: r.verdict for r in url_reputation.judged(p, l, (), ("co.uk",)).collect()}
    assert out[900] == "block" and out[901] == "allow" and out[902] in ("allow", "block")
    assert url_reputation.judged(p.limit(0), l.limit(0)).count() == 0
