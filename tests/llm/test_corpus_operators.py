"""The corpus operators on small tables, against brute force, with nulls, ties, repeated rows and empty tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from ledgerlink.llm import decontaminate, language_id, line_dedup, mtree, near_dedup, raking, sharding, simple8b, toxicity, url_reputation

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = "the river runs past old stones while quiet birds watch grey water turn under bridges near villages where people sell bread".split()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOCS)


def plain(spark, pairs):
    return docs(spark, [(i, t, "en", "src0") for i, t in pairs])


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# 1 ---------------------------------------------------------------------------------------------------------------

def minimax(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        c, n, held = (low + high) // 2, 1, 0
        for s in sizes:
            n, held = (n, held + s) if held + s <= c else (n + 1, s)
        low, high = (low, c) if n <= shards else (c + 1, high)
    return low


def test_shards_keep_to_the_smallest_capacity(spark):
    rng = random.Random(1)
    for n in (3, 50, 400):
        units = sorted((u, rng.randrange(1, 60)) for u in rng.sample(range(5000), n))
        got = dict(rows_of(sharding.unit_shards(spark.createDataFrame(units, "unit int, bytes long"), 7)))
        assert set(got) == {u for u, _ in units} and set(got.values()) <= set(range(7))
        held = Counter()
        for u, s in units:
            held[got[u]] += s
        if n > 7:
            total, alone = sum(s for _, s in units), 0
            rest = sorted(units, key=lambda x: (-x[1], x[0]))
            while alone < 6 and rest[alone][1] * (7 - alone) >= total:
                total -= rest[alone][1]
                alone += 1
            others = [s for u, s in units if (u, s) not in rest[:alone]]
            assert max(held[k] for k in range(alone, 7)) <= minimax(others, 7 - alone)
            assert [got[u] for u, _ in units if (u, _) not in rest[:alone]] == sorted(got[u] for u, _ in units if (u, _) not in rest[:alone])


def test_shards_of_odd_rows(spark):
    texts = [(1, "a" * 50), (2, "a" * 50), (2, "a" * 50), (None, None), (5, ""), (6, "é" * 20), *[(i, f"text {i}") for i in range(10, 60)]]
    out = sharding.sharded(plain(spark, texts), 5).collect()
    assert len(out) == len(texts)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert len({r.shard for r in out if r.text_crc32 == zlib.crc32(b"a" * 50)}) == 1
    assert {r.size for r in out if r.doc_id is None or r.doc_id == 5} == {16} and next(r.size for r in out if r.doc_id == 6) == 56
    assert sharding.sharded(plain(spark, [])).count() == 0


# 2 ---------------------------------------------------------------------------------------------------------------

def test_reputation_blocks_bad_hosts_and_rules_come_first(spark):
    pages, labels = [], []
    for i in range(400):
        host = ["good.example.org", "bad.example.org", "rare.bad.org"][min(i % 3, 2)]
        pages.append((i, f"http://{host}/x/{i}?q#f"))
        labels.append((i, 1 if i % 3 == 0 or (i % 3 == 2 and i % 2) else 0))
    pages += [(1000, None), (1001, "no scheme"), (1002, "http://WWW.Example.COM/en/a"), (1003, "http://a.example.com/en/"), (1004, "https://b.net/es/x?y"), (1005, "http://bad.example.org?x"), (1005, "http://bad.example.org?x"), (1006, "http://x.com"), (1007, "")]
    p = spark.createDataFrame(pages, "page_id long, url string")
    out = defaultdict(list)
    for r in url_reputation.judged(p, spark.createDataFrame(labels, "page_id long, good int")).collect():
        out[r.page_id].append((r.host, r.path, r.rule, r.verdict))
    assert out[0] == [("good.example.org", "/x/0", None, "allow")] and out[1][0][3] == "block"
    assert out[1000] == out[1001] == out[1007] == [("", "", None, "allow")]
    assert out[1002] == [("www.example.com", "/en/a", "www.example.com/en/", "allow")]
    assert out[1003] == [("a.example.com", "/en/", "example.com/en/", "block")]
    assert out[1004] == [("b.net", "/es/x", "net/es/", "block")]
    assert out[1005] == [("bad.example.org", "", None, "block")] * 2 and out[1006] == [("x.com", "", None, "allow")]
    empty = url_reputation.judged(p.limit(0), spark.createDataFrame([], "page_id long, good int"))
    assert empty.count() == 0


# 3 ---------------------------------------------------------------------------------------------------------------

def test_simple8b_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        for top in (1, 2, 300, 49_407, 1 << 30, 1 << 59, (1 << 64) - 1):
            x = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
            x[rng.random(n) < 0.3] = 0
            assert np.array_equal(simple8b.decode(simple8b.encode(x)), x)
    with pytest.raises(ValueError):
        simple8b.decode(b"none")


def test_token_index_equals_whole_texts(spark):
    from tokenizers import Tokenizer

    texts = [(5, "Don't stop. It's A.B, <|endoftext|> now"), (2, None), (3, ""), (9, "café CAFÉ 12.5, ÉÉ. x"), (9, "again, a."), (None, "no id"), (7, "word " * 60_000), (8, "  \n\t "), (11, "a\x85b\x1cc ǅ ΑΣ İ")]
    t = Tokenizer.from_file(simple8b.vocabulary())
    got = simple8b.token_output(plain(spark, texts), simple8b.vocabulary()).collect()
    want = Counter()
    for i, x in texts:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: -1 if i is None else i)
    assert simple8b.token_output(plain(spark, []), simple8b.vocabulary()).count() == 0


# 4 ---------------------------------------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, s, k):
    s = list(s)
    for _ in range(k):
        at, kind = rng.randrange(len(s)), rng.randrange(3)
        s[at : at + (kind > 0)] = [] if kind == 1 else [rng.choice("abcé")]
    return "".join(s)


def test_banded_distance_and_signatures():
    rng = random.Random(4)
    for edits in (1, 2, 3):
        a = ["".join(rng.choice("abcé") for _ in range(rng.randrange(24, 45))) for _ in range(300)]
        b = [edited(rng, x, rng.randrange(edits + 3)) for x in a]
        want = [min(distance(x, y), edits + 1) for x, y in zip(a, b, strict=True)]
        assert line_dedup.banded_distances(a, b, edits).tolist() == want
        for x, y, d in zip(a, b, want, strict=True):
            if d <= edits:
                assert line_dedup.first_segment(*sorted((x, y), key=len), edits) >= 0


def brute_lines(texts, edits, least):
    lines, place = [], {}
    for i, t in texts:
        for at, x in enumerate((t or "").split("\n") if t is not None else []):
            if len(x) >= least:
                place[x] = min(place.get(x, (i, at)), (i, at))
    lines = list(place)
    root = {x: x for x in lines}
    links = Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, x in enumerate(lines):
        for y in lines[:p]:
            if abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                links[x] += 1
                links[y] += 1
                root[find(x)] = find(y)
    first = {}
    for x in lines:
        first[find(x)] = min(first.get(find(x), place[x]), place[x])
    out = {}
    for i, t in texts:
        all_lines = [] if t is None else t.split("\n")
        firsts = [x for at, x in enumerate(all_lines) if len(x) >= least and place[x] == (i, at)]
        leading = [x for x in firsts if first[find(x)] == place[x]]
        n_long = sum(len(x) >= least for x in all_lines)
        out[i] = (len(all_lines), n_long, len(all_lines) - n_long + len(leading), n_long - len(firsts), len(firsts) - len(leading), sum(links[x] for x in firsts))
    return out


def test_line_report_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PART_LINES", 4)  # groups are dealt into many parts
    rng = random.Random(5)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(20, 60))) for _ in range(25)]
    texts = [(i, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) if rng.random() < 0.8 else rng.choice(["", "short", base[0]]) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "x" * 1_500 + "\n" + "x" * 1_499)]
    want = brute_lines(texts, 2, 20)
    df = plain(spark, texts)
    got = {r[0]: tuple(r)[1:] for r in line_dedup.line_report(df).collect()}
    assert got == want
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(df).collect()}
    assert left[100] is None and all((0 if t is None else len([x for x in t.split("\n")])) in (want[i][2], max(want[i][2], 1)) for i, t in left.items() if t is not None)
    twice = plain(spark, [(1, "a line that is long enough"), (1, "a line that is long enough"), (None, "another one that is long enough")])
    assert sorted(r.n_kept for r in line_dedup.line_report(twice).collect()) == [1, 1, 1]
    assert line_dedup.line_report(plain(spark, [])).count() == 0


# 5 ---------------------------------------------------------------------------------------------------------------

def test_raking_meets_the_targets(spark):
    rng = random.Random(6)
    data = [(i, prose(rng, rng.randrange(5, 60)) + (" a | b" if rng.random() < 0.2 else ""), rng.choice(["en", "de", "fr", "es", None]), "src0" if rng.random() < 0.4 else f"src{rng.randrange(1, 5)}") for i in range(3000)]
    data += [(5000, None, None, None), (5001, "", "en", "src0"), (5001, "", "en", "src0")]
    out = raking.mixed_sample(docs(spark, data)).toPandas()
    assert len(out) == len(data) and out["mix_probability"].between(0, 1).all() and out["mix_probability"].max() == 1
    total = (out["mix_probability"] * out["mix_tokens"]).sum()
    for d, goals in raking.TARGETS.items():
        for value, share in goals.items():
            part = out[out[f"mix_{d}"] == value]
            assert abs((part["mix_probability"] * part["mix_tokens"]).sum() / total - share) < 1e-6
            assert abs(part[part["mix_taken"]]["mix_tokens"].sum() / out[out["mix_taken"]]["mix_tokens"].sum() - share) < 0.05
    assert raking.mix(docs(spark, data)).columns == [f.name for f in DOCS]
    assert raking.mixed_sample(docs(spark, [])).count() == 0


# 6 ---------------------------------------------------------------------------------------------------------------

def test_language_of_held_out_texts(spark):
    rng = random.Random(7)
    sounds = {"aa": ["ka", "lo", "mi", "te"], "bb": ["schu", "ver", "ung", "ö"], "cc": ["eau", "tion", "é", "qu"]}
    data = []
    for i in range(240):
        lang = ["aa", "bb", "cc"][i % 3]
        data.append((i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(4, 40))), lang, "s"))
    data += [(900, None, "aa", "s"), (901, "", "bb", "s"), (902, "12 .. !", "cc", "s"), (903, "kalo " * 50_000, None, "s"), (None, "schuver ung", "bb", "s")]
    df = docs(spark, data)
    trees = language_id.learn(df)
    out = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language_id.identified(df, trees).collect()}
    assert all(out[i, t][0] == lang for i, t, lang, _ in data if i is not None and i < 900)
    assert out[900, None] == ("und", 0) and out[901, ""] == ("und", 0) and out[902, "12 .. !"] == ("und", 0)
    assert out[903, "kalo " * 50_000][0] == "aa" and out[None, "schuver ung"][0] == "bb"
    assert all(0 <= s <= 1 for _, s in out.values())
    # probabilities of all symbols in a context sum to one, and windows change nothing
    table = 2.0 ** -trees.bits.astype(float).reshape(3, -1, trees.kinds)
    assert np.allclose(table.sum(axis=2), 1, atol=1e-3)
    data = np.frombuffer("kalo schuver\nkalo".encode(), np.uint8)
    assert np.allclose(trees.lengths(data, np.array([0, 4, 4])), trees.lengths(data, np.array([0, 4, 4]), window=3))
    assert language_id.identified(df, language_id.learn(docs(spark, []))).where("lang_pred <> 'und'").count() == 0


# 7 ---------------------------------------------------------------------------------------------------------------

def test_toxic_documents_are_found(spark):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        words = prose(rng, rng.randrange(20, 200)).split()
        for _ in range(2 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Blorgh,", "frumpel", "zwackiest"]))
        data.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    data += [(900, None), (901, ""), (902, "BLORGH! frumpel. " + "word " * 40_000)]
    df, labelled = plain(spark, data), spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (901, 1, None)], "doc_id long, quality int, toxic int")
    machine = toxicity.learn(df, labelled)
    out = {r.doc_id: r.score for r in toxicity.scored(df, machine).collect()}
    assert all((out[i] >= 0.5) == (i % 6 == 0) for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0)
    assert out[900] == out[901] < 0.5 <= out[902]
    none = toxicity.learn(plain(spark, []), labelled.limit(0))
    assert toxicity.scored(df, none).where("score >= 0.5").count() == 0 and toxicity.scored(plain(spark, []), machine).count() == 0


def test_pairs_of_terms_count():
    """An insult alone and a group alone are harmless, both together are not."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2, (400, 2))
    row, term = np.nonzero(x)
    machine = toxicity.fit(row, term, (x.sum(axis=1) == 2).astype(float))
    s = machine.scores(np.array([0, 0, 1, 2]), np.array([0, 1, 0, 1]), 4)
    assert s[0] > 0.5 > max(s[1:])


# 8 ---------------------------------------------------------------------------------------------------------------

def test_benchmark_items_are_found_whole_and_nearly(spark):
    rng = random.Random(10)
    items = [(i, prose(rng, n)) for i, n in enumerate([40, 25, 60])] + [(3, "zeta yotta quark"), (4, "xylofon"), (5, prose(rng, 40)), (6, None), (7, " .. "), (8, "one two three four five six seven"), (8, "one two three four five six seven")]
    def near(text, at):
        w = text.split()
        w[at] = "changed"
        return " ".join(w)
    clean = [(100 + i, prose(rng, 80)) for i in range(20)]
    hidden = [(1, prose(rng, 30) + " " + items[0][1].upper() + ". " + prose(rng, 30)), (2, near(items[2][1], 30) + " " + prose(rng, 500)), (3, items[1][1]), (4, prose(rng, 9) + " " + items[3][1] + " " + prose(rng, 9)), (5, items[4][1]), (None, items[5][1] + " x")]
    broken = [(200, " ".join(items[0][1].split()[:20]) + " " + prose(rng, 40))]
    df = plain(spark, clean + hidden + hidden[:1] + broken + [(300, None), (301, ""), (302, "w " * 60_000)])
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.hits(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(found) == {(1, 0), (2, 2), (3, 1), (4, 3), (5, 4), (None, 5)}
    assert found[1, 0] == 1 and 0.75 <= found[2, 2] < 1
    left = decontaminate.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {i for i, _ in clean} | {200, 300, 301, 302} and left.columns == df.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(df, none).count() == 0 and decontaminate.hits(plain(spark, []), none).count() == 0


# 9 ---------------------------------------------------------------------------------------------------------------

def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def test_near_classes_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PART_MEMBERS", 5)
    rng = random.Random(11)
    bases = [prose(rng, rng.choice([3, 6, 12, 60, 300])).split() for _ in range(25)]
    texts = []
    for i in range(300):
        w = list(bases[min(int(rng.expovariate(0.3)), 24)])
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
        texts.append((i, (" " if rng.random() < 0.9 else "\n ").join(x.upper() if rng.random() < 0.02 else x for x in w)))
    texts += [(400, None), (401, ""), (402, " \t\n"), (403, "ÉA é"), (404, "éa é"), (405, "w " * 50_000), (406, "w " * 50_003)]
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[:p]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_classes(plain(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_classes_of_odd_rows(spark):
    out = rows_of(near_dedup.near_classes(plain(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (3, "other words here"), (2, "A B  c d e f")])))
    assert sorted(out, key=str) == sorted([(None, 2, None, True), (3, 2, 2, False), (3, 2, 2, False), (3, 1, 3, True), (2, 2, 2, True)], key=str)
    assert near_dedup.near_classes(plain(spark, [])).count() == 0


# 10 --------------------------------------------------------------------------------------------------------------

def test_top_products_against_all_pairs(spark, monkeypatch):
    for name, value in (("TREE", 40), ("PAGE", 8), ("QUERIES", 3)):
        monkeypatch.setattr(mtree, name, value)
    rng = np.random.default_rng(12)
    vectors = rng.normal(size=(300, 6)).astype(np.float32)
    vectors[40:140] = vectors[40]  # a third are alike
    data = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    data += [(1000, None), (1001, [None] * 6), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6), (None, [9.0] * 6), (1050, [1.0, 2.0]), (1051, []), data[0]]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in mtree.top_inner_products(df, every=50).collect())
    whole = [(i, np.floor(256 * np.array(list(v) + [0.0] * (6 - len(v)))).astype(np.int64)) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (q, v) in enumerate(whole):  # rows that repeat a vec_id are each a query, and candidates for the others
        if q % 50 == 0:
            best = sorted(((int(v @ w), i) for b, (i, w) in enumerate(whole) if a != b), key=lambda x: (-x[0], x[1]))[:5]
            want += [(q, n, i, s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)
    assert any(q == i == 0 for q, _, i, _ in got)  # the row that repeats id 0
    two = spark.createDataFrame([(50, [1.0]), (7, [1.0]), (7, [3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in mtree.top_inner_products(two).orderBy("rank").collect()] == [(50, 1, 7, 196608), (50, 2, 7, 65536)]
    assert mtree.top_inner_products(df.limit(0)).count() == 0
    assert mtree.top_inner_products(df.where("vec_id in (50, 7)")).count() == 1


def test_top_products_send_a_query_once_for_a_group_of_trees(spark, monkeypatch):
    for name, value in (("TREE", 20), ("PAGE", 8), ("CELLS", 2)):
        monkeypatch.setattr(mtree, name, value, raising=False)
    sent, keep = [], mtree.keep
    monkeypatch.setattr(mtree, "keep", lambda df, what: (out := keep(df, what), sent.append((what, out.count())))[0])
    vectors = np.random.default_rng(3).normal(size=(600, 5)).round(2)
    vectors /= 64 * np.abs(vectors).max()  # close to each other: no tree can be left out
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in mtree.top_inner_products(df).collect())
    w = np.floor(256 * vectors).astype(np.int64)
    want = [(q, n, i, s) for q in range(0, 600, 50) for n, (s, i) in enumerate(sorted(((int(w[q] @ w[i]), i) for i in range(600) if i != q), key=lambda x: (-x[0], x[1]))[:5], 1)]
    assert got == want
    assert dict(sent)["m-trees"] > 20
    assert max(n for what, n in sent if what == "asked") <= 12 * 3  # not once for each tree


# pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(13)
    item = prose(rng, 40)
    data, labels = [], []
    for i in range(300):
        bad = i % 10 == 0
        data.append((i, prose(rng, 60) + (" blorgh frumpel" if bad else ""), rng.choice(["en", "de", "fr"]), rng.choice(["src0", "src1"])))
        labels.append((i, 1, int(bad)))
    data += [(400, data[1][1], "en", "src0"), (401, prose(rng, 10) + " " + item, "en", "src0"), (402, None, None, None), (403, "", "en", "src1")]
    d = str(tmp_path)
    docs(spark, data).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    step = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for _, stage in cp.STAGES:
        step = cp.keep(stage(spark, step, d), "test-stage")
        kept.append({r.doc_id for r in step.collect()})
        assert step.columns == [f.name for f in DOCS] or "ids_crc32" in step.columns
    everyone = {i for i, *_ in data}
    assert kept[0] == everyone - {i for i in range(0, 300, 10)}
    assert kept[1] == kept[0] - {400} and kept[2] == kept[1] - {401}
    assert kept[3] <= kept[2] and kept[4] == kept[3] and len(kept[3]) > 20
