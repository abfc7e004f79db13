"""Operators 7 (pairs), 11, 12 and 13 on small tables, against brute force, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlink.llm import auction, divergence, passages, repair, toxicity

DOCS = "doc_id long, text string, lang string, source string, term string, p long, score double, attention string"
WORDS = "river stone bird water bridge village bread market window garden letter friend winter summer morning evening".split()


def docs(spark, rows):
    """(doc_id, text, lang, source), with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, "x", 1, 2.0, "y") for r in rows], DOCS)


# 7 ---------------------------------------------------------------------------------------------------------------

def test_labels_that_only_a_pair_of_terms_tells(spark):
    """Each of two words says nothing alone; the label is whether both or neither stand in the text."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"{rng.choice(WORDS)}{rng.randrange(12)}" for _ in range(25)] + ["zorro"] * a + ["quincy"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(a == b)))
    df = docs(spark, rows)
    machine = toxicity.learn(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(df.select("doc_id", "text"), machine).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i] == bool(labels[i][1]) for i in held]) > 0.95
    assert machine.v.any()


def test_scores_equal_the_formula():
    rng = np.random.default_rng(2)
    place = np.full(1 << toxicity.TERM_BITS, -1, np.int32)
    terms = rng.choice(1 << toxicity.TERM_BITS, 30, replace=False)
    place[terms] = np.arange(30)
    m = toxicity.Machine(0.3, place, rng.normal(size=30), rng.normal(size=(30, toxicity.FACTORS)))
    texts = [sorted(rng.choice(terms, rng.integers(0, 9), replace=False)) + [int((terms.max() + 1) % (1 << toxicity.TERM_BITS))] for _ in range(20)]
    row = np.repeat(np.arange(20), [len(t) for t in texts])
    got = m.scores(row, np.concatenate(texts).astype(np.int64), 20)
    for t, s in zip(texts, got, strict=True):
        at = [place[x] for x in t if place[x] >= 0]
        z = m.bias + sum(m.w[i] for i in at) + sum(m.v[i] @ m.v[j] for k, i in enumerate(at) for j in at[k + 1:])
        assert s == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), rel=1e-9)


# 11 --------------------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, min_docs=30, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, count, groups = defaultdict(set), Counter(), set()
    for k, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in TERM.findall(text or ""):
            t = t.translate(lower)
            seen[lang, t].add(k)
            count[lang, source, t] += 1
    kept = defaultdict(list)
    for (lang, t), ids in seen.items():
        if len(ids) >= min_docs:
            kept[lang].append(t)

    def shares(counts, v):
        total = sum(counts)
        return [1 + 1_000_000_000 * (c + 5) // (total + 5 * v) for c in counts]

    out = []
    for lang in {g[0] for g in groups}:
        terms, own = sorted(kept[lang]), sorted(s for g, s in groups if g == lang)
        p = {s: shares([count[lang, s, t] for t in terms], len(terms)) for s in own}
        q = shares([sum(count[lang, s, t] for s in own) for t in terms], len(terms))
        for s in own:
            pairs = [(sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o) for o in own if o != s]
            excess = [(a - b, t) for a, b, t in zip(p[s], q, terms, strict=True) if a > b and count[lang, s, t]]
            for part, found in (("pair", pairs), ("term", excess)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


def divergence_rows():
    rng = random.Random(11)
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s1", "s2", "é3", None])
        words = [rng.choice(["Stone", "stone", "stone,", "(stone)", "bird-water", "bird", "water!", "Éa", "éa", "x1y", "--", "12", rng.choice(WORDS) + "z"]) for _ in range(rng.randint(0, 12))]
        rows.append((i, rng.choice([" ", "\n", "\t\x0b "]).join(words), lang, source))
    rows += [(None, "stone stone", "en", "s1"), (7, "stone", "en", "s1"), (7, "stone", "en", "s1"), (900, None, "en", "s9"), (901, "", "fr", "s1"), (902, "--- 1", "fr", "s2")]
    rows += [(1000 + i, "rare" + "," * (i % 2) + " Rare." * (i % 3 == 0), "en", f"s{i % 5}") for i in range(30)]  # 30 documents only over variants
    rows += [(1100 + i, "almost" + ",;."[i % 3], "en", "s1") for i in range(29)]  # and 29
    rows += [(2000, ("word " * 30_000) + " stone", "en", "s2"), (2001, "q" * 300_000, "de", "s1")]
    return rows


def test_divergence_against_brute_force(spark):
    rows = divergence_rows()
    df = docs(spark, rows).repartition(5)
    want = brute_divergence(rows)
    assert sorted(tuple(r) for r in divergence.divergence(df).collect()) == want
    old = divergence.SMALL_BYTES, divergence.BLOCK_TERMS, divergence.BLOCK_SOURCES, divergence.PIECE_BYTES
    divergence.SMALL_BYTES, divergence.BLOCK_TERMS, divergence.BLOCK_SOURCES, divergence.PIECE_BYTES = 0, 2, 1, 500  # shuffles, many blocks and pieces
    try:
        assert sorted(tuple(r) for r in divergence.divergence(df).collect()) == want
    finally:
        divergence.SMALL_BYTES, divergence.BLOCK_TERMS, divergence.BLOCK_SOURCES, divergence.PIECE_BYTES = old


def test_terms_kept_by_distinct_documents(spark):
    df = divergence.plain_docs(docs(spark, divergence_rows()).repartition(5))
    found = divergence.occurrences(df)
    terms = divergence.candidates(found)
    kept = {tuple(r) for r in divergence.kept_terms(df, found, terms).collect()}
    assert ("en", "rare") in kept and ("en", "almost") not in kept
    assert terms.where("not sure and term = 'rare'").count() > 0  # no chunk alone tells


def test_divergence_of_empty_tables(spark):
    assert divergence.divergence(docs(spark, [])).count() == 0
    got = sorted(tuple(r) for r in divergence.divergence(docs(spark, [(1, None, None, None), (2, "a", None, "b")])).collect())
    assert got == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


# 12 --------------------------------------------------------------------------------------------------------------

def brute_edits(turns):
    """Least (cost, audit) over the lattice by dynamic programming; turns are (initial, more cost), 'x' has to go."""
    n, best = len(turns), {(0, 0): (0, "")}

    def better(key, value):
        if key not in best or value < best[key]:
            best[key] = value

    def inserts(level):
        for _ in range(4):
            for s in range(4):
                if (level, s) in best:
                    cost, audit = best[level, s]
                    better((level, 3 if s == 2 else 2), (cost + 3, audit + "I"))

    for i, (initial, more) in enumerate(turns):
        inserts(i)
        for s in range(4):
            if (i, s) not in best:
                continue
            cost, audit = best[i, s]
            better((i + 1, s), (cost + 4, audit + "D"))
            if initial != "x":
                better((i + 1, 3 if s == 2 else 2), (cost + 3 + more, audit + "R"))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, s))
                if to is not None:
                    better((i + 1, to), (cost + more, audit + "K"))
    inserts(n)
    return min(best[n, s] for s in (0, 3) if (n, s) in best)


def test_auction_against_dynamic_programming(monkeypatch):
    rng = random.Random(3)
    turns_of = lambda s: [(c.lower(), 3 * c.isupper()) for c in s]
    for leaf in (auction.LEAF, 3):
        monkeypatch.setattr(auction, "LEAF", leaf)
        for _ in range(400):
            s = "".join(rng.choice("uaosUAOSxx") for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 25])))
            assert auction._whole(s) == brute_edits(turns_of(s)), s
    for s in ("ua" * 60, "u" * 100, "x" * 500 + "ua", "suuaxUUas" * 20):
        assert auction.cheapest(s) == brute_edits(turns_of(s))


def test_prices_are_feasible_and_give_the_distance():
    arcs = {0: [("a", 1, 1), ("b", 5, 2)], 1: [("c", 1, 0), ("d", 3, 2)], 2: []}
    price = dict.fromkeys(arcs, 0)
    auction.auction(arcs, 0, 2, price)
    assert price[0] - price[2] == 4
    assert all(price[i] <= cost + price[j] for i, out in arcs.items() for _, cost, j in out)
    assert auction.traced(arcs, 0, 2, price) == (["a", "d"], [0, 1, 2])


def brute_repair(rows):
    convs, blank = defaultdict(list), lambda v: " " if v is None else v
    for c, t, r, x in rows:
        convs[c].append((t, blank(r), blank(x)))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1], hashlib.md5(z[2].encode()).digest()))
        left = []
        for t, r, x in turns:
            hit = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
            x = "" if hit == 1 else re.sub("[.!?]", "", x) if hit == 2 else x
            left += [(t, "user" if hit == 4 else r, x)] * (0 if hit == 0 else 2 if hit == 3 else 1)
        seen, kinds, n = set(), [], Counter()
        for _, r, x in left:
            plain = re.findall(r"[^\x20\x09-\x0D]", x)
            kind = "blank" if not plain else "duplicate" if (r, x) in seen else "truncated" if plain[-1] not in ".!?" else ""
            seen.add((r, x))
            n[kind] += 1
            kinds.append(("x", 0) if kind in ("blank", "duplicate") else (r[:1] or "o", 3 * bool(kind)))
        wrong = sum(a[1][:1] + "|" + b[1][:1] not in ("s|u", "u|a", "a|u") for a, b in zip(left, left[1:], strict=False))
        ts = [t for t, _, _ in left if t is not None]
        cost, audit = brute_edits(kinds)
        lines, last, i = [], "", 0
        for edit in audit:
            role, text = "assistant" if last == "u" else "user", ""
            if edit != "I":
                _, own, text = left[i]
                i += 1
                if edit == "D":
                    continue
                role = own if edit == "K" else role
            lines.append(f"{role}:{text}")
            last = role[0]
        out[c] = (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, n["blank"], n["duplicate"], n["truncated"], wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation_rows():
    rng = random.Random(12)
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.choice([1, 2, 5, 9])):
            if rng.random() < 0.85:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "umpire"])
                rows.append((c, rng.choice([t, t, t, None]), role, rng.choice(["Yes.", "No!", "and then", "", None, " \t\n", "Why?\n", "é…", "ok. \x0b"])))
    rows += [(500, i, "user" if i % 2 == 0 else "assistant", f"turn {i}{'.' * (i % 7 != 0)}") for i in range(700)]  # spans partitions
    rows += [(501, 3, "user", "same.")] * 300 + [(502, t, "user", "ok.") for t in range(200)]
    rows += [(503, 0, "system", "x" * 200_000 + "."), (503, 1, "user", "y. " * 50_000), (503, 2, "assistant", "fine.")]
    rows += [(c, t, "user", "gone.") for c in range(2000, 2400) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    return rows


@pytest.mark.parametrize("partitions", [None, 40])
def test_repair_against_brute_force(spark, tmp_path, partitions):
    rows = conversation_rows()
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, c string, copies int")
    frame.repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    keys = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"} if partitions else {}
    old = {k: spark.conf.get(k, "true") for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = {r[0]: tuple(r[1:]) for r in repair.op12(spark, str(tmp_path)).collect()}
        found = repair.faults(repair.damaged(repair.turns_of(frame)))
        assert not partitions or found.count() > 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = brute_repair(rows)
    assert got.keys() == want.keys()
    assert [k for k in want if want[k] != got[k]] == []
    assert any(v[6] == "" for v in want.values())  # conversations that lost all rows


def test_repaired_turns_alternate(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There?"), (1, 2, "assistant", "Yes"), (2, 0, "assistant", "Alone."), (3, 0, "user", " ")]
    turns = repair.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    solved = repair.edits(repair.faults(turns))
    out = defaultdict(list)
    for r in repair.repaired(turns, solved).orderBy("c", "place").collect():
        out[r["c"]].append((r["edit"], r["role"], r["text"]))
    assert out == {"=1": [("K", "user", "Hi."), ("I", "assistant", ""), ("K", "user", "There?"), ("K", "assistant", "Yes")], "=2": [("I", "user", ""), ("K", "assistant", "Alone.")]}
    assert {r["c"]: r["audit"] for r in solved.collect()} == {"=1": "KIKK", "=2": "IK", "=3": "D"}


def test_repair_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert repair.op12(spark, str(tmp_path)).count() == 0


# 13 --------------------------------------------------------------------------------------------------------------

def passage_model(seed=1):
    rng = np.random.default_rng(seed)
    sizes = {"W": (passages.WIDTH, passages.ENCODED), "b": (passages.ENCODED,), "V": (passages.ENCODED, passages.GATES), "U": (passages.ENCODED, passages.GATES), "w": (passages.GATES,), "c": (passages.ENCODED,), "d": (1,)}
    return passages.Model(0.5, np.zeros(passages.WIDTH), np.ones(passages.WIDTH), {k: rng.normal(0, 0.3, s) for k, s in sizes.items()})


def test_attention_against_plain_loops():
    rng, m = np.random.default_rng(3), passage_model()
    x, row = rng.normal(size=(9, passages.WIDTH)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 2])
    s, a = m.scores(x, row, 3)
    p = m.p
    for doc in range(3):
        h = [np.tanh(p["W"].T @ v + p["b"]) for v in x[row == doc]]
        e = [p["w"] @ (np.tanh(p["V"].T @ v) / (1 + np.exp(-(p["U"].T @ v)))) for v in h]
        weight = np.exp(e) / np.exp(e).sum()
        z = sum(w * v for w, v in zip(weight, h, strict=True))
        assert np.allclose(a[row == doc], weight) and s[doc] == pytest.approx(1 / (1 + np.exp(-(p["c"] @ z + p["d"][0]))))


def test_gradients_against_differences():
    rng, m = np.random.default_rng(5), passage_model(2)
    x, row, y = rng.normal(size=(7, passages.WIDTH)), np.array([0, 0, 1, 1, 1, 2, 3]), np.array([1.0, 0, 0, 1])

    def loss():
        s = m.forward(x, row, 4)["s"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean() + 0.005 * sum((q**2).sum() for q in m.p.values())

    g = passages.gradients(m, x, row, y, 0.01)
    for k, q in m.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in q.shape)
            old = q[at]
            q[at] = old + 1e-5
            up = loss()
            q[at] = old - 1e-5
            down = loss()
            q[at] = old
            assert g[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_features_are_those_of_each_passage(spark):
    texts = ["Plain words here, and more.", "", None, "A " * 200 + "end###", "ÀÉ 12 " * 70]
    row, x = passages.features(pa.array(texts, pa.string()))
    assert np.bincount(row).tolist() == [1, 1, 1, 4, 3]
    for t, own in zip(texts, [x[row == i] for i in range(len(texts))], strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k, passage in enumerate([words[i : i + 64] for i in range(0, len(words), 64)] or [[]]):
            alone = passages.features(pa.array([" ".join(passage)]))[1]
            assert np.allclose(own[k], alone[0])
    assert not x[row == 1].any()


def test_quality_is_learned_from_documents_alone(spark):
    """A bad document has one passage of shouting among good ones; only the document is labelled."""
    rng = random.Random(13)
    good = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        parts = [good(64) for _ in range(rng.randint(1, 5))]
        if bad:
            parts.insert(rng.randrange(len(parts) + 1), " ".join(w.upper() + "!!" for w in good(64).split()))
        rows.append((i, " ".join(parts), "en", "s"))
        labels.append((i, int(not bad)))
    rows += [(None, "river.", "en", "s"), (5, rows[5][1], "en", "s"), (700, None, "en", "s"), (701, "", "en", "s"), (702, "river " * 100_000, "en", "s")]
    df = docs(spark, rows)
    model = passages.learn(df, spark.createDataFrame([*labels, (1, 2), (2, None), (None, 1)], "doc_id long, quality int"))
    out = passages.scored(df, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "term", "p", "score", "attention"]
    got = [(r.doc_id, r.score, r.attention) for r in out.collect()]
    by_id = {i: (s, a) for i, s, a in got}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(by_id[i][0] >= passages.THRESHOLD) == bool(labels[i][1]) for i in held]) > 0.95
    assert len(got) == len(rows) and all(0 <= s <= 1 and abs(sum(a) - 1) < 1e-3 for _, s, a in got)
    assert len({s for i, s, _ in got if i == 5}) == 1 and by_id[700][0] == by_id[701][0] and len(by_id[702][1]) == 1563


def test_quality_without_both_labels(spark):
    df = docs(spark, [(i, "river stone", "en", "s") for i in range(8)])
    one = passages.learn(df, spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int"))
    assert {round(r.score, 6) for r in passages.scored(df, one).collect()} == {round(2 / 3, 6)}  # equal texts are one example
    none = passages.learn(docs(spark, []), spark.createDataFrame([], "doc_id long, quality int"))
    assert passages.scored(docs(spark, []), none).count() == 0 and none.prior == 0.5
