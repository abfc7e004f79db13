"""Document quality by attention-based multiple-instance learning (operator 13).

A document is a bag of passages of PASSAGE_WORDS words.  ``features`` describes each passage by shares (letters, capitals,
digits, marks, repeats, line ends, word lengths) and signed hashes of its words' shapes and of its words.  The model encodes
each passage, weighs it by gated attention and scores the weighted mean:

    h_k = tanh(W x_k + b)      a_k = softmax_k( w . (tanh(V h_k) * sigmoid(U h_k)) )      score = sigmoid(c . sum_k a_k h_k + d)

Only documents have labels; which passages count is learned from them.  The model is fitted on a bounded sample:
MOST_LABELLED labelled rows by a hash of the doc_id, of each MOST_PASSAGES evenly spaced passages; scoring reads all
passages of every whole text.

Null and empty texts are one passage without words.  Rows that repeat are scored alike, and in the sample equal texts are
one example, of the lowest of their labels, as is a doc_id with contrary labels.  Labels other than 0 and 1 and null
doc_ids are not learned from.  Without rows of both labels the score is the smoothed share of label 1.  An empty table
gives no rows.  Of columns named like the new ones the new ones stay.  Ties at the threshold count as reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import bounded_batches, pieces, read, word_lists

PASSAGE_WORDS = 64
HASHED = 48
ENCODED, GATES = 24, 12
MOST_LABELLED = 12_000
MOST_PASSAGES = 64
THRESHOLD = 0.7

#: Shares of a passage's words that match.
WORD_SIGNS = [r"[.!?]$", r"[,;:]$", r"[^\p{L}\p{N}.,;:!?]$", r"^[^\p{L}\p{N}]+$", r"^\p{Lu}+\P{L}*$", r"^\p{Lu}\p{Ll}*", r"(.)[!?*#$%&]{2,}$", r"^\p{L}$"]
#: Shares of its characters.
CHAR_SIGNS = [r"\p{L}", r"\p{Lu}", r"\p{N}", r"[\x80-\x{10FFFF}]"]
SHARES = len(WORD_SIGNS) + len(CHAR_SIGNS) + 6
WIDTH = SHARES + HASHED


def _hashed(words: pa.Array, salt: str) -> tuple[np.ndarray, np.ndarray]:
    h = np.fromiter((xxhash.xxh3_64_intdigest(salt + w) for w in words.to_pylist()), np.uint64, len(words))
    return (h % np.uint64(HASHED)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each passage its row and its WIDTH features; a text without words has one passage of zeros."""
    words, counts = word_lists(texts)
    of_row = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    row = np.repeat(np.arange(len(counts)), of_row)
    x = np.zeros((len(row), WIDTH))
    if not len(words):
        return row, x
    coded = words.dictionary_encode()
    code, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = np.repeat(np.cumsum(of_row) - of_row, counts) + place // PASSAGE_WORDS
    n = np.bincount(passage, minlength=len(row)).astype(float)
    some = np.maximum(n, 1)
    length = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(float)
    chars = np.maximum(np.bincount(passage, length[code], len(row)), 1)
    for k, sign in enumerate(WORD_SIGNS):
        match = pc.match_substring_regex(distinct, sign).to_numpy(zero_copy_only=False).astype(float)
        x[:, k] = np.bincount(passage, match[code], len(row)) / some
    for k, sign in enumerate(CHAR_SIGNS, len(WORD_SIGNS)):
        match = pc.count_substring_regex(distinct, sign).to_numpy(zero_copy_only=False).astype(float)
        x[:, k] = np.bincount(passage, match[code], len(row)) / chars
    k = len(WORD_SIGNS) + len(CHAR_SIGNS)
    key, times = np.unique(passage * len(distinct) + code, return_counts=True)
    kinds = np.bincount(key // len(distinct), minlength=len(row))
    most = np.zeros(len(row))
    np.maximum.at(most, key // len(distinct), times)
    again = np.zeros(len(words))
    again[1:] = (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])
    x[:, k] = kinds / some
    x[:, k + 1] = most / some
    x[:, k + 2] = np.bincount(passage, again, len(row)) / some
    x[:, k + 3] = np.log1p(chars / some)
    x[:, k + 4] = np.sqrt(np.maximum(np.bincount(passage, (length**2)[code], len(row)) / some - (chars / some) ** 2, 0)) / 10
    x[:, k + 5] = n / PASSAGE_WORDS
    shape = pc.replace_substring_regex(distinct, r"\p{Lu}+", "A")
    shape = pc.replace_substring_regex(pc.replace_substring_regex(shape, r"\p{Ll}+", "a"), r"\p{N}+", "0")
    for of, salt in ((shape, "s"), (pc.utf8_lower(distinct), "w")):
        kind = of.dictionary_encode()
        bucket, sign = _hashed(kind.dictionary, salt)
        at = kind.indices.to_numpy(zero_copy_only=False)[code]
        x[:, SHARES:] += (np.bincount(passage * HASHED + bucket[at], sign[at], len(row) * HASHED)).reshape(len(row), HASHED) / some[:, None]
    x[n == 0] = 0
    return row, x


@dataclass
class Model:
    prior: float
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    p: dict[str, np.ndarray] = field(default_factory=dict)  # empty: the prior alone

    def forward(self, x: np.ndarray, row: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """Rows are numbered from 0 in order, each with one passage at least."""
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        start = np.searchsorted(row, np.arange(n))
        a = np.exp(e - np.maximum.reduceat(e, start)[row])
        a /= np.add.reduceat(a, start)[row]
        z = np.add.reduceat(a[:, None] * h, start, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -40, 40)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s, "start": start}

    def scores(self, x: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Score of each row, attention of each passage."""
        if not self.p:
            return np.full(n, self.prior), 1 / np.bincount(row, minlength=n)[row]
        f = self.forward((x - self.centre) / self.scale, row, n)
        return f["s"], f["a"]


def gradients(model: Model, x: np.ndarray, row: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
    """Of the mean log loss of the rows, and decay * |parameter|^2 / 2."""
    p, f = model.p, model.forward(x, row, len(y))
    ds = (f["s"] - y) / len(y)
    dz = ds[:, None] * p["c"]
    da = (dz[row] * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["start"])[row])
    dtg = de[:, None] * p["w"]
    dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = (f["a"][:, None] * dz[row] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
    out = {"W": x.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": ((f["t"] * f["g"]) * de[:, None]).sum(axis=0), "c": f["z"].T @ ds, "d": np.array([ds.sum()])}
    return {k: g + decay * p[k] for k, g in out.items()}


def fit(x: np.ndarray, row: np.ndarray, y: np.ndarray, steps: int = 900, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 13) -> Model:
    """Adam over shuffled batches of documents.  Passages come in the order of their rows, numbered from 0."""
    prior = float((y.sum() + 1) / (len(y) + 2))
    if not len(y) or y.min() == y.max():
        return Model(prior)
    rng = np.random.default_rng(seed)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - centre) / scale
    normal = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    p = {"W": normal(x.shape[1], ENCODED), "b": np.zeros(ENCODED), "V": normal(ENCODED, GATES), "U": normal(ENCODED, GATES), "w": normal(GATES), "c": normal(ENCODED), "d": np.array([np.log(prior / (1 - prior))])}
    model = Model(prior, centre, scale, p)
    m, v = {k: np.zeros_like(q) for k, q in p.items()}, {k: np.zeros_like(q) for k, q in p.items()}
    start, size = np.searchsorted(row, np.arange(len(y))), np.bincount(row, minlength=len(y))
    order, at = rng.permutation(len(y)), 0
    for t in range(1, steps + 1):
        if at >= len(y):
            order, at = rng.permutation(len(y)), 0
        docs = order[at : at + batch]
        at += batch
        own = size[docs]
        where = np.repeat(start[docs] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        slow = rate * min(1.0, 2 * (1 - t / (steps + 1)))
        for k, g in gradients(model, x[where], np.repeat(np.arange(len(docs)), own), y[docs], decay).items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - slow * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; 2 marks the rows held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: its label and its passages' features, one after the other."""
    for piece in pieces(batches):
        row, x = features(piece.column("text"))
        start, size = np.searchsorted(row, np.arange(piece.num_rows)), np.bincount(row, minlength=piece.num_rows)
        taken = np.minimum(size, MOST_PASSAGES)
        own = np.concatenate([s + (np.arange(t) * n) // t for s, n, t in zip(start, size, taken, strict=True)])
        ends = np.r_[0, np.cumsum(taken)] * WIDTH
        values = pa.array(x[own].astype(np.float32).ravel())
        yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("quality"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)], names=["key", "quality", "x"])


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Model:
    """A model fitted to labelled rows outside the held-out fold; the driver gets most_labelled * MOST_PASSAGES passages
    of WIDTH numbers at most."""
    bounded_batches(docs.sparkSession)
    labels = labels.where("quality in (0, 1) and doc_id is not null").where(fold(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    share = min(1.0, most_labelled / max(labels.count(), 1))
    draw = (F.xxhash64("doc_id", F.lit("quality")).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)) < share
    wanted = F.broadcast(labels.where(draw))  # bounded: about most_labelled rows of two numbers
    sample = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(wanted, "doc_id")
    sample = sample.groupBy("text").agg(F.min("quality").alias("quality")).select(F.xxhash64("text").alias("key"), "text", "quality")
    got = sample.mapInArrow(_sampled, "key long, quality int, x array<float>").toArrow().combine_chunks().sort_by("key")
    lists = got.column("x").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.float32()))
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) // WIDTH
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, WIDTH)
    return fit(x, np.repeat(np.arange(len(size)), size), got.column("quality").to_numpy().astype(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``attention``, the weight of each passage in order (their sum is 1)."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("score", "attention")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            row, x = features(piece.column("text"))
            score, weight = shared.value.scores(x, row, piece.num_rows)
            ends = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
            attention = pa.ListArray.from_arrays(pa.array(ends), pa.array(weight.astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(score, pa.float64()), attention], names=[*piece.schema.names, "score", "attention"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("attention", T.ArrayType(T.FloatType()))]))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, learn(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
