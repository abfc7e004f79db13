"""Toxicity scores from a factorization machine over hashed terms (operator 7).

A document's terms are its lower-cased words without the marks around them, and their first four, five and six
letters, each hashed into 2**18 numbers; a term counts once.  The score is the logistic of

    bias + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2)

over the document's terms, so pairs of terms add what the weights of each alone do not say.  The machine is learned on a
bounded sample of the labelled rows (``most_labelled``, chosen by a hash of the doc_id) from all terms that LEAST_DOCS
sample documents hold, whatever each says of the label by itself:

* ``w`` by follow-the-regularized-leader with an L1 penalty over all terms at once, so few are not zero;
* ``v`` starts at the leading sparse eigenvectors of the pair matrix ``sum_d e_d x_di x_dj`` (x: centred and scaled
  terms, e: what w leaves unexplained), found by thresholded power iteration without forming the matrix; two terms that
  say nothing alone stand out there if they tell together.  Then w and v are learned together.  Pairs stay if they lower
  the loss on a fifth of the sample that took no part in learning them.

Toxic rows weigh TOXIC_WEIGHT times the others.  Ties at 0.5 count as reached.  Equal texts are one example in the sample;
rows that repeat are scored alike.  Very long texts are read whole, in pieces of bounded memory.  Without labelled rows
every score is 0.25; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import bounded_batches, coded, crc_fold, hashes, pieces, read, word_lists

TERM_BITS = 18
PREFIXES = (4, 5, 6)
FACTORS = 4
MOST_LABELLED = 5_000
LEAST_DOCS = 3
TOXIC_WEIGHT = 3.0  # and L1: chosen by cross-validation over the folds that are learned from
L1 = 20.0  # on the summed gradients of w
BATCH, EPOCHS = 64, 8
KEPT = 0.5  # of a factor's largest entry


def document_terms(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) for each distinct hashed term of each text; with ``wanted``, a flag for each term, only those."""
    words, counts = word_lists(texts)
    code, distinct = coded(words)
    plain = pc.utf8_trim(pc.utf8_lower(pa.array(distinct, pa.string())), ".,;:!?\"'()[]{}<>|*_-#/\\`~").to_pylist()
    of = [hashes(["w" + w if w else "" for w in plain])]
    of += [hashes([f"{k}{w[:k]}" if len(w) >= k else "w" + w if w else "" for w in plain]) for k in PREFIXES]
    term = (np.stack(of, axis=1) >> np.uint64(64 - TERM_BITS)).astype(np.int64)
    term[[not w for w in plain]] = -1
    row = np.repeat(np.arange(len(counts)), counts)
    if wanted is not None:
        term[~wanted[term]] = -1
        some = (term >= 0).any(axis=1)[code]
        row, code = row[some], code[some]
    key = (row[:, None] << TERM_BITS) + term[code]
    key = np.unique(key[term[code] >= 0])
    return key >> TERM_BITS, key & ((1 << TERM_BITS) - 1)


@dataclass
class Machine:
    bias: float
    place: np.ndarray  # of each term in w and v, or -1
    w: np.ndarray
    v: np.ndarray

    def scores(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        at = self.place[term]
        row, at = row[at >= 0], at[at >= 0]
        z = self.bias + np.bincount(row, self.w[at], n)
        for f in range(self.v.shape[1]):
            x = self.v[at, f]
            z += 0.5 * (np.bincount(row, x, n) ** 2 - np.bincount(row, x * x, n))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Sample:
    """(row, at) for each term of each document, rows in order, ``at`` the place of the term; label and weight by row."""

    row: np.ndarray
    at: np.ndarray
    label: np.ndarray
    terms: int

    def weight(self) -> np.ndarray:
        return np.where(self.label > 0, TOXIC_WEIGHT, 1.0)

    def part(self, chosen: np.ndarray) -> Sample:
        new = (np.cumsum(chosen) - 1).astype(np.int32)
        own = chosen[self.row]
        return Sample(new[self.row[own]], self.at[own], self.label[chosen], self.terms)


@dataclass
class Weights:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def z(self, s: Sample) -> np.ndarray:
        n = len(s.label)
        out = self.bias + np.bincount(s.row, self.w[s.at], n)
        has = self.v.any(axis=1)[s.at]
        row, at = s.row[has], s.at[has]
        for f in range(self.v.shape[1] if len(row) else 0):
            x = self.v[at, f]
            out += 0.5 * (np.bincount(row, x, n) ** 2 - np.bincount(row, x * x, n))
        return out

    def loss(self, s: Sample) -> float:
        return float((s.weight() * np.logaddexp(0, np.where(s.label > 0, -1, 1) * self.z(s))).sum())


def pair_factors(s: Sample, error: np.ndarray, seed: int = 7) -> np.ndarray:
    """The leading sparse eigenvectors of the pair matrix of ``error`` over centred and scaled terms; zeros where no
    entry stands out of the noise of so many terms."""
    n, p, rng = len(s.label), s.terms, np.random.default_rng(seed)
    e = error - error.mean()
    share = np.bincount(s.at, minlength=p) / n
    usable = (share * n >= max(LEAST_DOCS, n / 100)) & (share <= 0.9)  # a pair of rarer terms is in too few documents
    if not usable.any():
        return np.zeros((p, FACTORS))
    own = usable[s.at]
    row, at = s.row[own], s.at[own]
    scale = np.where(usable, 1 / np.sqrt(np.maximum(n * share * (1 - share), 1e-9)), 0)
    noise = e.std() / np.sqrt(n) * np.sqrt(2 * np.log(max(usable.sum(), 2)))
    diagonal = scale**2 * ((1 - 2 * share) * np.bincount(at, e[row], p) + share**2 * e.sum())

    def times(x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        for f in range(x.shape[1]):
            y = scale * x[:, f]
            of = e * (np.bincount(row, y[at], n) - (share * y).sum())
            out[:, f] = scale * (np.bincount(at, of[row], p) - share * of.sum()) - diagonal * x[:, f]
        return out

    x = np.linalg.qr(rng.normal(size=(p, FACTORS)) * usable[:, None])[0]
    size = 1.0
    for _ in range(5):
        x, r = np.linalg.qr(times(x))
        size = np.abs(np.diag(r)).max()
    for _ in range(10):  # the shift puts the largest positive ones first
        x = np.linalg.qr(times(x) + size * x)[0]
    for _ in range(10):
        y = times(x)
        y = np.sign(y) * np.maximum(np.abs(y) - noise, 0)
        some = np.abs(y).sum(axis=0) > 0
        x = np.where(some, np.linalg.qr(y + 1e-12 * rng.normal(size=y.shape))[0], 0)
        x = np.where(np.abs(x) > 1e-6, x, 0)
    x = x * ((x * times(x)).sum(axis=0) > 0)
    peak = np.maximum(np.abs(x).max(axis=0), 1e-9)
    return np.where(np.abs(x) >= KEPT * peak, 0.3 * x / peak, 0)


def descend(s: Sample, v: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Weights:
    """Follow the regularized leader over batches of documents; entries of ``v`` that are zero stay so."""
    n, rng, weight = len(s.label), np.random.default_rng(seed), s.weight()
    rate = float(((weight * s.label).sum() + 0.5) / (weight.sum() + 2))
    bias, bias_sum = np.log(rate / (1 - rate)), 1.0
    z, squares, v, v_squares = np.zeros(s.terms), np.zeros(s.terms), v.copy(), np.zeros(v.shape)
    paired = v.any(axis=1)
    start, size = np.searchsorted(s.row, np.arange(n)), np.bincount(s.row, minlength=n)

    def current(i) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0, -(z[i] - np.sign(z[i]) * L1) / (1 + np.sqrt(squares[i])))

    for _ in range(epochs):
        order = rng.permutation(n)
        for k in range(0, n, BATCH):
            docs = order[k : k + BATCH]
            own = size[docs]
            entry = np.repeat(start[docs] - (np.cumsum(own) - own), own) + np.arange(own.sum())
            doc, at = np.repeat(np.arange(len(docs)), own), s.at[entry]
            terms, place = np.unique(at, return_inverse=True)
            w = current(terms)
            out = bias + np.bincount(doc, w[place], len(docs))
            pair = paired[at]
            pair_doc, pair_at = doc[pair], at[pair]
            if len(pair_at):
                sums = np.stack([np.bincount(pair_doc, v[pair_at, f], len(docs)) for f in range(v.shape[1])], axis=1)
                out += 0.5 * ((sums**2).sum(axis=1) - np.bincount(pair_doc, (v[pair_at] ** 2).sum(axis=1), len(docs)))
            e = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - s.label[docs]) * weight[docs]
            gradient, more = np.bincount(place, e[doc], len(terms)), np.bincount(place, e[doc] ** 2, len(terms))
            z[terms] += gradient - (np.sqrt(squares[terms] + more) - np.sqrt(squares[terms])) * w
            squares[terms] += more
            bias_sum += (e**2).sum()
            bias -= 0.3 * e.sum() / np.sqrt(bias_sum)
            if len(pair_at):
                some, of = np.unique(pair_at, return_inverse=True)
                g = np.zeros((len(some), v.shape[1]))
                np.add.at(g, of, e[pair_doc, None] * (sums[pair_doc] - v[pair_at]))
                g = np.where(v[some] != 0, g + 1e-3 * v[some], 0)
                v_squares[some] += g * g
                v[some] -= 0.1 * g / np.sqrt(1e-8 + v_squares[some])
    return Weights(float(bias), current(np.arange(s.terms)), v)


def fit(row: np.ndarray, term: np.ndarray, label: np.ndarray, seed: int = 7) -> Machine:
    """Learn from the documents' hashed terms; rows are numbered from 0 in order."""
    n = len(label)
    found = np.bincount(term, minlength=1 << TERM_BITS)
    chosen = np.flatnonzero(found >= LEAST_DOCS)
    place = np.full(1 << TERM_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    at = place[term]
    own = at >= 0
    sample = Sample(row[own], at[own], np.asarray(label, float), len(chosen))
    del at, own
    alone = np.zeros((len(chosen), FACTORS))

    def paired(s: Sample, plain: Weights) -> np.ndarray:
        return pair_factors(s, (s.label - 1 / (1 + np.exp(-np.clip(plain.z(s), -40, 40)))) * s.weight(), seed)

    best = descend(sample, alone, seed=seed)
    aside = np.random.default_rng(seed).random(n) < 0.2
    if n >= 20 and 0 < sample.label[~aside].sum() < (~aside).sum():
        known, rest = sample.part(~aside), sample.part(aside)
        plain = descend(known, alone, seed=seed)
        v = paired(known, plain)
        if v.any() and descend(known, v, 2 * EPOCHS, seed).loss(rest) < plain.loss(rest):
            v = paired(sample, best)
            best = descend(sample, v, 2 * EPOCHS, seed) if v.any() else best
    kept = np.flatnonzero((best.w != 0) | best.v.any(axis=1))
    place = np.full(1 << TERM_BITS, -1, np.int32)
    place[chosen[kept]] = np.arange(len(kept))
    return Machine(best.bias, place, best.w[kept], best.v[kept])


def term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: its label and its distinct hashed terms."""
    for piece in pieces(batches):
        row, term = document_terms(piece.column("text"))
        ends = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("toxic"), pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int32)))], names=["key", "toxic", "terms"])


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Machine:
    """A machine learned from rows outside the held-out fold.

    Only rows with a text, a doc_id and a label of 0 or 1 count; a doc_id with contrary labels counts as toxic.  The
    driver gets the terms of about most_labelled documents."""
    bounded_batches(docs.sparkSession)
    labels = labels.where("toxic in (0, 1) and doc_id is not null").where(crc_fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = labels.count()
    share = min(1.0, most_labelled / max(total, 1))
    draw = (F.xxhash64("doc_id", F.lit("toxicity")).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)) < share
    wanted = F.broadcast(labels.where(draw))  # bounded: about most_labelled rows of two numbers
    sample = docs.select("doc_id", "text").where("text is not null").join(wanted, "doc_id")
    # equal texts are one example, so a large group of copies doesn't weigh as many
    sample = sample.groupBy("text").agg(F.max("toxic").alias("toxic")).select(F.xxhash64("text").alias("key"), "text", "toxic")
    got = sample.mapInArrow(term_rows, "key long, toxic int, terms array<int>").toArrow().combine_chunks().sort_by("key")
    lists = got.column("terms").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    size, term = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
    machine = fit(np.repeat(np.arange(len(size), dtype=np.int32), size), term, got.column("toxic").to_numpy().astype(float))
    del got, lists, size, term
    pa.default_memory_pool().release_unused()  # the driver goes on without the sample
    return machine


def scored(docs: DataFrame, machine: Machine, column: str = "score") -> DataFrame:
    """``docs`` with ``column`` (0 to 1, higher: more likely toxic), in the place of one of that name.  Null and empty
    texts get the score of no terms; other columns, whatever their names, stay as they are."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # bounded: 2**TERM_BITS places and their weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in pieces(batches):
            row, term = document_terms(piece.column("text"), model.place >= 0)
            score = pa.array(model.scores(row, term, piece.num_rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*piece.columns, score], names=[*piece.schema.names, column])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, learn(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
