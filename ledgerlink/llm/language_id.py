"""Language identification by prediction by partial matching (operator 6).

For each language a context tree of up to ORDER bytes holds how often each byte followed each context in the sample.
Method C: a context that was followed by q kinds of bytes in n places gives a byte seen there c / (n + q), and
escapes with q / (n + q) to the context one byte shorter, whose probabilities are taken over the bytes that were not
seen; below the empty context all bytes are alike.  Counts are frozen after learning, so a byte's code length depends
on its context alone, and the lengths of a text are exact whatever it is cut into.

All contexts of all languages share one tree.  A context's number is found by its last ORDER bytes, the longest one
that is known to any language; its code lengths are one row of a table.  The predicted language has the shortest code;
the score is its share when each language's probability of the whole text is weighed alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import bounded_batches, crc_fold, fresh, pieces, read

ORDER = 3
SAMPLE_DOCUMENTS = 400  # of each language, expected
MOST_SYMBOLS = 120


@dataclass
class Trees:
    languages: list[str]
    symbol: np.ndarray  # of each byte; 0 for bytes that the sample doesn't hold
    context: np.ndarray  # number of the longest known context, by the last ORDER symbols
    bits: np.ndarray  # code length of each symbol in each context, by language
    kinds: int

    def lengths(self, data: np.ndarray, starts: np.ndarray, window: int = 1 << 20) -> np.ndarray:
        """Code length of each text in each language; texts lie one after the other, from ``starts`` on.  Bytes are
        taken in windows, so the memory does not grow with a text."""
        out = np.zeros((len(starts), len(self.languages)))
        for a in range(0, len(data), window):
            place = np.arange(a, min(a + window, len(data)))
            text = np.searchsorted(starts, place, side="right") - 1
            since = place - starts[text]
            at = np.zeros(len(place), np.int64)
            for k in range(ORDER, 0, -1):  # the byte k places before; symbol 0 before the start
                before = self.symbol[data[np.maximum(place - k, 0)]]
                at = at * self.kinds + np.where(since >= k, before, 0)
            row = self.context[at].astype(np.int64) * self.kinds + self.symbol[data[place]]
            for j in range(len(self.languages)):
                out[text[0] : text[-1] + 1, j] += np.bincount(text - text[0], self.bits[j][row])
        return out


def gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): the runs of one to ORDER + 1 bytes of each piece's texts, as numbers that begin with a 1."""
    for piece in pieces(batches):
        lang = np.array(piece.column("lang").to_pylist(), object)
        for one in sorted(set(lang)):
            found = []
            for text in np.array(piece.column("text").to_pylist(), object)[lang == one]:
                b = np.frombuffer(b"\0" * ORDER + text.encode(), np.uint8).astype(np.int64)
                for k in range(1, ORDER + 2):
                    code = np.ones(len(b) - ORDER, np.int64)
                    for j in range(k):
                        code = (code << 8) | b[ORDER - k + 1 + j : len(b) - k + 1 + j]
                    found.append(code)
            if found:
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(gram)), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])


def learn(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Trees:
    """Trees from the texts whose crc32(doc_id as text) mod 5 is not 0 and whose lang is not null.

    About ``sample`` documents of each language are drawn by a hash of the doc_id.  The driver gets one row for each
    language and run of bytes in that sample."""
    bounded_batches(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null").where(crc_fold(F.col("doc_id")) != 0)
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    spark = docs.sparkSession
    shares = spark.createDataFrame([(k, min(1.0, sample / n)) for k, n in sizes.items()], "lang string, share double")
    draw = F.xxhash64("doc_id", F.lit("lang")).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    drawn = known.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    grams = drawn.select("lang", "text").mapInArrow(gram_rows, "lang string, gram long, n long")
    rows = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return build(sorted(sizes), rows["lang"].to_numpy(), rows["gram"].to_numpy(np.int64), rows["n"].to_numpy(float))


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Trees:
    if not languages:
        return Trees([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((0, 1), np.float32), 1)
    size = np.zeros(len(gram), np.int64)
    for k in range(1, ORDER + 2):
        size += gram >= 1 << 8 * k
    singles = gram[size == 1] & 255
    seen = np.bincount(singles, n[size == 1], 256)
    common = np.sort(np.argsort(-seen, kind="stable")[: min(MOST_SYMBOLS, int((seen > 0).sum()))])
    symbol = np.zeros(256, np.uint8)
    symbol[common] = np.arange(1, len(common) + 1)
    kinds = len(common) + 1
    # grams as symbols; what holds a rarer byte stays as symbol 0
    digits = [symbol[(gram >> 8 * j) & 255].astype(np.int64) for j in range(ORDER + 1)]  # 0 is the last byte
    # counts by order: context number -> counts of what followed
    bits_of = []
    uniform = np.full((1, kinds), 1.0 / kinds)
    lower_number = np.zeros(1, np.int64)  # by the symbols of the context one shorter
    for k in range(ORDER + 1):
        rows = size == k + 1
        code = np.zeros(rows.sum(), np.int64)
        for j in range(k, 0, -1):
            code = code * kinds + digits[j][rows]
        contexts = np.unique(code)
        place = np.searchsorted(contexts, code)
        shorter = contexts % kinds ** max(k - 1, 0)
        new = []
        for i, one in enumerate(languages):
            mine = lang[rows] == one
            counts = np.zeros((len(contexts), kinds))
            np.add.at(counts, (place[mine], digits[0][rows][mine]), n[rows][mine])
            below = uniform[np.zeros(len(contexts), int)] if k == 0 else bits_of[-1][i][lower_number[shorter]]
            total, sorts = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            unseen = np.where(counts > 0, 0.0, below)
            left = unseen.sum(axis=1, keepdims=True)
            escape = sorts / np.maximum(total + sorts, 1)
            p = np.where(counts > 0, counts / np.maximum(total + sorts, 1), escape * unseen / np.maximum(left, 1e-300))
            p = np.where(left <= 0, counts / np.maximum(total, 1), p)  # nothing is unseen
            new.append(np.where(total > 0, p, below))
        table = np.full(kinds**k, -1, np.int64)
        table[contexts] = np.arange(len(contexts))
        bits_of.append(new)
        if k:
            # contexts that no language knows are read as the one a byte shorter; their rows are kept behind
            missing = np.flatnonzero(table < 0)
            short = lower_number[missing % kinds ** (k - 1)]
            used, back = np.unique(short, return_inverse=True)
            table[missing] = len(contexts) + back
            bits_of[-1] = [np.concatenate([x, bits_of[-2][i][used]]) for i, x in enumerate(new)]
        lower_number = table
    table = np.stack(bits_of[-1])
    return Trees(languages, symbol, lower_number.astype(np.int32), (-np.log2(np.maximum(table, 1e-12))).astype(np.float32).reshape(len(languages), -1), kinds)


def identified(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with lang_pred and score.  A text that is null or has no letter gets ``und`` and 0; with no language
    learned every text does.  Other columns stay, whatever their names but lang_pred and score."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")  # the new columns stand in the place of those of their names
    letters_col = fresh(docs, "_letters")
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the sample and MOST_SYMBOLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in pieces(batches):
            texts = piece.column("text")
            sizes = np.array([0 if x is None else len(x) for x in texts.cast(pa.binary()).to_pylist()], np.int64)
            data = np.frombuffer(b"".join(x for x in texts.cast(pa.binary()).to_pylist() if x), np.uint8)
            best = ["und"] * piece.num_rows
            score = np.zeros(piece.num_rows)
            if model.languages and len(data):
                lengths = model.lengths(data, np.cumsum(sizes) - sizes)
                letters = np.array(piece.column(letters_col).to_pylist(), bool)
                first = lengths.argmin(axis=1)
                share = 1 / np.exp2(np.clip(lengths.min(axis=1, keepdims=True) - lengths, -1000, 0)).sum(axis=1)
                best = [model.languages[k] if ok else "und" for k, ok in zip(first, letters, strict=True)]
                score = np.where(letters, share, 0.0)
            kept = [c for c, name in zip(piece.columns, piece.schema.names, strict=True) if name != letters_col]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(best, pa.string()), pa.array(score)], names=[*(x for x in piece.schema.names if x != letters_col), "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    has = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(letters_col, has).mapInArrow(run, schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = identified(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
