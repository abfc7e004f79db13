"""How the words of a language differ between its sources, exactly (operator 11: chunk factorization).

A term is a run of letters A-Z, a-z and characters beyond ASCII, A-Z lower-cased.  Terms never hold ASCII white space, so a
document's terms are those of its whitespace chunks, and most chunks stand in many documents:

1. ``chunk_counts`` counts the chunks of each document and adds them up for the documents of a piece of a partition: a
   row for each (chunk, lang, source) with its occurrences and documents.
2. ``occurrences`` deals these rows by chunk, adds them up, cuts each globally distinct chunk into its terms once and
   joins them back.
3. ``candidates`` adds up terms.  A term stands in at least as many documents of a group as its most frequent chunk and
   at most as many as its chunks together; ``kept_terms`` compares documents only where the threshold lies between.
4. ``divergence`` compares smoothed shares in whole numbers.

Each row of ``docs`` is one document, also where doc_id is null or repeats.  Null text, lang and source are read as ''.
A text without terms counts for its (lang, source) group alone; a language without kept terms has pairs of value 0 and no
term rows.  Very long texts and chunks are read whole.  Ties are ordered by the item's UTF-8 bytes.  An empty table gives
no rows.  Other columns are never read, so their names can't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import bounded_batches, coded, keep, pieces, read, word_lists

MIN_DOCS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
BLOCK_TERMS = 1_024  # terms, and sources on each side, that one comparison task holds
BLOCK_SOURCES = 32

#: Bytes of a chunk: letters and bytes beyond ASCII stay (A-Z lower-cased), line feeds divide chunks, all else divides terms.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c == 10 else 32 for c in range(256))

SMALL_BYTES = 8 << 20  # of open terms or their chunks sent to every task; more are joined by shuffle
PIECE_BYTES = 16 << 20

_COUNTS = "chunk string, lang string, source string, n long, d long"
_TERMS = "lang string, source string, term string, n long, d long, chunk string"


def chunk_counts(docs: DataFrame) -> DataFrame:
    """Chunk, lang, source, ``n`` occurrences and ``d`` documents within one piece, in the order of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, most=PIECE_BYTES):
            chunks, counts = word_lists(piece.column("text"))
            chunks = chunks.dictionary_encode()
            if not len(chunks):
                continue
            lang, source = (piece.column(c).dictionary_encode() for c in ("lang", "source"))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            # one number for (chunk, document): documents come group by group, so a group's documents are neighbours
            by_group = np.argsort(group, kind="stable")
            place = np.empty(len(group), np.int64)
            place[by_group] = np.arange(len(group))
            key = chunks.indices.to_numpy(zero_copy_only=False) * np.int64(len(group))
            key += np.repeat(place, counts)
            key.sort()
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])  # of each (chunk, document)
            n = np.diff(np.r_[first, len(key)])
            chunk, of = np.divmod(key[first], len(group))
            of = group[by_group[of]]
            starts = np.flatnonzero(np.r_[True, (chunk[1:] != chunk[:-1]) | (of[1:] != of[:-1])])
            of = of[starts]
            yield pa.RecordBatch.from_arrays([
                chunks.dictionary.take(pa.array(chunk[starts])),
                lang.dictionary.take(pa.array(of // len(source.dictionary))),
                source.dictionary.take(pa.array(of % len(source.dictionary))),
                pa.array(np.add.reduceat(n, starts)), pa.array(np.diff(np.r_[starts, len(first)]))], names=["chunk", "lang", "source", "n", "d"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, _COUNTS)


def chunk_documents(docs: DataFrame, wanted: pa.Array | None) -> DataFrame:
    """lang, chunk and a number for the document, for each distinct chunk of each document (of the wanted ones)."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # bounded by SMALL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for piece in pieces(batches, most=PIECE_BYTES):
            chunks, counts = word_lists(piece.column("text"))
            chunks = chunks.dictionary_encode()
            code = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            if sent.value is not None:
                open_ = pc.is_in(chunks.dictionary, value_set=sent.value).to_numpy(zero_copy_only=False)[code]
                code, row = code[open_], row[open_]
            key = np.unique(row * max(len(chunks.dictionary), 1) + code)
            row, code = key // max(len(chunks.dictionary), 1), key % max(len(chunks.dictionary), 1)
            yield pa.RecordBatch.from_arrays([piece.column("lang").take(pa.array(row)), chunks.dictionary.take(pa.array(code)), pa.array(first + row)], names=["lang", "chunk", "id"])
            first += piece.num_rows

    return docs.mapInArrow(run, "lang string, chunk string, id long")


def _terms_of(chunks: list[str]) -> list[list[bytes]]:
    return [x.split() for x in "\n".join(chunks).encode().translate(_PLAIN).split(b"\n")] if chunks else []


def _cut(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's rows with its terms; rows come in the order of chunk and lang, so that each chunk is cut once."""
    last: tuple[str, list[bytes]] = ("", [])
    for batch in batches:
        code, distinct = coded(batch.column("chunk"))
        if not distinct:
            continue
        known = distinct[0] == last[0]
        cut = [last[1], *_terms_of(distinct[1:])] if known else _terms_of(distinct)
        last = (distinct[-1], cut[-1])
        count = [list(Counter(x).items()) if len(x) > 1 else [(y, 1) for y in x] for x in cut]
        size = np.array([len(x) for x in count], np.int64)
        start = np.cumsum(size) - size
        lang = batch.column("lang").dictionary_encode().indices.to_numpy()
        d = batch.column("d").to_numpy()
        runs = np.flatnonzero(np.r_[True, (np.diff(code) != 0) | (np.diff(lang) != 0)])
        most = np.repeat(np.add.reduceat(d, runs), np.diff(np.r_[runs, len(d)]))
        many = size[code]
        row = np.repeat(np.arange(len(code)), many)
        at = np.repeat(start[code] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        terms = pa.array([t.decode() for x in count for t, _ in x], pa.string())
        times = np.array([k for x in count for _, k in x], np.int64)
        rare = pc.if_else(pa.array(most < min_docs), batch.column("chunk"), None)
        lang, source = batch.column("lang").take(pa.array(row)), batch.column("source").take(pa.array(row))
        yield pa.RecordBatch.from_arrays([lang, source, terms.take(pa.array(at)), pa.array(batch.column("n").to_numpy()[row] * times[at]), pa.array(d[row]), rare.take(pa.array(row))], names=["lang", "source", "term", "n", "d", "chunk"])


def plain_docs(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))


def occurrences(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term for each chunk that holds the term: ``n`` occurrences, ``d`` documents of the chunk in the
    group, and ``chunk`` itself where the documents seen beside it are fewer than min_docs in the language.  A frequent
    chunk comes as one row for each piece and group, and is summed where it lies."""
    dealt = chunk_counts(docs).repartition("chunk")
    summed = dealt.groupBy("chunk", "lang", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    cut = summed.sortWithinPartitions("chunk", "lang").mapInArrow(lambda batches: _cut(batches, min_docs), _TERMS)
    return keep(cut, "terms")


def candidates(found: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, ``n`` for the terms that min_docs documents of the language may hold, with ``lang_n``
    occurrences in the language and whether the term is ``sure`` to be kept.  Dealt once, by (lang, term)."""
    dealt = found.select("lang", "source", "term", "n", "d").repartition("lang", "term")
    groups = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.max("d").alias("most"))
    # no document stands in two groups, so what each group has at least adds up
    terms = groups.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("d").alias("total"), F.sum("most").alias("least")).where(F.col("total") >= min_docs)
    both = groups.join(terms, ["lang", "term"])
    return keep(both.select("lang", "source", "term", "n", "d", "most", "lang_n", (F.col("least") >= min_docs).alias("sure")), "term-candidates")


def _is_small(df: DataFrame, column: str) -> bool:
    """Whether the strings of a kept table take SMALL_BYTES at most, 64 bytes a row for the rest."""
    return (df.agg(F.sum(F.octet_length(column) + 64)).first()[0] or 0) <= SMALL_BYTES


def kept_terms(docs: DataFrame, found: DataFrame, terms: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) in at least ``min_docs`` documents of the language, out of ``occurrences`` and ``candidates``."""
    open_ = keep(terms.where("not sure").select("lang", "term").distinct(), "open-terms")
    sent = F.broadcast(open_) if _is_small(open_, "term") else open_
    chunks = found.where("chunk is not null").select("lang", "term", "chunk").join(sent, ["lang", "term"]).distinct()
    chunks = keep(chunks, "open-chunks")
    wanted = pa.array(chunks.select("chunk").distinct().toArrow().column(0).combine_chunks()) if _is_small(chunks, "chunk") else None
    ids = chunk_documents(docs, wanted).join(chunks, ["lang", "chunk"]).select("lang", "term", "id").distinct()
    exact = ids.groupBy("lang", "term").count().where(F.col("count") >= min_docs)
    return keep(terms.where("sure").select("lang", "term").distinct().unionByName(exact.select("lang", "term")), "kept-terms")


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * size)), exactly; 1 where nothing is kept."""
    top = F.lit(UNIT).cast("decimal(10,0)") * (count + F.lit(SMOOTHING)).cast("decimal(20,0)")
    below = (total + F.lit(SMOOTHING) * size).cast("decimal(20,0)")
    return F.when(size > 0, F.lit(1) + F.call_function("div", top, below)).otherwise(F.lit(1)).cast("long")


def _differences(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Of two blocks of sources: the sum of |p - q| over the terms of this block that any of them has, and how many.
    Each source has a row without a term, so that one without terms here takes part."""
    _, _, i, j = key
    term, terms = rows["term"].factorize()
    source, sources = rows["source"].factorize()
    first = rows.groupby(source).first()
    table = np.repeat(first["p0"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    has = term >= 0
    table[source[has], term[has]] = rows["p"].to_numpy()[has].astype(np.int64)
    block = first["own"].to_numpy()
    out = []
    for a in np.flatnonzero(block == i):
        others = np.flatnonzero(block == j) if i != j else np.arange(a + 1, len(sources))
        for b in others:
            out.append((key[0], *sorted((sources[a], sources[b])), int(np.abs(table[a] - table[b]).sum()), table.shape[1]))
    return pd.DataFrame(out, columns=["lang", "a", "b", "part", "terms"])


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` compares a source's shares with each other source of the
    language, ``term`` has the source's ``top_terms`` terms with the largest excess over the language's share."""
    docs = plain_docs(docs)
    found = occurrences(docs, min_docs)
    terms = candidates(found, min_docs)
    kept = kept_terms(docs, found, terms, min_docs)
    counts = keep(terms.select("lang", "source", "term", "n", "lang_n").join(kept, ["lang", "term"], "left_semi"), "term-counts")
    groups = docs.select("lang", "source").distinct()
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "size"])
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
    groups = groups.join(sources, "lang").withColumn("p0", share(F.lit(0), F.col("total"), F.col("size")))
    groups = keep(groups, "term-groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("size")))

    # blocks of terms and of sources, dealt by hash; a row goes to each pair of blocks that its own stands in
    n_terms, n_sources = F.ceil(F.col("size") / BLOCK_TERMS).cast("int"), F.ceil(F.col("sources") / BLOCK_SOURCES).cast("int")
    present = shares.select("lang", "source", "size", "sources", F.pmod(F.xxhash64("term"), n_terms).cast("int").alias("block"), "term", "p", "p0")
    every = groups.where("size > 0").select("lang", "source", "size", "sources", F.explode(F.sequence(F.lit(0), n_terms - 1)).alias("block"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"), "p0")
    blocks = present.unionByName(every).withColumn("own", F.pmod(F.xxhash64("source"), n_sources).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), n_sources - 1)))
    blocks = blocks.select("lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "source", "term", "p", "p0")
    parts = blocks.groupBy("lang", "block", "i", "j").applyInPandas(_differences, "lang string, a string, b string, part long, terms long")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("terms").alias("terms"))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    summed = summed.select("lang", both.alias("x"), "part", "terms").select("lang", F.col("x.a").alias("source"), F.col("x.b").alias("item"), "part", "terms")
    left = groups.select("lang", "source", "size", F.col("p0").alias("own0"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other0"))
    pairs = left.join(right, "lang").where("source <> item").join(summed, ["lang", "source", "item"], "left").fillna(0, ["part", "terms"])
    rest = (F.col("size") - F.col("terms")) * F.abs(F.col("own0") - F.col("other0"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("part") + rest).alias("value"))

    excess = shares.withColumn("value", F.col("p") - share(F.col("lang_n"), F.col("lang_total"), F.col("size"))).where("value > 0")
    terms = excess.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT AS p
  FROM grid JOIN sizes USING (lang)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0
  FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b
  ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM sizes)),
terms AS (
  SELECT s.lang, s.source, s.term AS item, s.p - w.q AS value FROM shares s JOIN whole w USING (lang, term)
  WHERE s.n > 0 AND s.p > w.q)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS r FROM terms)
WHERE r <= 50
"""
