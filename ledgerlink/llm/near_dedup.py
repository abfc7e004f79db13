"""MinHash near-dedup over HyperMinHash registers (operator 9).

Each document's set of 5-word shingles is hashed to 64 bits.  Seven bits choose one of 128 buckets, which keeps its
smallest value in 16 bits: the count of leading zeros and the ten bits behind the first one.  Documents with the same
set are one class and its sketch is kept once.  Thirty-two bands of four registers find candidates: a pair at the
threshold of 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6.  Within a bucket of the bands, agreeing
registers, corrected for collisions, estimate the similarity; pairs within 4.5 standard deviations of the threshold
tie their classes into a cluster.  Inside a cluster every pair is then compared on the full shingle sets.

Groups of many near copies: buckets with the same members count once, buckets and clusters are dealt out in pairs of
bounded parts, and a part writes only links that join what is still apart, so the rows grow with the members and not
with the pairs, and no link between groups is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import bounded_batches, coded, hashes, keep, mixed, pieces, read, signed, word_lists
from ledgerlink.llm.graph import components

REGISTERS, BANDS, ROWS = 128, 32, 4
MANTISSA = 10
PART_MEMBERS, PART_SHINGLES = 512, 1 << 18
EMPTY = 0xFFFF


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted within it, one text after the other, and how many each has."""
    words, counts = word_lists(texts)
    code, distinct = coded(pc.ascii_lower(words))
    h = mixed(hashes(distinct))[code]
    shingles = np.maximum(counts - width + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), shingles)
    first = np.repeat(np.cumsum(counts) - counts - (np.cumsum(shingles) - shingles), shingles) + np.arange(len(text))
    last = (np.cumsum(counts))[text]
    value = np.full(len(text), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(width):
        at = first + k
        inside = at < last
        value = np.where(inside, mixed(value ^ h[np.minimum(at, max(len(h) - 1, 0))]) + np.uint64(k), value) if len(h) else value
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(text[new], minlength=len(counts)).astype(np.int64)


def sketches(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers, one row of REGISTERS for each set: leading zeros above MANTISSA bits."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    x = mixed(values ^ np.uint64(0x5851F42D4C957F2D))
    smallest = np.full(len(sizes) * REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(smallest, owner * REGISTERS + (x >> np.uint64(57)).astype(np.int64), x << np.uint64(7))
    tail = smallest >> np.uint64(12)  # 52 bits, exact as doubles
    _, exponent = np.frexp(tail.astype(np.float64))
    zeros = (52 - exponent).astype(np.uint64)
    behind = ((tail << (zeros + np.uint64(1))) & np.uint64((1 << 52) - 1)) >> np.uint64(52 - MANTISSA)
    registers = ((zeros << np.uint64(MANTISSA)) | behind).astype(np.uint16)
    registers[smallest == np.uint64(0xFFFFFFFFFFFFFFFF)] = EMPTY
    return registers.reshape(-1, REGISTERS)


def estimate(one: np.ndarray, others: np.ndarray, n_one: int, n_others: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers.  Two different values share a register with probability of about
    2**-MANTISSA / 3 times 4 n m / (n + m)**2 in a bucket; the expected number of such collisions is taken off."""
    either = ((others != EMPTY) | (one != EMPTY)).sum(axis=1)
    equal = ((others == one) & (others != EMPTY)).sum(axis=1)
    collide = 2.0**-MANTISSA / 3 * 4 * n_one * n_others / np.maximum(n_one + n_others, 1) ** 2
    return np.clip((equal / np.maximum(either, 1) - collide) / (1 - collide), 0, 1)


def band_keys(registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each band of each sketch, and which bands hold any value."""
    r = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x100000001B3) + r[:, :, k])
    return key, (registers.reshape(len(registers), BANDS, ROWS) != EMPTY).any(axis=2)


def digests(values: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """128 bits that tell a set, whatever the order of its members."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        d = np.zeros(len(sizes), np.uint64)
        np.add.at(d, owner, mixed(values ^ np.uint64(salt)))
        out.append(signed(d))
    return out


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        values, sizes = shingle_sets(piece.column("text"))
        sketch = pa.array([x.tobytes() for x in sketches(values, sizes)], pa.binary())
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_key"), pa.array(sizes), *digests(values, sizes), sketch], names=["doc_id", "text_key", "n_shingles", "d1", "d2", "sketch"])


def band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            registers = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            key, full = band_keys(registers)
            node = np.broadcast_to(batch.column("node").to_numpy()[:, None], key.shape)
            yield pa.RecordBatch.from_arrays([signed(key[full]), pa.array(node[full])], names=["band", "node"])


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        values, sizes = shingle_sets(piece.column("text"))
        cuts = np.cumsum(sizes) - sizes
        sets = pa.array([values[a : a + n].tobytes() for a, n in zip(cuts, sizes, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(sizes), *digests(values, sizes), sets], names=["n_shingles", "d1", "d2", "shingles"])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The runs of rows with the same keys in a sorted partition, each whole."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(batch.slice(a, b - a))
    if held:
        yield at, pa.Table.from_batches(held)


def joined(count: int, neighbours) -> list[tuple[int, int]]:
    """Links of a spanning forest: from each place that is reached, only those still apart are compared."""
    apart = np.arange(count)
    found = []
    while len(apart):
        queue, apart = [int(apart[0])], apart[1:]
        while queue and len(apart):
            x = queue.pop()
            near = neighbours(x, apart)
            found += [(x, int(y)) for y in apart[near]]
            queue += apart[near].tolist()
            apart = apart[~near]
    return found


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def link_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], schema=LINKS)


def likely_links(threshold: float):
    margin = 4.5 * (threshold * (1 - threshold) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, t in groups(batches, ["band", "i", "j"]):
            node, n = t.column("node").to_numpy(), t.column("n_shingles").to_numpy().astype(float)
            r = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            # few registers are in use in a small set, and its margin is wider
            used = np.maximum((r != EMPTY).sum(axis=1), 1)

            def near(x: int, ys: np.ndarray, r=r, n=n, used=used) -> np.ndarray:
                fits = np.minimum(n[x], n[ys]) >= threshold * np.maximum(n[x], n[ys])
                wide = margin * np.sqrt(REGISTERS / np.maximum(used[x], used[ys]))
                return fits & (estimate(r[x], r[ys], n[x], n[ys]) >= threshold - wide)

            out += [(int(node[x]), int(node[y])) for x, y in joined(len(node), near)]
            if len(out) > 20_000:
                yield link_batch(out)
                out = []
        yield link_batch(out)

    return run


def true_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, t in groups(batches, ["cluster", "i", "j"]):
            node = t.column("node").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            n = np.array([len(x) for x in sets])
            _, code = np.unique(np.concatenate(sets), return_inverse=True)
            parts = np.split(code, np.cumsum(n)[:-1])
            mark = np.zeros(code.max(initial=-1) + 1, bool)
            # the sets one after the other, so that one pass counts what each shares with a marked set

            def near(x: int, ys: np.ndarray, parts=parts, n=n, mark=mark) -> np.ndarray:
                fits = np.flatnonzero(100 * np.minimum(n[x], n[ys]) >= percent * np.maximum(n[x], n[ys]))
                close = np.zeros(len(ys), bool)
                if len(fits):
                    mark[parts[x]] = True
                    some = ys[fits]
                    both = np.add.reduceat(mark[np.concatenate([parts[y] for y in some])].astype(np.int64), np.cumsum(n[some]) - n[some])
                    mark[parts[x]] = False
                    close[fits] = 100 * both >= percent * (n[x] + n[some] - both)
                return close

            out += [(int(node[x]), int(node[y])) for x, y in joined(len(node), near)]
            if len(out) > 20_000:
                yield link_batch(out)
                out = []
        yield link_batch(out)

    return run


def dealt(members: DataFrame, key: str, parts: Column) -> DataFrame:
    """Members (with ``key`` and ``node``) in every pair (i, j) of the parts of their group that takes them in: each
    two members of a group meet in one pair at least, and no pair is larger than two parts."""
    members = members.withColumn("parts", parts.cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    members = members.withColumn("other", other).where("parts = 1 or own <> other")
    return members.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("parts", "own", "other")


def near_classes(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.  See ``near_rows``."""
    return near_rows(docs, percent).drop("text_key")


def near_rows(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, text_key (the text's MD5).

    Rows with a null doc_id are linked with nothing and kept, with a null component.  A null, empty or blank text has
    no shingles and is linked with nothing.  Rows that repeat a doc_id are judged by their own texts.  Columns other
    than doc_id and text are not read."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = docs.withColumn("text_key", F.unhex(F.md5("text")))
    drawn = keep(marked.mapInArrow(sketch_rows, "doc_id long, text_key binary, n_shingles long, d1 long, d2 long, sketch binary"), "sketches")
    node = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.xxhash64("n_shingles", "d1", "d2"))
    drawn = drawn.withColumn("node", node)
    classes = keep(drawn.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")

    bands = classes.select("node", "sketch").mapInArrow(band_rows, "band long, node long")
    several = bands.groupBy("band").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x")).where("members > 1")
    once = several.groupBy("members", "s", "x").agg(F.min("band").alias("band")).select("band", "members")
    shared = keep(bands.join(once, "band"), "buckets")
    meeting = dealt(shared, "band", F.ceil(F.col("members") / PART_MEMBERS)).select("band", "i", "j", "node")
    meeting = meeting.join(classes.select("node", "n_shingles", "sketch"), "node")
    meeting = meeting.repartition(n_parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")
    likely = meeting.select("band", "i", "j", "node", "n_shingles", "sketch").mapInArrow(likely_links(percent / 100), "a long, b long")
    clusters = components(likely)

    clusters = clusters.select("node", F.col("label").alias("cluster")).join(classes.select("node", "first", "n_shingles"), "node")
    clusters = keep(clusters, "clusters")
    # a merge join at every size: the growth seen on small data then holds on large
    texts = docs.join(clusters.select(F.col("first").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    sets = texts.mapInArrow(set_rows, "n_shingles long, d1 long, d2 long, shingles binary")
    # rows that repeat a doc_id differ in the node, which comes from the set
    sets = sets.groupBy(F.xxhash64("n_shingles", "d1", "d2").alias("node")).agg(F.first("shingles").alias("shingles"))
    return _finish(drawn, classes, clusters, sets, percent, n_parts)


def _finish(drawn: DataFrame, classes: DataFrame, clusters: DataFrame, sets: DataFrame, percent: int, n_parts: int) -> DataFrame:
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("total"))
    parts = F.greatest(F.ceil(F.col("members") / PART_MEMBERS), F.ceil(F.col("total") / PART_SHINGLES))
    meeting = dealt(clusters.join(sizes, "cluster"), "cluster", parts).select("cluster", "i", "j", "node")
    meeting = meeting.join(sets, "node")
    meeting = meeting.select("cluster", "i", "j", "node", "shingles").repartition(n_parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    labels = components(meeting.mapInArrow(true_links(percent), "a long, b long"))
    least = labels.join(classes.select("node", "first"), "node").groupBy("label").agg(F.min("first").alias("component"))
    ids = labels.join(least, "label").select("node", "component")
    named = classes.select("node", "first").join(ids, "node", "left").select("node", F.coalesce("component", "first").alias("component"))
    out = drawn.select("doc_id", "n_shingles", "node", "text_key").join(named, "node", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_key")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read(spark, sf_dir, "documents"))
