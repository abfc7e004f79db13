"""Line dedup by a segment-partition edit join (operator 4).

Lines of MIN_CHARS characters or more are linked where at most EDITS edits (insert, delete or replace one character)
turn one into the other.  Cut into EDITS + 1 segments, one of two such lines has a segment that the other holds
unchanged, at nearly the same place.  So each line gives its segments as an index, and probes it with its own
substrings for each length that a partner may have, at the places that the lengths allow (the multi-match-aware
choice).  Both are 64-bit hashes of (length, segment, substring).  Hashes that only one line gives are left out by an
aggregation before lines meet; what meets is verified by a banded bit-parallel edit distance, many pairs at a time.

Linked lines make classes, and a line stays only at the first place (doc_id, line) of its class.  Shorter lines are
not joined: with ``short_copies``, as in the query, equal ones are a class, found by their key; else they stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import bounded_batches, fresh, keep, mixed, pieces, read, signed
from ledgerlink.llm.graph import components

EDITS = 2
MIN_CHARS = 20
MOST_BROADCAST = 1_000_000
PART_LINES = 512
BUCKETS = 32
BULK_ROWS, BULK_PAIRS = 8_192, 100_000  # rows and pairs that are handled at once
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def places(edits: int) -> list[tuple[int, int, int, int]]:
    """What a line gives: (gap, segment, shift, side).  Side 0 is the index, its own segments.  On side 1 it probes for
    partners ``gap`` characters shorter, with the substring ``shift`` places behind that partner's segment."""
    out = [(0, i, 0, 0) for i in range(edits + 1)]
    for gap in range(edits + 1):
        for i in range(edits + 1):
            out += [(gap, i, shift, 1) for shift in range(max(-i, gap - (edits - i)), min(i, gap + edits - i) + 1)]
    return out


def segment(length, i: int, edits: int):
    """Start and size of segment i of lines as long as ``length`` (an int or an array)."""
    size, longer = length // (edits + 1), length % (edits + 1)
    over = i - (edits + 1 - longer)
    return i * size + np.maximum(over, 0), size + (over >= 0)


@lru_cache(2)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def signature_rows(edits: int):
    """(sig, key, code) for the lines of a batch; the code is twice the segment, and one more for a probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "line"):
            lines = piece.column("line").to_pylist()
            key = piece.column("key").to_numpy()
            size = np.fromiter(map(len, lines), np.int64, len(lines))
            chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            first = np.cumsum(size) - size
            # sums of character times base**place; a substring's hash is a difference moved back to place 0
            n = 1 << max(len(chars), 1 << 21).bit_length()
            chars *= powers(_BASE, n)[: len(chars)]
            sums = np.zeros(len(chars) + 1, np.uint64)
            np.cumsum(chars, out=sums[1:])
            back = powers(_BACK, n)
            sigs, codes = [], []
            for gap, i, shift, side in places(edits):
                start, k = segment(size - gap, i, edits)
                a = first + start + shift
                sigs.append(mixed((sums[a + k] - sums[a]) * back[a] + ((size - gap) * 64 + i).astype(np.uint64)))
                codes.append(np.full(len(size), 2 * i + side, np.int8))
            yield pa.RecordBatch.from_arrays([signed(np.concatenate(sigs)), pa.array(np.tile(key, len(sigs))), pa.array(np.concatenate(codes))], names=["sig", "key", "code"])

    return run


def banded_distances(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """The edit distance of each pair, or edits + 1 where it is larger.

    Bits of a 64-bit word are the rows of a column of the dynamic programme that lie within ``edits`` of the diagonal,
    and a step moves the word one down the diagonal (Hyyro's band); all pairs step together."""
    m, n = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    out = np.full(len(a), edits + 1, np.int64)
    out[np.abs(m - n) <= edits] = -1
    rows = np.flatnonzero(out < 0)
    if not len(rows):
        return out
    m, n = m[rows], n[rows]
    pad = edits
    width, height = int(n.max()), int(m.max()) + 2 * pad + edits + 2
    left, right = np.zeros((len(rows), height), np.uint32), np.zeros((len(rows), width), np.uint32)
    for r, i in enumerate(rows):
        left[r, pad : pad + len(a[i])] = np.frombuffer(a[i].encode("utf-32-le", "surrogatepass"), np.uint32) + 1
        right[r, : len(b[i])] = np.frombuffer(b[i].encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    one = np.uint64(1)
    vp = np.full(len(rows), (((1 << 64) - 1) << (63 - edits)) & ((1 << 64) - 1), np.uint64)
    vn = np.zeros(len(rows), np.uint64)
    now = np.full(len(rows), edits, np.int64)
    for j in range(width):
        match = np.zeros(len(rows), np.uint64)
        for t in range(2 * edits + 1):  # row j - edits + t, in bit 63 - 2 edits + t
            c = left[:, min(j + t, height - 1)]
            match |= np.where((c == right[:, j]) & (c > 0), one << np.uint64(63 - 2 * edits + t), np.uint64(0))
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        diagonal, active = j < m - edits, j < n
        down = np.clip(62 - (j - (m - edits)), 0, 63).astype(np.uint64)
        step = np.where(diagonal, 1 - (d0 >> np.uint64(63)).astype(np.int64), ((hp >> down) & one).astype(np.int64) - ((hn >> down) & one).astype(np.int64))
        now += np.where(active, step, 0)
        shifted = d0 >> one
        vp, vn = hn | ~(shifted | hp), hp & shifted
    out[rows] = np.minimum(now, edits + 1)
    return out


def first_segment(a: str, b: str, edits: int) -> int:
    """The first segment of a that b holds at a probed place; a is no longer than b."""
    gap = len(b) - len(a)
    for i in range(edits + 1):
        p, k = segment(len(a), i, edits)
        part = a[p : p + k]
        for shift in range(max(-i, gap - (edits - i)), min(i, gap + edits - i) + 1):
            if b[p + shift : p + shift + k] == part:
                return i
    return -1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = BULK_ROWS) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` rows or one group with each row's group number; groups are runs of equal keys."""
    held: list[pa.RecordBatch] = []

    def numbered(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, bool)
        for k in keys:
            c = t.column(k).to_numpy()
            change[1:] |= c[1:] != c[:-1]
        return np.cumsum(change)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            t = pa.Table.from_batches(held)
            group = numbered(t)
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if cut:
                yield t.slice(0, cut), group[:cut]
                held = t.slice(cut).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, numbered(t)


def character_counts(lines: list[str], size: np.ndarray) -> np.ndarray:
    """How often characters of each of BUCKETS kinds stand in each line."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(lines)), size)
    return np.bincount(row * BUCKETS + chars % BUCKETS, minlength=len(lines) * BUCKETS).reshape(-1, BUCKETS).astype(np.int32)


def verified_links(edits: int):
    """(a, b, n) from the lines that meet under a signature: links that join what is apart (n = 0), and for each line
    (a = b) how many links it has.  Two lines are compared under their first common segment alone, and among a group's
    parts in one pair of parts alone, so a link counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in whole_groups(batches, ["sig", "i", "j"]):
            t = t.combine_chunks()
            key, lines = t.column("key").to_numpy(), t.column("line").to_pylist()
            out: dict[tuple[int, int], int] = {}
            top: dict[int, int] = {}

            def root(x: int, top: dict[int, int] = top) -> int:
                while top.get(x, x) != x:
                    x = top[x]
                return x

            todo = _pairs(t, group, lines, edits)
            while some := list(islice(todo, 2048)):
                near = banded_distances([lines[x] for x, _ in some], [lines[y] for _, y in some], edits) <= edits
                for (x, y), close in zip(some, near, strict=True):
                    if close:
                        a, b = sorted((int(key[x]), int(key[y])))
                        for one in (a, b):
                            out[one, one] = out.get((one, one), 0) + 1
                        if root(a) != root(b):
                            top[root(b)] = root(a)
                            out.setdefault((a, b), 0)
            a, b, n = [x for x, _ in out], [y for _, y in out], list(out.values())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    return run


def _pairs(t: pa.Table, group: np.ndarray, lines: list[str], edits: int) -> Iterator[tuple[int, int]]:
    """Pairs of a group's index and probe rows that are to be verified, many groups at once.  An edit moves two counts
    of characters by one at most, so lines whose counts are further apart than 2 * edits are left out before their
    segments are compared."""
    key, code, own, parts, i, j = (t.column(c).to_numpy() for c in ("key", "code", "own", "parts", "i", "j"))
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    counts = character_counts(lines, size)
    # two lines of one part meet wherever it does: they are compared with the next part alone
    home = (i == j) | (np.where(own == i, j, i) == (own + 1) % parts)
    index, probing = np.flatnonzero(code % 2 == 0), np.flatnonzero(code % 2 == 1)
    first = np.searchsorted(group[probing], group[index])
    many = np.searchsorted(group[probing], group[index], side="right") - first
    done = np.cumsum(many)
    at = 0
    while at < len(index):
        until = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + BULK_PAIRS, side="right")))
        own_many = many[at:until]
        x = np.repeat(index[at:until], own_many)
        y = probing[np.repeat(first[at:until] - (np.cumsum(own_many) - own_many), own_many) + np.arange(own_many.sum())]
        at = until
        gap = size[y] - size[x]
        meets = (key[y] != key[x]) & (code[y] == code[x] + 1) & (gap >= 0) & (gap <= edits)
        meets &= (gap > 0) | (key[y] > key[x])  # those as long are met the other way round
        meets &= home[x] | (own[y] != own[x])
        x, y = x[meets], y[meets]
        alike = np.abs(counts[x] - counts[y]).sum(axis=1) <= 2 * edits
        for one, other in zip(x[alike].tolist(), y[alike].tolist(), strict=True):
            if first_segment(lines[one], lines[other], edits) * 2 == code[one]:
                yield one, other


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    key = F.xxhash64("line", F.lit(17))
    # split in a projection of its own: the optimizer would put it into a filter below the explode as well
    lines = docs.select("doc_id", "text").where("text is not null").select("doc_id", F.xxhash64("text").alias("doc"), F.posexplode_outer(F.split("text", "\n")).alias("at", "line"))
    return lines.where(F.length("line") >= min_chars).withColumn("key", key)


def _small(df: DataFrame) -> DataFrame:
    """For a broadcast only where the counted rows (longs) are few; else the plan decides."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def line_links(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n) over keys (64-bit hashes of lines): a < b with n = 0 are links that connect all that is within
    ``edits``, by way of other links or at once; a = b gives the number of all links of a line."""
    spark = docs.sparkSession
    bounded_batches(spark)
    lines = long_lines(docs, max(min_chars, 6 * edits + 6)).select("key", "line")
    signatures = lines.mapInArrow(signature_rows(edits), "sig long, key long, code byte")
    odd = F.col("code") % 2
    met = signatures.groupBy("sig").agg(F.min("key").alias("k1"), F.max("key").alias("k2"), F.min(odd).alias("s1"), F.max(odd).alias("s2"))
    met = keep(met.where("k1 <> k2 and s1 <> s2").select("sig"), "signatures")
    rows = keep(signatures.join(_small(met), "sig").distinct(), "meeting")
    texts = lines.join(_small(keep(rows.select("key").distinct(), "wanted")), "key").groupBy("key").agg(F.first("line").alias("line"))
    parts = rows.groupBy("sig").agg(F.ceil(F.count("*") / PART_LINES).cast("int").alias("parts"))
    dealt = rows.join(parts, "sig").withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("parts = 1 or own <> other")
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).join(texts, "key")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("sig", "i", "j", "key", "code", "own", "parts", "line").repartition(n, "sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return keep(dealt.mapInArrow(verified_links(edits), "a long, b long, n long"), "line-links")


def _first(*columns: str) -> Column:
    return F.min(F.struct(*columns))


def line_places(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, short_copies: bool = False) -> DataFrame:
    """Per different long line, with ``short_copies`` of any length: key, class (a number), place (its first), class_place (its class's first), links."""
    links = line_links(docs, edits, min_chars)
    places = keep(long_lines(docs, 0 if short_copies else min_chars).groupBy("key").agg(_first("doc_id", "doc", "at").alias("place")), "places")
    labels = components(links.where("a <> b")).select(F.col("node").alias("key"), F.col("label").alias("class"))
    degree = links.where("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
    linked = keep(labels.join(degree, "key").join(places, "key"), "linked")
    firsts = linked.groupBy("class").agg(F.min("place").alias("class_place"))
    linked = linked.join(firsts, "class").select("key", "class", "class_place", "links")
    return places.join(linked, "key", "left").select("key", F.coalesce("class", "key").alias("class"), "place", F.coalesce("class_place", "place").alias("class_place"), F.coalesce("links", F.lit(0)).alias("links"))


def line_report(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, short_copies: bool = False) -> DataFrame:
    """Per document: doc_id, n_lines, n_long, n_kept, n_copies, n_near, n_links.

    n_long counts lines of ``min_chars`` characters or more; n_copies those (with ``short_copies`` lines of any length,
    blank ones too) that equal a line at an earlier place; n_near those that differ from all earlier ones but belong to
    an earlier line's class; n_kept all other lines, the other short ones included; n_links the links of the lines that have their first place here.  A null text has no lines, an
    empty one has one.  Equal rows (doc_id and text) share their places and each get a row.  Null doc_ids come first.
    Columns besides doc_id and text are not read."""
    docs = docs.select("doc_id", "text")
    here = line_places(docs, edits, min_chars, short_copies).groupBy("place.doc_id", "place.doc").agg(F.count("*").alias("firsts"), F.sum((F.col("place") == F.col("class_place")).cast("int")).alias("leading"), F.sum("links").alias("links"))
    here = here.withColumnsRenamed({"doc_id": "_id", "doc": "_doc"})
    many = F.filter(F.split("text", "\n"), lambda x: F.length(x) >= min_chars)
    rows = docs.select("doc_id", F.xxhash64("text").alias("doc"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"), F.coalesce(F.size(many), F.lit(0)).alias("n_long"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0))).withColumn("n_long", F.greatest("n_long", F.lit(0)))
    out = rows.join(here, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc") == F.col("_doc")), "left").na.fill(0, ["firsts", "leading", "links"])
    copies, near = F.col("n_lines" if short_copies else "n_long") - F.col("firsts"), F.col("firsts") - F.col("leading")
    return out.select("doc_id", "n_lines", "n_long", (F.col("n_lines") - copies - near).alias("n_kept"), copies.alias("n_copies"), near.alias("n_near"), F.col("links").alias("n_links"))


def without_repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, short_copies: bool = False) -> DataFrame:
    """``docs`` with the texts that are left: lines that stay, in order.  A null text stays null."""
    leading = line_places(docs.select("doc_id", "text"), edits, min_chars, short_copies).where("place = class_place")
    own = {x: fresh(docs, x) for x in ("_id", "_doc", "_stays")}
    stays = leading.groupBy(F.col("place.doc_id").alias(own["_id"]), F.col("place.doc").alias(own["_doc"])).agg(F.collect_set("place.at").alias(own["_stays"]))
    joined = docs.join(stays, docs["doc_id"].eqNullSafe(F.col(own["_id"])) & (F.xxhash64(docs["text"]) == F.col(own["_doc"])), "left")
    lines = F.filter(F.split("text", "\n"), lambda x, i: (F.length(x) < (0 if short_copies else min_chars)) | F.coalesce(F.array_contains(own["_stays"], i), F.lit(False)))
    return joined.withColumn("text", F.array_join(lines, "\n")).select(*docs.columns)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"), short_copies=True)
