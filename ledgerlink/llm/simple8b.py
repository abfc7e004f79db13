"""Token-ID output in Simple-8b words (operator 3).

A block holds up to ``BLOCK_IDS`` ids, packed into 64-bit words: the top four bits are the selector, the other 60 hold
as many ids as the selector says, the first id lowest.  Each block starts a new word, and the header lists the word at
which each block starts, so blocks decode apart from each other and a whole chunk decodes with array operations.

Selectors (fixed values): 0 is the escape, whose low bits number an entry of the raw 64-bit words behind the packed
ones; it carries one id of 2**60 or more.  Selector k > 0 packs COUNTS[k] ids of WIDTHS[k] bits.

Chunk layout, little-endian: magic ``S8B1``, uint32 ids, uint32 blocks, uint32 words, uint32 escapes, uint32 first
word of each block, padding to eight bytes, uint64 words, uint64 escapes.

The files are Parquet tables of chunks in ascending doc_id order, written by Spark's committer, so a lost executor
costs a task and leaves no half file.  A chunk holds whole documents; a document is one chunk at least.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import bounded_batches, coded, keep, pieces, word_lists

BLOCK_IDS = 1024
CHUNK_IDS = 1 << 17
PIECE_BYTES = 6 << 20  # of text whose distinct words are looked up together
MAGIC = b"S8B1"
# Ids per word and bits per id, by selector.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], np.int64)
LAST = 14


def encode(ids: np.ndarray) -> bytes:
    """The ids (unsigned 64-bit) as one chunk."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    at = np.arange(n, dtype=np.int32)
    end = np.minimum((at // BLOCK_IDS + 1) * BLOCK_IDS, n)
    choice = np.zeros(n, np.int8)  # stays 0, the escape, where not even 60 bits are enough
    left, values = at, ids
    for k in range(LAST, 0, -1):  # the last that fits is the one that packs most
        narrow = values < np.uint64(1 << int(WIDTHS[k]))
        if len(left) == n and narrow.all():
            choice[:] = k
            continue
        left, values = left[narrow], values[narrow]
        if not len(left):
            break
        # left has the ids that are narrow enough, in runs; a word fits where its run is long enough
        breaks = np.flatnonzero(np.diff(left) != 1)
        run_ends = np.append(left[breaks], left[-1]) + 1
        until = np.repeat(run_ends, np.diff(breaks, prepend=-1, append=len(left) - 1))
        choice[left[until >= np.minimum(left + int(COUNTS[k]), end[left])]] = k
    after = np.append(np.minimum(at + COUNTS[choice].astype(np.int32), end), n).astype(np.int32)
    # from word to word, in all blocks at once; n stands for a block that is done
    block = np.arange(0, n, BLOCK_IDS, dtype=np.int32)
    until = np.minimum(block + BLOCK_IDS, n)
    steps = [block]
    while (block < n).any():
        block = after[block]
        block = np.where(block >= until, np.int32(n), block)
        steps.append(block)
    start = np.stack(steps, axis=1).ravel() if n else np.zeros(0, np.int32)
    start = start[start < n].astype(np.int64)
    chosen = choice[start].astype(np.int64)
    words = np.zeros(len(start), np.uint64)
    escapes = ids[start[chosen == 0]]
    words[chosen == 0] = np.arange(len(escapes), dtype=np.uint64)
    for k in np.unique(chosen[chosen > 0]):
        rows = np.flatnonzero(chosen == k)
        place = start[rows][:, None] + np.arange(COUNTS[k])
        inside = place < end[start[rows]][:, None]
        values = np.where(inside, ids[np.minimum(place, n - 1)], np.uint64(0))
        shift = (np.arange(COUNTS[k]) * WIDTHS[k]).astype(np.uint64)
        words[rows] = np.bitwise_or.reduce(values << shift, axis=1) | np.uint64(int(k) << 60)
    firsts = np.searchsorted(start, np.arange(0, n, BLOCK_IDS)).astype("<u4")
    head = MAGIC + struct.pack("<4I", n, len(firsts), len(words), len(escapes)) + firsts.tobytes()
    return head + b"\0" * (-len(head) % 8) + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()


def decode(chunk: bytes) -> np.ndarray:
    """The ids of a chunk; all its blocks are decoded together, by selector."""
    if chunk[:4] != MAGIC:
        raise ValueError("not a Simple-8b chunk")
    n, blocks, n_words, n_escapes = struct.unpack_from("<4I", chunk, 4)
    firsts = np.frombuffer(chunk, "<u4", blocks, 20).astype(np.int64)
    at = 20 + 4 * blocks
    at += -at % 8
    words = np.frombuffer(chunk, "<u8", n_words, at)
    escapes = np.frombuffer(chunk, "<u8", n_escapes, at + 8 * n_words)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    before = np.cumsum(COUNTS[chosen]) - COUNTS[chosen]
    block = np.searchsorted(firsts, np.arange(n_words), side="right") - 1
    place = block * BLOCK_IDS + before - before[firsts][block] if n_words else before
    end = np.minimum((block + 1) * BLOCK_IDS, n)
    out = np.zeros(n, np.uint64)
    out[place[chosen == 0]] = escapes[words[chosen == 0].astype(np.int64)]
    for k in np.unique(chosen[chosen > 0]):
        rows = chosen == k
        shift = (np.arange(COUNTS[k]) * WIDTHS[k]).astype(np.uint64)
        values = (words[rows][:, None] >> shift) & np.uint64((1 << int(WIDTHS[k])) - 1)
        to = place[rows][:, None] + np.arange(COUNTS[k])
        inside = to < end[rows][:, None]
        out[to[inside]] = values[inside]
    return out


_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_ENDED = re.compile("(.*[a-z\u00df-\u00f6\u00f8-\u00ff])([.,])", re.DOTALL)


class WordIds:
    """The ids of texts, through the tokenizers library.

    For a vocabulary that lower-cases, drops white space, splits letters from other marks and marks word ends, as the
    named file does, a text's ids are those of its words one after the other, and those of a word and of the full stop
    or comma behind it.  Each distinct word goes through the library once and is remembered, up to ``most`` words at a
    time; words of plain lower-case letters, one piece each, go through it many at once and are told apart by their
    ends.  ``by_word`` tells whether the file at hand does all that; where not, whole texts are encoded."""

    def __init__(self, path: str, end_id: int, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.whole, self.end_id, self.most, self.known = Tokenizer.from_file(path), end_id, most, {}
        vocabulary = self.whole.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.by_word = self.splits_words()

    def splits_words(self) -> bool:
        apart = ["river", ",", "stones", ".", "\u00e9t\u00e9", "ab", "!?", "%%%", "ab", "|", "x"]
        one = [self.encoded([w])[0].ids for w in apart]
        together = self.encoded(["River, \t\nSTONES. \x0b\u00c9t\u00e9 ab!?\n%%%ab | x"])[0].ids
        ends = all(self.is_end[ids].sum() == 1 and self.is_end[ids[-1]] for w, ids in zip(apart, one, strict=True) if _PLAIN.fullmatch(w))
        return together == [i for ids in one for i in ids] and ends

    def encoded(self, texts: list[str]) -> list:
        return self.whole.encode_batch_fast(texts, add_special_tokens=False)

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words, as bytes: the garbage collector passes them over."""
        plain, rest, is_plain = [], [], _PLAIN.fullmatch
        for w in words:
            (plain if is_plain(w) else rest).append(w)
        groups = [plain[i : i + 2048] for i in range(0, len(plain), 2048)]
        for group, e in zip(groups, self.encoded([" ".join(g) for g in groups]), strict=True):
            ids = np.array(e.ids, np.uint32)
            cuts = [0, *(4 * (np.flatnonzero(self.is_end[ids]) + 1)).tolist()]
            raw = ids.tobytes()
            self.known.update(zip(group, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        for i in range(0, len(rest), 2048):
            some = rest[i : i + 2048]
            self.known.update(zip(some, [array("I", e.ids).tobytes() for e in self.encoded(some)], strict=True))

    def ids_of(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.known]
        if len(self.known) + 2 * len(new) > self.most:
            self.known, new = {}, words
        known = self.known
        ended = [w for w in new if w[-1] in ".," and _ENDED.fullmatch(w)]
        wanted = set(new).difference(ended)
        wanted.update(w[:-1] for w in ended)
        wanted.update(".," if ended else "")
        self.learn(wanted - known.keys())
        for w in ended:
            known[w] = known[w[:-1]] + known[w[-1]]
        return [known[w] for w in words]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, the end id behind each, and how many each text has."""
        if not self.by_word:
            lists = [[*e.ids, self.end_id] for e in self.encoded([x or "" for x in texts.to_pylist()])]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter((i for ids in lists for i in ids), np.int64, int(sizes.sum())), sizes
        words, counts = word_lists(texts)
        code, distinct = coded(pc.ascii_lower(words))
        lists = [*self.ids_of(distinct), array("I", [self.end_id]).tobytes()]
        size = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        pool = np.frombuffer(b"".join(lists), np.uint32).astype(np.int64)
        first = np.cumsum(size) - size
        ends = np.cumsum(counts + 1)
        row = np.full(int(ends[-1]) if len(ends) else 0, len(distinct), np.int64)
        is_word = np.ones(len(row), bool)
        is_word[ends - 1] = False
        row[is_word] = code
        sizes = size[row]
        until = np.cumsum(sizes)
        ids = pool[np.repeat(first[row] - until + sizes, sizes) + np.arange(until[-1] if len(until) else 0)]
        return ids, np.diff(until[ends - 1], prepend=0)


@lru_cache(1)
def word_ids(path: str, end_id: int) -> WordIds:
    """One for each Python worker, so that the words it knows serve its next task."""
    return WordIds(path, end_id)


CHUNKS = "part int, chunk int, first_id long, doc_ids array<long>, lens array<long>, payload binary"


def chunk_writer(path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        to_ids, part = word_ids(path, end_id), TaskContext.get().partitionId()
        chunk = first = held = 0
        docs, lens, ids = [], [], []

        def closed() -> pa.RecordBatch:
            nonlocal chunk, first, held
            payload = encode(np.concatenate(ids))
            row = {"part": part, "chunk": chunk, "first_id": first, "doc_ids": list(docs), "lens": list(lens), "payload": payload}
            chunk, first, held = chunk + 1, first + held, 0
            docs.clear(), lens.clear(), ids.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("payload", pa.binary())])
        for piece in pieces(batches, most=PIECE_BYTES):
            flat, sizes = to_ids(piece.column("text"))
            names, until = piece.column("doc_id").to_pylist(), np.cumsum(sizes)
            a = 0
            while a < len(names):
                # as many documents as fill the chunk
                room = CHUNK_IDS - held + (until[a - 1] if a else 0)
                b = min(int(np.searchsorted(until, room)) + 1, len(names))
                docs += names[a:b]
                lens += sizes[a:b].tolist()
                ids.append(flat[(until[a - 1] if a else 0) : until[b - 1]])
                held += len(ids[-1])
                a = b
                if held >= CHUNK_IDS:
                    yield closed()
        if docs:
            yield closed()

    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, partitions: int | None = None) -> DataFrame:
    """Encode every whole text, append ``end_id`` to each document, and write the ids as Simple-8b chunks in ascending
    doc_id order (null ids first, equal ids by a hash of the text).  Returns the written files as a table of chunks."""
    spark = docs.sparkSession
    bounded_batches(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", tie.alias("tie")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return keep(ordered.drop("tie").mapInArrow(chunk_writer(tokenizer_path, end_id), CHUNKS), "token-files")


def read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = decode(row["payload"]).astype("<u4")
            until = np.cumsum(row["lens"])
            starts = until - np.array(row["lens"], np.int64)
            crc = [zlib.crc32(memoryview(ids[a:b])) for a, b in zip(starts, until, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]] * len(crc), pa.int32()), pa.array(row["first_id"] + starts), pa.array(row["doc_ids"], pa.int64()), pa.array(row["lens"], pa.int64()), pa.array(crc, pa.int64())], names=["part", "start", "doc_id", "n_tokens", "ids_crc32"])


def token_index(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    bounded_batches(files.sparkSession)
    ids = F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = files.groupBy("part").agg(F.max(F.col("first_id") + ids).alias("ids"))  # one row for each file part
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    rows = files.select("part", "first_id", "doc_ids", "lens", "payload").mapInArrow(read_documents, "part int, start long, doc_id long, n_tokens long, ids_crc32 long")
    return rows.join(before, "part").select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` and return their index, read back from the files.

    Null and empty texts give the end id alone; equal doc_ids each keep a row; extra columns are left out; an empty
    table gives no rows."""
    return token_index(write_token_files(docs, tokenizer_path, end_id))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlink.llm.common import read

    return token_output(read(spark, sf_dir, "documents"), vocabulary())
