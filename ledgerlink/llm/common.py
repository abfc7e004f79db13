"""Helpers shared by the corpus operators: tables in the shared folder, whole words of Arrow batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.session import ensure_checkpoint_dir, ship_package

BATCH_BYTES = 16 << 20
PIECE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes as well as rows, so that very long texts don't add up in a worker; the workers
    get this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset the tests' own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return (named or ensure_checkpoint_dir(spark)).rstrip("/")


def keep(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to a new folder in the shared folder and read it back: it is computed once, its lineage ends
    there, and a lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerlink/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; 0 marks the rows held out from learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts hold about ``most`` bytes (one longer text is a run of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes, dtype=np.int64) // most
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and how many each text has. A word is a run of characters other
    than space, tab, line feed, vertical tab, form feed and carriage return; a null text has none."""
    lists = pc.ascii_split_whitespace(texts)
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    flat, parent = flat.filter(full), parent.filter(full).to_numpy(zero_copy_only=False)
    return flat, np.bincount(parent, minlength=len(texts)).astype(np.int64)


def coded(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """For each word its place in the list of the distinct words, and that list."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def hashes(strings: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(s) for s in strings), np.uint64, len(strings))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift), so that every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or where ``df`` has a column like it (in any case) the first of name_1, name_2, ... that is free."""
    taken, n, out = {c.lower() for c in df.columns}, 0, name
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def plain_name(name: str) -> str:
    return re.sub(r"\W+", "_", name)
