"""A training-data pipeline over ``documents``: each stage is one operator, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import decontaminate, near_dedup, raking, simple8b, toxicity
from ledgerlink.llm.common import fresh, keep, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score 0.5 or more go.  The machine learns from ``labels`` and the given documents."""
    machine = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return toxicity.scored(docs, machine, score).where(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group linked at 0.75 the document with the smallest doc_id stays; of rows equal in doc_id and
    text one.  Rows that repeat a doc_id with another text are judged by their own text; rows without a doc_id stay."""
    id_, key = fresh(docs, "kept_id"), fresh(docs, "kept_key")
    kept = near_dedup.near_rows(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias(id_), F.coalesce("text_key", F.lit(b"")).alias(key)).distinct()
    own = F.coalesce(F.unhex(F.md5(docs["text"])), F.lit(b""))
    stays = docs.join(kept, (docs["doc_id"] == F.col(id_)) & (own == F.col(key)), "left_semi").withColumn(key, F.coalesce(F.unhex(F.md5("text")), F.lit(b"")))
    return stays.dropDuplicates(["doc_id", key]).drop(key).unionByName(docs.where("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: a sample whose tokens have the target shares."""
    return raking.mix(docs, most_weight=raking.MOST_WEIGHT)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token files in the shared folder; the stage returns their index, read back from them."""
    return simple8b.token_output(docs, simple8b.vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: Learning, hashing and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
