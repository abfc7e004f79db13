"""Mixing sources to target weights by iterative proportional fitting (operator 5).

Targets name the share of tokens that the mix should have by source, by language and by topic; ``*`` stands for every
value that is not named.  Documents fall into cells (source, language, topic) over the named values, so there are as
many cells as the targets allow, whatever the data.  Raking multiplies the cells' weights to meet each marginal in turn
until all three hold.  A document is then sampled with the probability weight / largest weight, by a hash of its id
and text: the largest sample without repeats whose expected tokens have the target shares.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import fresh, read

Targets = Mapping[str, Mapping[str, float]]

#: The registered mix: the hot source down, the smaller languages and forms of text as given.
TARGETS: Targets = {
    "source": {"src0": 0.1, "*": 0.9},
    "lang": {"en": 0.6, "de": 0.14, "fr": 0.15, "*": 0.11},
    "topic": {"prose": 0.95, "*": 0.05},
}
SEED = 11
#: Of the registered mix and the pipeline: a cell weighs at most this many times the mean, so that a target which few
#: tokens must meet doesn't empty the rest.
MOST_WEIGHT = 8.0


def topic(text: Column) -> Column:
    """A document's form as its topic: table, shout, contact or prose."""
    return F.when(text.contains("|"), "table").when(text.contains("!!"), "shout").when(text.rlike("https?://|\\S@\\S"), "contact").otherwise("prose")


def tokens(text: Column) -> Column:
    """The words of a text, and one for its end."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def rake(cells: np.ndarray, totals: np.ndarray, targets: list[np.ndarray], rounds: int = 500, close: float = 1e-10, most: float = np.inf) -> np.ndarray:
    """Weights for cells (rows of value numbers, one column a dimension) that give their totals the target shares.

    Targets of values without tokens are spread over the others of their dimension.  Where the cells can't meet all
    targets at once, or not with weights of ``most`` times the mean at most, the weights are those after the last round."""
    share = totals / max(totals.sum(), 1)
    goals = []
    for d, t in enumerate(targets):
        there = np.bincount(cells[:, d], totals, len(t)) > 0
        goals.append(np.where(there, t, 0) / max(t[there].sum(), 1e-300))
    weights = np.ones(len(cells))
    for _ in range(rounds):
        off = 0.0
        for d, goal in enumerate(goals):
            now = np.bincount(cells[:, d], share * weights, len(goal))
            off = max(off, float(np.abs(now - goal).max(initial=0)))
            weights = np.minimum(weights * (goal / np.where(now > 0, now, 1))[cells[:, d]], most)
        if off < close:
            break
    return weights


def mixed_sample(docs: DataFrame, targets: Targets = TARGETS, seed: int = SEED, most_weight: float | None = None) -> DataFrame:
    """``docs`` with cell columns (mix_source, mix_lang, mix_topic), mix_tokens, mix_weight, mix_probability, mix_taken.

    ``most_weight`` bounds a cell's weight, so that a target that few tokens must meet doesn't empty the rest; unset,
    weights have no bound.  ``shares_reached`` tells what a bound or contrary targets leave unmet.

    Null sources and languages count as ``*``; a null text is prose of one token.  Values that no target covers (no
    ``*``) have probability 0.  An empty table gives no rows.  The driver gets one row for each cell."""
    dims = list(targets)
    of = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.coalesce("text", F.lit("")))}
    cell = {d: F.when(of[d].isin([v for v in targets[d] if v != "*"]), of[d]).otherwise(F.lit("*")).alias(f"mix_{d}") for d in dims}
    names = [f"mix_{d}" for d in dims]
    counted = docs.select("*", *cell.values(), tokens(F.col("text")).alias("mix_tokens"))
    sums = counted.groupBy(*names).agg(F.sum("mix_tokens").alias("n")).collect()  # bounded by the targets
    rows = sorted(tuple(r) for r in sums if all(r[i] in targets[d] for i, d in enumerate(dims)))
    values = [sorted(targets[d]) for d in dims]
    numbers = np.array([[values[i].index(r[i]) for i in range(len(dims))] for r in rows], np.int64).reshape(-1, len(dims))
    weights = rake(numbers, np.array([r[-1] for r in rows], float), [np.array([targets[d][v] for v in values[i]], float) for i, d in enumerate(dims)], most=np.inf if most_weight is None else most_weight)
    top = max(weights.max(initial=0.0), 1e-300)
    table = [(*r[:-1], float(w), float(w / top)) for r, w in zip(rows, weights, strict=True)]
    schema = ", ".join(f"{n} string" for n in names) + ", mix_weight double, mix_probability double"
    found = counted.join(F.broadcast(docs.sparkSession.createDataFrame(table, schema)), names, "left").na.fill(0.0, ["mix_weight", "mix_probability"])
    draw = F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    return found.withColumn("mix_taken", draw < F.col("mix_probability"))


def shares_reached(sample: DataFrame, targets: Targets = TARGETS) -> DataFrame:
    """dimension, value, target, expected and drawn share of tokens, out of ``mixed_sample``."""
    cells = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"mix_{d}").alias("value")) for d in targets]))
    each = sample.select(cells.alias("x"), "mix_tokens", "mix_probability", "mix_taken").groupBy("x.dimension", "x.value").agg(
        F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("e"), F.sum(F.when(F.col("mix_taken"), F.col("mix_tokens")).otherwise(0)).alias("n"))
    whole = each.groupBy("dimension").agg(F.sum("e").alias("all_e"), F.sum("n").alias("all_n"))  # a row for each dimension
    goal = F.create_map(*[F.lit(x) for d, t in targets.items() for v, share in t.items() for x in (f"{d}={v}", float(share))])
    name = F.concat("dimension", F.lit("="), "value")
    out = each.join(whole, "dimension").select("dimension", "value", F.coalesce(F.try_element_at(goal, name), F.lit(0.0)).alias("target"), (F.col("e") / F.col("all_e")).alias("expected"), (F.col("n") / F.col("all_n")).alias("drawn"))
    return out


def mix(docs: DataFrame, targets: Targets = TARGETS, seed: int = SEED, most_weight: float | None = None) -> DataFrame:
    """The sampled rows, with the columns of ``docs``, also those named like the ones of ``mixed_sample``."""
    aside = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower().startswith("mix_")}
    out = mixed_sample(docs.withColumnsRenamed(aside), targets, seed, most_weight).where("mix_taken")
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sample(read(spark, sf_dir, "documents"), most_weight=MOST_WEIGHT).select("doc_id", "mix_source", "mix_lang", "mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_taken")
