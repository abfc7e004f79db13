"""Stages tried in order, each for the keys that are still open."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: The open keys -> one row for each key that the stage resolves: the key and the answer's columns.
Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def climb(keys: DataFrame, key: str, stages: list[Stage], answer: list[str]) -> DataFrame:
    """Every row of ``keys`` with the ``answer`` of the first stage that has one, that stage's number (from 1) and name;
    a key that no stage resolves has stage 0, 'none' and nulls.

    ``key`` identifies a row and is never null.  A stage gets open keys only, so late and costly stages run on what the
    early ones left.  Each stage's answers are written once, to the checkpoint folder: the next stages' anti-joins read
    them there, and a lost executor costs tasks of one stage."""
    open_, found = keys, None
    for number, (name, resolve) in enumerate(stages, 1):
        answers = resolve(open_).select(key, *answer, F.lit(number).alias("stage_no"), F.lit(name).alias("stage"))
        # a checkpoint keeps the identity of the keys that came through; the anti-join needs columns of its own
        answers = cut_lineage(answers.select(*[F.col(c).alias(f"_{c}") for c in answers.columns]))
        answers = answers.select(*[F.col(c).alias(c[1:]) for c in answers.columns])
        open_ = open_.join(answers.select(key), key, "left_anti")
        found = answers if found is None else found.unionByName(answers)
    out = keys.join(found, key, "left") if found is not None else keys
    return out.withColumns({"stage_no": F.coalesce("stage_no", F.lit(0)), "stage": F.coalesce("stage", F.lit("none"))})
