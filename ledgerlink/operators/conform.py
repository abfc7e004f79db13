"""Final column conform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conform(df: DataFrame, columns: list[str], fill: str = "(NULL)") -> DataFrame:
    """Add absent columns as ``fill``, fill nulls of string columns, keep ``columns`` order."""
    types = dict(df.dtypes)
    out = []
    for c in columns:
        if c not in types:
            out.append(F.lit(fill).alias(c))
        elif types[c] == "string":
            out.append(F.coalesce(F.col(c), F.lit(fill)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def first_existing(df: DataFrame, candidates: list[str]) -> str:
    """The first candidate column present (schema lookup, no data read)."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {candidates} in {df.columns}")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """H1: concatenate frames with differing columns (missing ones null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
