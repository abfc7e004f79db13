"""Broadcasts only behind a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20


def measured(df: DataFrame) -> int:
    """Bytes that the rows take at most in a hash table: the text of string columns, 64 a row and 16 a column for the rest."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    row = F.lit(64 + 16 * len(df.columns))
    for t in texts:
        row = row + t
    return df.agg(F.sum(row)).first()[0] or 0


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it was measured to be small; a larger one is left to a shuffle join, which AQE may
    still turn into a broadcast when its shuffled size allows.  ``df`` is a dimension: it is read once more for this."""
    return F.broadcast(df) if measured(df) <= most else df
