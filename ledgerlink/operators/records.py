"""Record operators (L3 L4 L9 pieces: B8 B15-B17 B39 E7 I1 I2 I4)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_symbols, let, outer_brackets, split_cell, strip, strip_code_fences


def explode_cells(df: DataFrame, cols: list[str], blank_all: bool = True) -> DataFrame:
    """L3: split each multi-valued cell (B7), explode the columns one after the
    other (I1; an empty list keeps the row with null), then blank symbol-only
    values in every string column (B8)."""
    out = df
    for c in cols:
        out = out.withColumn(c, split_cell(c))
    for c in cols:
        out = out.withColumn(c, F.explode_outer(c))
    if blank_all:
        out = out.select(*[blank_symbols(c).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes])
    return out


def majority_prefix_strip(df: DataFrame, col: str, prefix: str, threshold: float = 0.8) -> DataFrame:
    """Strip ``prefix`` (and following whitespace) from ``col`` only when more
    than ``threshold`` of all rows start with it.  The ratio is one global
    aggregate used as a scalar subquery; the strip is a narrow projection."""
    ratio = df.agg(F.count_if(F.col(col).startswith(prefix)) / F.count(F.lit(1))).scalar()
    pattern = "^" + re.escape(prefix) + r"\s*"
    return df.withColumn(col, F.when(ratio > threshold, F.regexp_replace(col, pattern, "")).otherwise(F.col(col)))


def parse_records(raw, schema: str) -> Column:
    """Model answer -> array<struct>; fences stripped, outermost [...]
    kept; anything that is not a JSON array (first non-blank '[' and last ']')
    or does not parse yields null."""
    body = strip(outer_brackets(strip_code_fences(raw)))
    return let(body, lambda b: F.when(b.startswith("[") & b.endswith("]"),
                                      F.from_json(b, schema, {"mode": "PERMISSIVE"})))


def parse_pipe_table(raw, width: int = 5, min_parts: int = 1) -> Column:
    """Lines holding '|' -> array<array<string>> of trimmed parts, padded
    with '' to ``width`` plus one trailing link slot; lines with fewer than
    ``min_parts`` parts are skipped."""
    lines = F.filter(F.split(raw if isinstance(raw, Column) else F.col(raw), "\n", -1),
                     lambda ln: ln.contains("|"))
    parts = F.transform(lines, lambda ln: F.transform(F.split(ln, r"\|", -1), lambda p: strip(p)))
    parts = F.filter(parts, lambda p: F.size(p) >= min_parts)
    pad = F.array_repeat(F.lit(""), width)
    return F.transform(parts, lambda p: F.concat(
        p, F.slice(pad, 1, F.greatest(F.lit(width) - F.size(p), F.lit(0))), F.array(F.lit(""))))


def extra_parts(row, width: int = 5) -> Column:
    """The parts of a ``parse_pipe_table`` row beyond its ``width`` columns, without the link slot."""
    p = F.col(row) if isinstance(row, str) else row
    return F.slice(p, width + 1, F.greatest(F.size(p) - 1 - width, F.lit(0)))


# Extraction status codes.
STATUS_SUCCESS, STATUS_PARTIAL, STATUS_NONE = "success", "partial", "none"


def extraction_status(*fields) -> Column:
    """B17: 'success' when all fields are non-empty, 'partial' when some, else 'none'."""
    present = [F.coalesce(F.length(strip(f)) > 0, F.lit(False)) for f in fields]
    all_ = present[0]
    any_ = present[0]
    for p in present[1:]:
        all_ = all_ & p
        any_ = any_ | p
    return F.when(all_, F.lit(STATUS_SUCCESS)).when(any_, F.lit(STATUS_PARTIAL)).otherwise(F.lit(STATUS_NONE))
