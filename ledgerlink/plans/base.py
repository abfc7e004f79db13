"""Shared helpers for the registered plans over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_pad6(expr: str) -> str:
    """DuckDB twin of keys.pad_bin for 6 characters."""
    return (f"(CASE WHEN length(CAST({expr} AS VARCHAR)) < 6 "
            f"THEN lpad(CAST({expr} AS VARCHAR), 6, '0') ELSE CAST({expr} AS VARCHAR) END)")


def param_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small caller-parameter table built JVM-side (inline literals): no
    Python worker is started to scan it, and the planner knows its size."""
    from pyspark.sql import functions as F
    structs = [F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def sql_visible_text(html: str) -> str:
    """DuckDB twin of text.visible_text, for an SQL expression that holds a page."""
    from ..functions import text as T

    # RE2 has no back-references: one alternative for each hidden tag
    hidden = [r"<!--.*?(?:-->|$)"] + [rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|$)" for t in T.HIDDEN_TAGS]
    v = f"regexp_replace({html}, '(?is){'|'.join(hidden)}', ' ', 'g')"
    v = f"regexp_replace({v}, '{T.INLINE_TAGS}', '', 'g')"
    v = f"regexp_replace({v}, '(?s)</?[A-Za-z!][^>]*(?:>|$)', ' ', 'g')"
    dec, hexa = (f"regexp_extract(p, '{x}', 1)" for x in (r"^(\d{1,7});", "^[xX]([0-9A-Fa-f]{1,6});"))
    code = f"CASE WHEN {dec} <> '' THEN CAST({dec} AS INTEGER) WHEN {hexa} <> '' THEN CAST('0x' || {hexa} AS INTEGER) ELSE 0 END"
    char = (f"CASE WHEN i = 1 THEN p WHEN ({code}) BETWEEN 1 AND 1114111 AND ({code}) NOT BETWEEN 55296 AND 57343 "
            f"THEN chr({code}) || regexp_replace(p, '^[xX]?[0-9A-Fa-f]+;', '') ELSE '&#' || p END")
    v = f"array_to_string(list_transform(string_split({v}, '&#'), lambda p, i: {char}), '')"
    for name, c in T.REFERENCES.items():
        v = f"replace({v}, '&{name};', chr({ord(c)}))"
    return f"trim(regexp_replace({v}, '[{T.UNICODE_SPACES}]+', ' ', 'g'))"
