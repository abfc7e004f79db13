"""BPG key functions (BIN~PCN~GRP) as Column expressions.

All functions here build JVM-side expressions: they stay inside whole-stage
codegen and never leave the executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing marker inside a key string and the key separator.
NULL_TOKEN = "NULL"
KEY_SEP = "~"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trim, and read an empty value as missing."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))  # one evaluation of the text for test and value


def parse_bpg(c, null_token: str = NULL_TOKEN) -> Column:
    """``'012345~NULL~ABC'`` -> struct(bin, pcn, grp); the null token and blanks read as null."""
    parts = F.split(_col(c), KEY_SEP, -1)

    def part(i):
        v = F.trim(F.try_element_at(parts, F.lit(i)))
        return F.when((v == null_token) | (v == ""), F.lit(None)).otherwise(v)

    return F.struct(part(1).alias("bin"), part(2).alias("pcn"), part(3).alias("grp"))


def is_valid_bpg(c) -> Column:
    """True when the key has exactly three ``~``-separated parts."""
    return F.coalesce(F.size(F.split(_col(c), KEY_SEP, -1)) == 3, F.lit(False))


def format_bpg(bin_, pcn, grp, null_token: str = NULL_TOKEN) -> Column:
    """struct parts -> ``'bin~pcn~grp'`` with the null token for missing parts."""
    return F.concat_ws(KEY_SEP, *[F.coalesce(blank_to_null(x), F.lit(null_token)) for x in (bin_, pcn, grp)])


def pad_bin(c, width: int = 6) -> Column:
    """Left-pad with zeros to ``width`` without cutting longer values (unlike lpad)."""
    v = _col(c).cast("string")
    return F.lpad(v, F.greatest(F.length(v), F.lit(width)), "0")


def format_bin(c, width: int = 6) -> Column:
    """Cut at the first '.', then pad to ``width``; null and blank stay null."""
    return pad_bin(F.substring_index(blank_to_null(c), ".", 1), width)


def plan_id(bin_, pcn, grp, missing: str = "NA") -> Column:
    """``bin_pcn_grp`` with ``NA`` for missing parts."""
    return F.concat_ws("_", *[F.coalesce(blank_to_null(x), F.lit(missing)) for x in (bin_, pcn, grp)])
