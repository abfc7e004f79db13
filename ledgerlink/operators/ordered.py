"""Ordered operators (F1-F5, F9): backfills, running values, gap fills, line merge.

The reference writes these as Python loops over sorted lists.  Here:

* F1/F2/F3 reduce each group with a combinable ``min(struct(order, value))``
  aggregate and join the result back, so a group holding a third of all rows
  is combined map-side instead of sorted in one task.
* F4 is a segmented scan: a window inside (group, block) ranges, a per-block
  summary, and sweeps up and down over levels of block summaries.  With
  ``block_col=None`` it is one plain window (fine when groups are bounded,
  e.g. one page of one document).
* F5 works inside the row (one text): array functions plus one regex, no
  shuffle at all.
* F9 works inside the row too: the lines between two key lines are a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Python's str.strip() whitespace set, so stripping agrees with
# the reference on every character.
PY_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def py_strip(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, f"^{PY_WS}+|{PY_WS}+$", "")


def _first_non_empty(value: str, order: list[Column]) -> Column:
    """min over struct(order..., stripped value) of rows whose value is non-empty."""
    v = F.col(value)
    return F.min(F.when(F.length(v) > 0, F.struct(*order, py_strip(v).alias("v"))))


def first_values(df: DataFrame, doc_col: str, fields: list[str], page_col: str | None = "page_no",
                 seq_col: str = "seq") -> DataFrame:
    """The aggregate of F1/F2: per document and field ``struct(order..., v)`` of its first non-empty value, or null.
    The least of two such structs is that of their rows together, so partial results merge with ``min``."""
    # rows without a page number come after all pages
    order = ([F.col(page_col).isNull().alias("n"), F.col(page_col).alias("p")] if page_col else []) \
        + [F.col(seq_col).alias("s")]
    return df.groupBy(doc_col).agg(*[_first_non_empty(f, order).alias(f) for f in fields])


def doc_backfill(df: DataFrame, doc_col: str, fields: list[str], page_col: str | None = "page_no",
                 seq_col: str = "seq") -> DataFrame:
    """F1 (``page_col`` given) / F2 (``page_col=None``: arrival order).

    Per document and field: the first non-empty value (emptiness tested before
    stripping, so ' ' can win and yields ''), stripped, written to every row;
    '' when the document has none.  Rows without a document are dropped.
    """
    rows = df.where(F.col(doc_col).isNotNull())
    firsts = first_values(rows, doc_col, fields, page_col, seq_col)
    out = rows.join(firsts.select(doc_col, *[F.col(f).alias(f"_bf_{f}") for f in fields]), doc_col)
    for f in fields:
        out = out.withColumn(f, F.coalesce(F.col(f"_bf_{f}.v"), F.lit(""))).drop(f"_bf_{f}")
    return out


def running_first(df: DataFrame, group_col: str, fields: list[str], seq_col: str = "seq") -> DataFrame:
    """rows before the first usable value keep theirs; from it on, every row
    gets that first value (stripped).  A value is usable when it is non-empty
    after stripping."""
    firsts = df.groupBy(group_col).agg(*[
        F.min(F.when(F.length(py_strip(f)) > 0, F.struct(F.col(seq_col).alias("s"), py_strip(f).alias("v"))))
        .alias(f"_rf_{f}") for f in fields])
    out = df.join(firsts, group_col, "left")
    for f in fields:
        hit = F.col(f"_rf_{f}")
        out = out.withColumn(f, F.when(hit.isNotNull() & (F.col(seq_col) >= hit["s"]), hit["v"])
                             .otherwise(F.col(f))).drop(f"_rf_{f}")
    return out


def last_before(df: DataFrame, part_cols: list[str], order_col: str, value_col: str, out_col: str,
                block_col: str | None = None, fan: int = 1024) -> DataFrame:
    """Last non-null ``value_col`` strictly before each row within ``part_cols``.

    ``block_col`` (monotone in ``order_col`` within a partition, e.g.
    ``order // 4096``) splits hot partitions: each window sorts one block only,
    and values reach later blocks by levels of ``fan`` (see ``_carried``).
    """
    v = F.col(value_col)
    if block_col is None:
        w = Window.partitionBy(*part_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out_col, F.last(v, ignorenulls=True).over(w))
    inner = (Window.partitionBy(*part_cols, block_col).orderBy(order_col)
             .rowsBetween(Window.unboundedPreceding, -1))
    local = df.withColumn("_lb_local", F.last(v, ignorenulls=True).over(inner))
    # one row per block, with or without values
    summary = df.groupBy(*part_cols, block_col).agg(F.max(F.when(v.isNotNull(), F.struct(F.col(order_col).alias("o"), v.alias("v")))).alias("_lb_last"))
    span = df.agg(F.max(block_col) - F.min(block_col)).first()[0] or 0
    carry = _carried(summary, part_cols, block_col, int(span), fan)
    out = local.join(carry, [*part_cols, block_col], "left")
    return out.withColumn(out_col, F.coalesce(F.col("_lb_local"), F.col("_lb_carry")["v"])) \
              .drop("_lb_local", "_lb_carry")


def _carried(summary: DataFrame, part_cols: list[str], block_col: str, span: int, fan: int) -> DataFrame:
    """The last value before each block, out of one summary row per block (``_lb_last``), as ``_lb_carry``.

    Up-sweep: ``fan`` neighbouring blocks are summed up to one of the next level until a group has ``fan`` blocks at
    most; down-sweep: a block takes what lies before it among its neighbours, or what its group of blocks was carried.
    No window holds more than ``fan`` rows of a hot group."""
    last = F.col("_lb_last")
    if span < fan:
        before = Window.partitionBy(*part_cols).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
        return summary.select(*part_cols, block_col, F.last(last, ignorenulls=True).over(before).alias("_lb_carry"))
    up = f"_{block_col}_up"
    grouped = summary.withColumn(up, F.floor(F.col(block_col) / fan))
    before = Window.partitionBy(*part_cols, up).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.select(*part_cols, up, block_col, F.last(last, ignorenulls=True).over(before).alias("_lb_inside"))
    above = _carried(grouped.groupBy(*part_cols, up).agg(F.max(last).alias("_lb_last")), part_cols, up, span // fan + 1, fan)
    return inside.join(above, [*part_cols, up], "left").select(*part_cols, block_col, F.coalesce("_lb_inside", "_lb_carry").alias("_lb_carry"))


def gap_fill(df: DataFrame, part_cols: list[str], order_col: str, bin_col: str = "bin", pcn_col: str = "pcn",
             block_col: str | None = None, fan: int = 1024) -> DataFrame:
    """a row with a PCN and no BIN takes the last BIN above it in its scope.

    Scope (D12) is the caller's ``part_cols``: (document, page) by default in
    the jobs; ``[page]`` alone reproduces the reference's leak across documents.
    Empty BINs count as missing, empty PCNs as absent.
    """
    b = F.col(bin_col)
    src = df.withColumn("_gf_bin", F.when(F.length(b) > 0, b))
    filled = last_before(src, part_cols, order_col, "_gf_bin", "_gf_prev", block_col, fan)
    need = (b.isNull() | (F.length(b) == 0)) & (F.length(F.col(pcn_col)) > 0)
    return filled.withColumn(bin_col, F.when(need & F.col("_gf_prev").isNotNull(), F.col("_gf_prev"))
                             .otherwise(b)).drop("_gf_bin", "_gf_prev")


# The field labels that stop a wrapped-line merge.
FIELD_LABELS = "BIN|PCN|GRP|Effective"


def merge_wrapped_lines(df: DataFrame, text_col: str, out_col: str, min_digits: int = 5,
                        max_len: int = 40, labels: str = FIELD_LABELS) -> DataFrame:
    """a line without a run of ``min_digits`` digits absorbs the next line
    when that one is shorter than ``max_len`` and holds no field label; a line
    absorbs at most one.  Lines are stripped; the result is joined by newlines.

    Greedy merging takes every other edge of a run of mergeable edges; that is
    exactly a left-to-right non-overlapping replace of "11" by "10" over the
    string of edge flags.  O(lines) per text, no shuffle, no Python.  The line
    array and the flag string are materialised as columns first, so lambdas
    index them instead of re-evaluating them per element.
    """
    t = F.col(text_col)
    digits = f"(?U)\\d{{{min_digits},}}"
    lines = F.col("_wl_lines")
    n = F.size(lines)
    idx = F.sequence(F.lit(1), n)

    def edge(j):
        prev = F.element_at(lines, F.greatest(j - 1, F.lit(1)))
        cur = F.element_at(lines, j)
        ok = (j > 1) & ~prev.rlike(digits) & (F.length(cur) < max_len) & ~cur.rlike(labels)
        return F.when(ok, F.lit("1")).otherwise(F.lit("0"))

    taken = F.col("_wl_taken")  # one flag per line, by place

    def out_line(j):
        absorbed = F.element_at(taken, j) == "1"
        nxt = F.when((j < n) & (F.element_at(taken, F.least(j + 1, n)) == "1"),
                     F.concat(F.lit(" "), F.element_at(lines, F.least(j + 1, n))))
        return F.when(~absorbed, F.concat(F.element_at(lines, j), F.coalesce(nxt, F.lit(""))))

    step1 = df.withColumn("_wl_lines", F.transform(F.split(t, "\n", -1), lambda x: py_strip(x)))
    step2 = step1.withColumn("_wl_taken", F.split(F.regexp_replace(F.array_join(F.transform(idx, edge), ""), "11", "10"), "", -1))
    merged = F.array_join(F.filter(F.transform(idx, out_line), lambda x: x.isNotNull()), "\n")
    return step2.withColumn(out_col, F.when(t.isNotNull(), merged)).drop("_wl_lines", "_wl_taken")


def carry_down(df: DataFrame, id_col: str, text_col: str, key_regex: str, code_regex: str) -> DataFrame:
    """F9 (re-aimed): lines of a text; a line with a key starts a block, and
    every line with a code from there to the next key becomes a (key, code) row.

    A block is the slice of lines between two keys, so the scan stays in the
    text's row and takes each line once."""
    found = lambda x, regex: F.nullif(F.regexp_extract(x, regex, 1), F.lit(""))
    lines = F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(
        i.alias("line_no"), found(x, key_regex).alias("key"), found(x, code_regex).alias("code")))
    step1 = df.select(id_col, lines.alias("_cd_lines"))
    step2 = step1.withColumn("_cd_keys", F.filter("_cd_lines", lambda x: x["key"].isNotNull()))

    def block(k, j):
        end = F.coalesce(F.try_element_at("_cd_keys", j + 2)["line_no"], F.size("_cd_lines"))
        own = F.filter(F.slice("_cd_lines", k["line_no"] + 1, end - k["line_no"]), lambda x: x["code"].isNotNull())
        return F.transform(own, lambda x: F.struct(x["line_no"].alias("line_no"), k["key"].alias("key"), x["code"].alias("code")))

    rows = step2.select(id_col, F.explode_outer(F.flatten(F.transform("_cd_keys", block))).alias("_cd")).where(F.col("_cd").isNotNull())
    return rows.select(id_col, "_cd.line_no", "_cd.key", "_cd.code")
