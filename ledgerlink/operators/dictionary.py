"""Dictionary matching in text (C8 C9 C13) as equi-joins plus exact verification.

No text x dictionary nested loop:

* C8 (case-insensitive, word-bounded): lower-cased lines and names are cut where word runs begin and end; a name that
  begins and ends with a word run occurs on word boundaries exactly where its pieces are the line's pieces.  The line's
  pieces are an index by position: they are joined to the names on each name's longest word, and the name is compared
  with the text of as many pieces at its place.  No pattern is compiled for a row.  Other names (no word character at
  an end) take the substring candidates below and the pattern ``(?i)\\b<name>\\b``.
* C9/C13 (plain substring): lines are cut into character q-grams and joined
  to the patterns on each pattern's first q-gram; candidates are verified
  with ``contains``.  Patterns shorter than q are keyed by their whole text
  (texts emit grams of every length up to q), so there is no nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .sizes import BROADCAST_BYTES, measured

# word characters as Java's \b sees them: letters, decimal digits, underscore
WORD_RUN = r"[\p{L}\p{Nd}_]+"
NOT_FOUND = "Not Found"


def _quote(c: Column) -> Column:
    r"""Regex-quote a column value with \Q...\E (an inner \E is split)."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


# where a word run begins or ends
EDGES = r"(?<=[\p{L}\p{Nd}_])(?=[^\p{L}\p{Nd}_])|(?<=[^\p{L}\p{Nd}_])(?=[\p{L}\p{Nd}_])"
FEW_PATTERNS = 64
PIECE_CHARS = 256


def substring_matches(lines: DataFrame, patterns: DataFrame, line_keys: list[str], text_col: str = "text",
                      pattern_col: str = "pattern", q: int = 3, lower: bool = True) -> DataFrame:
    """C9/C13 hits: one row per (line, pattern) where the text contains the
    pattern, with the 1-based ``offset`` of its first occurrence.

    Texts emit their grams of just the key lengths the pattern table holds
    (at most ``q`` values); a pattern is keyed by its first ``min(q, len)``
    characters, so short patterns need no nested loop.  Each candidate is
    verified at its own position.  With a pattern table under the broadcast
    bound the join and the check run in the scan's generated code and a text
    is only copied for real hits; a larger table takes a shuffle join without
    the text and joins the texts back for its candidates only.
    At most FEW_PATTERNS patterns are looked for in each text one by one.
    ``line_keys`` must identify a line.
    """
    low = F.lower if lower else (lambda c: c)
    pcols = patterns.columns
    pt = (patterns.where(F.col(pattern_col).isNotNull() & (F.col(pattern_col) != ""))
          .withColumn("_sm_p", low(F.col(pattern_col))))
    pt = pt.withColumn("_sm_g", F.substring("_sm_p", 1, q))
    stats = pt.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("_sm_g")).alias("ls"),
                   F.max(F.length("_sm_p")).alias("longest")).first()
    whole = lines.select(*line_keys, low(F.col(text_col)).alias("_sm_w")).where(F.col("_sm_w").isNotNull())
    if stats["n"] <= FEW_PATTERNS:
        few = [r[0] for r in pt.select("_sm_p").distinct().collect()]
        places = F.array(*[F.struct(F.lit(p).alias("p"), F.locate(p, F.col("_sm_w")).alias("i")) for p in few]) \
            if few else F.array().cast("array<struct<p:string,i:int>>")
        found = whole.select(*line_keys, F.explode_outer(places).alias("_sm_f")).where(F.col("_sm_f.i") > 0)
        hits = found.select(*line_keys, F.col("_sm_f.p").alias("_sm_p"), F.col("_sm_f.i").alias("_sm_i")) \
            .join(F.broadcast(pt), "_sm_p")
        return hits.groupBy(*line_keys, *pcols).agg(F.min("_sm_i").cast("int").alias("offset"))
    lengths = sorted(stats["ls"])  # at most q values
    # a substring at place i walks i characters, so a long text is cut into
    # pieces first, each overlapping the next by the longest pattern: the work
    # grows with the text's length, not its square
    over = stats["longest"] - 1
    step = max(PIECE_CHARS, over)
    cut = let(F.split("_sm_w", "", -1), lambda chars: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(chars), F.lit(1)) - 1) / step).cast("int")),
        lambda p: F.struct((p * step).alias("at"),
                           F.array_join(F.slice(chars, p * step + 1, F.lit(step + over)), "").alias("text"))))
    txt = whole.select(*line_keys, F.explode_outer(cut).alias("_sm_c")).select(
        *line_keys, F.col("_sm_c.at").alias("_sm_at"), F.col("_sm_c.text").alias("_sm_t"))
    pos = txt.select(*line_keys, "_sm_at", "_sm_t", F.explode(F.sequence(
        F.lit(1), F.greatest(F.least(F.length("_sm_t"), F.lit(step)), F.lit(1)))).alias("_sm_i"))
    grams = pos.select(*line_keys, "_sm_at", "_sm_t", "_sm_i", F.explode(F.array(
        *[F.substring("_sm_t", F.col("_sm_i"), F.lit(L)) for L in lengths])).alias("_sm_g"))
    at_pos = F.substring(F.col("_sm_t"), F.col("_sm_i"), F.length("_sm_p")) == F.col("_sm_p")
    if measured(pt) <= BROADCAST_BYTES:
        hits = grams.join(F.broadcast(pt), "_sm_g").where(at_pos)
    else:
        cand = grams.select(*line_keys, "_sm_at", "_sm_i", "_sm_g").join(pt, "_sm_g")
        hits = cand.join(txt, [*line_keys, "_sm_at"]).where(at_pos)
    return (hits.groupBy(*line_keys, *pcols).agg(F.min(F.col("_sm_at") + F.col("_sm_i")).cast("int").alias("offset")))


def word_matches(lines: DataFrame, names: DataFrame, line_keys: list[str], text_col: str = "line",
                 name_col: str = "name") -> DataFrame:
    """C8 hits: one row per (line, name) where the name occurs as a whole word run.

    ``lines``: line_keys (which identify a line) + text_col; ``names``: name_col (+ any payload).
    Output: line_keys, names' columns, ``offset`` (1-based first position).
    """
    payload = names.columns
    nm = names.where(F.col(name_col).isNotNull() & (F.trim(F.col(name_col)) != "")).withColumn("_dm_low", F.lower(F.col(name_col)))
    bounded = F.col("_dm_low").rlike(r"(?s)^[\p{L}\p{Nd}_](.*[\p{L}\p{Nd}_])?$")
    parts = F.filter(F.transform(F.split("_dm_low", EDGES, -1), lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("word"))), lambda x: x["word"].rlike(WORD_RUN))
    keyed = nm.where(bounded).withColumn("_dm_k", F.array_max(parts)).select(
        *payload, "_dm_low", F.col("_dm_k.word").alias("_dm_word"), (-F.col("_dm_k.i")).alias("_dm_at"), F.size(F.split("_dm_low", EDGES, -1)).alias("_dm_n"))
    cut = lines.select(*line_keys, F.split(F.lower(F.col(text_col)), EDGES, -1).alias("_dm_p"))
    # outer: no condition on the pieces is inferred below the generator, where they would be cut again
    words = cut.select(*line_keys, "_dm_p", F.posexplode_outer("_dm_p").alias("_dm_i", "_dm_word"))
    start = F.col("_dm_i") - F.col("_dm_at")
    same = (start >= 0) & (F.array_join(F.slice("_dm_p", F.greatest(start, F.lit(0)) + 1, F.col("_dm_n")), "") == F.col("_dm_low"))
    offset = F.length(F.array_join(F.slice("_dm_p", 1, F.col("_dm_s")), "")) + 1
    if measured(keyed) <= BROADCAST_BYTES:
        found = words.join(F.broadcast(keyed), "_dm_word").where(same).withColumn("_dm_s", start)
    else:  # the pieces stay behind: candidates go back to their lines
        found = words.drop("_dm_p").join(keyed, "_dm_word").join(cut, line_keys).where(same).withColumn("_dm_s", start)
    hits = found.groupBy(*line_keys, *payload).agg(F.min(offset).cast("int").alias("offset"))
    odd = nm.where(~bounded).select(*payload)
    if odd.isEmpty():
        return hits
    pattern = F.concat(F.lit("(?iuU)\\b"), _quote(F.col(name_col)), F.lit("\\b"))
    sub = substring_matches(lines, odd, line_keys, text_col, name_col).drop("offset")
    cand = sub.join(lines.select(*line_keys, text_col), list(line_keys)).withColumn("_dm_pat", pattern)
    verified = cand.where(F.expr(f"`{text_col}` RLIKE _dm_pat")).withColumn("offset", F.expr(f"regexp_instr(`{text_col}`, _dm_pat)"))
    return hits.unionByName(verified.select(*hits.columns))


def hit_list(hits: DataFrame, group_keys: list[str], name_col: str, order_cols: list[str],
             first_only: bool = False, sep: str = ", ", out_col: str = "matches",
             first_col: str | None = None) -> DataFrame:
    """Distinct names per group in (order_cols..., name) order (D10), joined by
    ``sep``; ``first_only`` keeps the first; ``first_col`` adds the first as
    one more column.  Groups are pages: bounded lists."""
    per_name = hits.groupBy(*group_keys, name_col).agg(
        F.min(F.struct(*[F.col(c) for c in order_cols])).alias("_hl_o"))
    agg = per_name.groupBy(*group_keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_hl_o"), F.col(name_col).alias("n")))).alias("_hl"))
    names = F.transform("_hl", lambda x: x["n"])
    val = F.element_at(names, 1) if first_only else F.array_join(names, sep)
    extra = [F.element_at(names, 1).alias(first_col)] if first_col else []
    return agg.select(*group_keys, val.alias(out_col), *extra)


def first_by_priority(hits: DataFrame, group_keys: list[str], order_cols: list[str], value_cols: list[str]) -> DataFrame:
    """Per group, the hit with the smallest (order_cols...), e.g. (pos, indicator priority)."""
    best = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                          *[F.col(c) for c in value_cols])).alias("_fp")
    return hits.groupBy(*group_keys).agg(best).select(*group_keys, *[F.col(f"_fp.{c}").alias(c) for c in value_cols])


def last_in_list(hits: DataFrame, group_keys: list[str], pos_col: str, value_col: str, out_col: str) -> DataFrame:
    """The hit with the highest list position wins (later entries overwrite)."""
    return hits.groupBy(*group_keys).agg(F.max_by(value_col, pos_col).alias(out_col))
