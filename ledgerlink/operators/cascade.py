"""Priority-cascade equi-join (C1/C2/C4) and its summaries.

A left row takes the *first* level (in priority order) at which any right row
shares its key, and then *all* right rows with that key at that level.  Rows
with no hit at any level are kept once, labelled ``Unmatched``.

Levels that follow each other and share an anchor (a column pair that agrees
wherever the level's key agrees, as GRP does for BPG, BIN+GRP and GRP) are a
family.  Rows meet once per family, on the anchor, not once per level:

1. Per family the left keys are joined to the right side on the anchor and each
   pair gets the first level its parts agree at; reduced to the first level and
   its number of right rows per left row.  Where anchors repeat, the right side
   is counted by its key parts first (a map-side-combined aggregate).  The
   summaries need no more than this.
2. Left rows with a hit are joined to the right rows of their family and anchor
   that agree at the level found, in one join for all families: the left rows
   are hashed, the right rows stream past unsorted.  The join is inner, so AQE
   may split it; rows without a hit are added by a union.

So a right row meets ``MOST_PER_ANCHOR`` left rows at most.  Rows of anchors with
more left rows, where many pairs could agree at no finer level, are exploded into their
``(rank, key)`` pairs instead and joined on those: coarse levels never fan out
for rows already settled at a finer level.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import blank_to_null
from ..session import cut_lineage

#: Left rows that an anchor may have to be joined on the anchor alone.
MOST_PER_ANCHOR = 256
#: Left rows per anchor, on average, from which right rows are counted by key before they are joined.
COUNT_FROM = 4


@dataclass(frozen=True)
class Level:
    name: str
    left: tuple[str, ...]
    right: tuple[str, ...]
    #: (left, right) columns that agree wherever the key agrees; else the key's first part
    anchor: tuple[str, str] | None = None

    @property
    def meets_on(self) -> tuple[str, str]:
        return self.anchor or (self.left[0], self.right[0])


def bpg_levels(left_cols=("bin", "pcn", "grp"), right_cols=("bin", "pcn", "grp")) -> list[Level]:
    """The five BPG levels, finest first: BPG, BIN+GRP, GRP, BIN+PCN, BIN."""
    lb, lp, lg = left_cols
    rb, rp, rg = right_cols
    return [
        Level("BPG", (lb, lp, lg), (rb, rp, rg), (lg, rg)),
        Level("BIN_GRP", (lb, lg), (rb, rg), (lg, rg)),
        Level("GRP", (lg,), (rg,)),
        Level("BIN_PCN", (lb, lp), (rb, rp)),
        Level("BIN", (lb,), (rb,)),
    ]


def precomputed_levels(names=("BPG", "BIN_GRP", "GRP", "BIN_PCN", "BIN"),
                       left_cols=("bpg", "bin_grp", "grp", "bin_pcn", "bin"),
                       right_cols=None, anchors=None) -> list[Level]:
    """C4: one caller-given key column per level.  ``anchors`` names, for each
    level, a column that both sides have and that agrees wherever the level's
    keys agree (the level's own column, if not given)."""
    right_cols = right_cols or left_cols
    anchors = [(a, a) for a in anchors] if anchors else [None] * len(names)
    return [Level(n, (lc,), (rc,), a) for n, lc, rc, a in zip(names, left_cols, right_cols, anchors)]


RANK, KEY_PREFIX, PICK, ANCHOR, ANCHOR_HASH = "_cj_rank", "_cj_k", "_cj_pick", "_cj_a", "_cj_h"

Ranked = list[tuple[int, Level]]


@dataclass(frozen=True)
class Family:
    """Levels that follow each other and meet on the same anchor, with their ranks."""
    ranked: Ranked
    anchor: tuple[str, str]
    hot: DataFrame | None  # hashes of anchors of more than MOST_PER_ANCHOR left rows, if there are any
    counted: bool

    def made(self) -> list[tuple[str, str]]:
        """(left, right) columns that are a level's whole key, other than the anchor, and meet no other column:
        their values mostly repeat the anchor."""
        pairs = [pair for _, lv in self.ranked for pair in zip(lv.left, lv.right)]
        whole = dict.fromkeys((lv.left[0], lv.right[0]) for _, lv in self.ranked if len(lv.left) == 1)
        return [(c, d) for c, d in whole if c != self.anchor[0] and d != self.anchor[1] and all((a == c) == (b == d) for a, b in pairs)]

    def with_parts(self, rows: DataFrame, names: dict[str, str], side: int) -> DataFrame:
        """Rows that have ANCHOR, with parts of keys as they are compared, under the names given."""
        rows = rows.withColumns({n: _text(c) for c, n in names.items()})
        made = [pair[side] for pair in self.made()]
        return rows.withColumns({n: _short(F.col(n), F.col(ANCHOR)) for c, n in names.items() if c in made})

    def cold_rows(self, df: DataFrame, side: int) -> DataFrame:
        """Rows to be joined on the anchor, with it as ANCHOR."""
        rows = df.withColumn(ANCHOR, _text(self.anchor[side])).where(F.col(ANCHOR) != "")
        return self._against_hot(rows, "left_anti").drop(ANCHOR_HASH) if self.hot is not None else rows

    def hot_rows(self, df: DataFrame, side: int) -> DataFrame:
        return self._against_hot(df.withColumn(ANCHOR, _text(self.anchor[side])), "left_semi").drop(ANCHOR, ANCHOR_HASH)

    def _against_hot(self, rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn(ANCHOR_HASH, F.xxhash64(ANCHOR)).join(self.hot, ANCHOR_HASH, how)


def _text(c) -> Column:
    """Trimmed text, "" where it is missing.  Never null, so a filter on it or a join
    by it evaluates the caller's expression once and asks for no null test besides."""
    return F.coalesce(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit(""))


def _short(text: Column, anchor: Column) -> Column:
    """A text with a mark in each place of the anchor; "" stays.  Where anchors agree, two texts agree if and only if
    these do: no text has a mark of its own, since its \\x01 are written \\x01\\x02 first."""
    own = F.lit("\x01")
    text, anchor = (F.replace(c, own, F.lit("\x01\x02")) for c in (text, anchor))
    return F.replace(text, anchor, F.lit("\x01\x03"))


def _families(levels: list[Level], left: DataFrame) -> list[Family]:
    """Families of the levels; one pass over the left rows tells how often anchors repeat.
    Anchors are told apart by their hash here: of two that share one, both count as hot, on both sides."""
    grouped = [(anchor, list(members)) for anchor, members in groupby(enumerate(levels, 1), key=lambda x: x[1].meets_on)]
    texts = [_text(anchor[0]) for anchor, _ in grouped]
    entries = [F.when(t != "", F.struct(F.lit(i).alias("family"), F.xxhash64(t).alias(ANCHOR_HASH))) for i, t in enumerate(texts)]
    sizes = (left.select(F.inline(F.array(*entries))).where(F.col("family").isNotNull())
             .groupBy("family", ANCHOR_HASH).agg(F.count(F.lit(1)).alias("n")))
    seen = {r["family"]: r for r in sizes.groupBy("family").agg(F.max("n").alias("most"), F.avg("n").alias("mean")).collect()}
    out = []
    for i, (anchor, members) in enumerate(grouped):
        most, mean = (seen[i]["most"], seen[i]["mean"]) if i in seen else (0, 0)
        is_hot = (F.col("family") == i) & (F.col("n") > MOST_PER_ANCHOR)
        hot = cut_lineage(sizes.where(is_hot).select(ANCHOR_HASH)) if most > MOST_PER_ANCHOR else None
        out.append(Family(members, anchor, hot, mean >= COUNT_FROM))
    return out


def _width(ranked: Ranked) -> int:
    return max(len(lv.left) for _, lv in ranked)


def _key_cols(width: int) -> list[str]:
    return [f"{KEY_PREFIX}{i}" for i in range(width)]


def _components(levels: list[Level], side: str) -> list[str]:
    seen: list[str] = []
    for lv in levels:
        for c in (lv.left if side == "left" else lv.right):
            if c not in seen:
                seen.append(c)
    return seen


def _level_entries(ranked: Ranked, side: str, comp) -> list[Column]:
    """One struct<rank, k0..kw> per level, null when the level does not apply.

    Plain CASE expressions over already-normalised component columns: no
    lambda, so the whole projection stays in generated code."""
    width = _width(ranked)
    entries = []
    for rank, lv in ranked:
        parts = [comp(c) for c in (lv.left if side == "left" else lv.right)]
        present = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
        # unused slots hold "" so the rank is part of the join key and
        # components can never collide across levels
        padded = parts + [F.lit("")] * (width - len(parts))
        entries.append(F.when(present, F.struct(
            F.lit(rank).alias(RANK), *[p.alias(k) for p, k in zip(padded, _key_cols(width))])))
    return entries


def _explode_levels(df: DataFrame, ranked: Ranked, side: str, keep: list[str]) -> DataFrame:
    """Rows of ``keep`` columns x applicable (rank, key) pairs."""
    comps = _components([lv for _, lv in ranked], side)
    norm = {c: f"_cj_n{i}" for i, c in enumerate(comps)}
    tmp = df.select(*keep, *[blank_to_null(c).alias(norm[c]) for c in comps])
    entries = _level_entries(ranked, side, lambda c: F.col(norm[c]))
    return (tmp.select(*keep, F.inline(F.array(*entries)))
            .where(F.col(RANK).isNotNull()))


def cascade_join(left: DataFrame, right: DataFrame, levels: list[Level] | None = None,
                 left_id: str = "row_id", suffix: str = "_matched",
                 level_col: str = "matched_level", unmatched: str = "Unmatched") -> DataFrame:
    """Left columns + right columns (clashing names get ``suffix``) + ``level_col``.

    ``left_id`` must identify left rows uniquely.  Right keys may repeat: all
    right rows with the chosen key are returned.
    """
    levels = levels or bpg_levels()
    families = _families(levels, left)
    lcols, rcols = left.columns, right.columns
    out_rcols = [c + suffix if c in lcols else c for c in rcols]
    picks = _first_hits(left, right, families, left_id).select(F.col(left_id).alias("_cj_id"), PICK)
    judged = left.join(picks, F.col(left_id) == F.col("_cj_id")).select(*lcols, PICK)
    level = _level_name(levels, unmatched).alias(level_col)
    # the rank is asked for here too: with the same columns, the shuffles of phase 1 are made once
    out = left.join(picks, (F.col(left_id) == F.col("_cj_id")) & (F.col(PICK) > 0), "left_anti").select(
        *lcols, F.lit(unmatched).alias(level_col))
    out = _on_anchor(judged, right, families, lcols, out_rcols, level).unionByName(out, allowMissingColumns=True)
    for family in families:
        if family.hot is not None:
            hit = judged.where(F.col(PICK).isin([rank for rank, _ in family.ranked]))
            out = out.unionByName(_on_keys(hit, right, family, lcols, out_rcols, level))
    return out


def _on_anchor(judged: DataFrame, right: DataFrame, families: list[Family], lcols, out_rcols, level: Column) -> DataFrame:
    """Phase 2 where anchors have few left rows: one join of all families, by family and anchor."""
    side = [f"_cj_r{i}" for i in range(len(out_rcols))]
    renamed = dict(zip(right.columns, side))
    met = F.coalesce(*[F.when(F.col(PICK).isin([rank for rank, _ in f.ranked]), i) for i, f in enumerate(families)], F.lit(-1))
    anchor = F.coalesce(*[F.when(F.col("_cj_f") == i, _text(f.anchor[0])) for i, f in enumerate(families)], F.lit(""))
    hit = judged.where(F.col(PICK) > 0).withColumn("_cj_f", met).withColumn(ANCHOR, anchor)
    for i, f in enumerate(families):
        if f.hot is not None:
            hit = hit.withColumn(ANCHOR_HASH, F.xxhash64(ANCHOR)).join(f.hot.withColumn("_cj_f", F.lit(i)), [ANCHOR_HASH, "_cj_f"], "left_anti")
    # keys made beforehand are compared in columns that all families share, and a left row's at its own level alone;
    # the other parts are columns of the result
    width = max(len(f.made()) for f in families)
    slot = [{d: f"_cj_s{k}" for k, (_, d) in enumerate(f.made())} for f in families]
    own = [F.when(F.col(PICK) == rank, _text(lv.left[0])) for i, f in enumerate(families) for rank, lv in f.ranked if _is_made(lv, slot[i])]
    if own:
        hit = hit.withColumn("_cj_own", F.coalesce(*own, F.lit(""))).withColumn("_cj_own", _short(F.col("_cj_own"), F.col(ANCHOR)))
    right_side = reduce(DataFrame.unionAll, [
        f.with_parts(f.cold_rows(right, 1), slot[i], 1).select(
            F.lit(i).alias("_cj_rf"), F.col(ANCHOR).alias("_cj_ra"), *[F.col(c).alias(o) for c, o in renamed.items()],
            *slot[i].values(), *[F.lit("").alias(f"_cj_s{k}") for k in range(len(slot[i]), width)])
        for i, f in enumerate(families)])
    agrees = reduce(lambda a, b: a | b, [
        (F.col(PICK) == rank) & ((F.col("_cj_own") != "") & (F.col("_cj_own") == F.col(slot[i][lv.right[0]])) if _is_made(lv, slot[i])
                                 else _agree(lv, f, _text, lambda c: _text(renamed[c])))
        for i, f in enumerate(families) for rank, lv in f.ranked])
    # the left rows of an anchor are few: they are hashed and the right rows stream past unsorted
    pairs = hit.hint("shuffle_hash").join(right_side, (F.col("_cj_f") == F.col("_cj_rf")) & (F.col(ANCHOR) == F.col("_cj_ra")) & agrees)
    return pairs.select(*lcols, *[F.col(c).alias(o) for c, o in zip(side, out_rcols)], level)


def _on_keys(hit: DataFrame, right: DataFrame, family: Family, lcols, out_rcols, level: Column) -> DataFrame:
    """Phase 2 for the other anchors: the key is rebuilt from the left row for the picked rank."""
    keys = [RANK] + _key_cols(_width(family.ranked))
    entries = _level_entries(family.ranked, "left", blank_to_null)
    chosen = F.coalesce(*[F.when(F.col(PICK) == rank, e) for (rank, _), e in zip(family.ranked, entries)])
    keyed = family.hot_rows(hit, 0).withColumn("_cj_key", chosen).select(*lcols, PICK, "_cj_key.*")
    right_x = _explode_levels(family.hot_rows(right, 1), family.ranked, "right", right.columns)
    right_side = right_x.select(*[F.col(c).alias(o) for c, o in zip(right.columns, out_rcols)], *keys)
    return keyed.join(right_side, keys).select(*lcols, *out_rcols, level)


def _is_made(lv: Level, slots: dict[str, str]) -> bool:
    return len(lv.right) == 1 and lv.right[0] in slots


def _agree(lv: Level, family: Family, left_part, right_part) -> Column:
    """The parts of the level's key agree, given that the anchor does."""
    return reduce(lambda a, b: a & b, [(left_part(a) == right_part(b)) & (left_part(a) != "") for a, b in zip(lv.left, lv.right)
                                       if (a, b) != family.anchor], F.lit(True))


def first_hits(left: DataFrame, right: DataFrame, levels: list[Level], left_id: str) -> DataFrame:
    """Phase 1: per left row with a hit, ``left_id``, the rank of its first
    level and ``match_count``, the number of right rows with its key there."""
    return _first_hits(left, right, _families(levels, left), left_id)


def _first_hits(left: DataFrame, right: DataFrame, families: list[Family], left_id: str) -> DataFrame:
    found = []
    for family in families:
        found.append(_count_on_anchor(left, right, family, left_id))
        if family.hot is not None:
            found.append(_count_on_keys(left, right, family, left_id))
    hits = reduce(DataFrame.unionByName, found).groupBy(left_id).agg(F.min("_cj_p").alias("_cj_p"))
    return hits.select(left_id, F.shiftright("_cj_p", 56).cast("int").alias(PICK),
                       F.col("_cj_p").bitwiseAND(F.lit((1 << 56) - 1)).alias("match_count"))


def _packed(rank, count) -> Column:
    # rank (top byte) and count in one long: the minimum stays a hash aggregate
    return F.shiftleft(rank.cast("long"), 56).bitwiseOR(count).alias("_cj_p")


def _count_on_anchor(left: DataFrame, right: DataFrame, family: Family, left_id: str) -> DataFrame:
    """Phase 1 where anchors have few left rows: ``left_id`` and packed rank and count."""
    members = [lv for _, lv in family.ranked]
    lnorm, rnorm = ({c: f"_cj_{s}{i}" for i, c in enumerate(c for c in _components(members, side) if c != family.anchor[k])}
                    for k, (s, side) in enumerate((("l", "left"), ("r", "right"))))
    # an id that stands on several left rows takes the least of their counts: rows are told apart by their key
    lkeys = family.with_parts(family.cold_rows(left, 0), lnorm, 0).select(left_id, ANCHOR, *lnorm.values())
    # dealt out by the anchor at once: neither the distinct rows nor the join need another shuffle
    lkeys = lkeys.repartition(ANCHOR)
    lkeys = lkeys.groupBy(*lkeys.columns).agg(F.lit(1).alias("_cj_one")).drop("_cj_one")
    rkeys = family.with_parts(family.cold_rows(right, 1), rnorm, 1).select(F.col(ANCHOR).alias("_cj_ra"), *rnorm.values())
    rkeys = rkeys.groupBy(*rkeys.columns).agg(F.count(F.lit(1)).alias("_cj_n")) if family.counted else rkeys.withColumn("_cj_n", F.lit(1))
    pairs = lkeys.join(rkeys, F.col(ANCHOR) == F.col("_cj_ra"))
    rank = F.coalesce(*[F.when(_agree(lv, family, lambda c: _part(c, family.anchor[0], ANCHOR, lnorm), lambda c: _part(c, family.anchor[1], "_cj_ra", rnorm)), rank)
                        for rank, lv in family.ranked])
    pairs = pairs.withColumn(RANK, rank).where(F.col(RANK).isNotNull())
    n = {rank: f"_cj_n{rank}" for rank, _ in family.ranked}
    per = pairs.groupBy(left_id, ANCHOR, *lnorm.values()).agg(
        *[F.sum(F.when(F.col(RANK) == rank, F.col("_cj_n")).otherwise(0)).alias(c) for rank, c in n.items()])
    return per.select(left_id, F.coalesce(*[F.when(F.col(c) > 0, _packed(F.lit(rank), F.col(c))) for rank, c in n.items()]).alias("_cj_p"))


def _part(c: str, anchor: str, anchor_col: str, norm: dict) -> Column:
    return F.col(anchor_col if c == anchor else norm[c])


def _count_on_keys(left: DataFrame, right: DataFrame, family: Family, left_id: str) -> DataFrame:
    """Phase 1 for the other anchors: left (rank, key) pairs meet the right side's
    row counts per pair, so a hot key costs one row."""
    keys = [RANK] + _key_cols(_width(family.ranked))
    lkeys = _explode_levels(family.hot_rows(left, 0), family.ranked, "left", [left_id])
    rkeys = _explode_levels(family.hot_rows(right, 1), family.ranked, "right", []).groupBy(*keys).agg(F.count(F.lit(1)).alias("_cj_n"))
    return lkeys.join(rkeys, keys).select(left_id, _packed(F.col(RANK), F.col("_cj_n")))


def _level_name(levels: list[Level], unmatched: str) -> Column:
    # explicit null test: the optimizer takes element_at over a literal array
    # as non-null and would drop a coalesce
    names = F.array(*[F.lit(lv.name) for lv in levels])
    return F.when(F.col(PICK).isNull(), F.lit(unmatched)).otherwise(F.element_at(names, F.col(PICK)))


def cascade_counts(left: DataFrame, right: DataFrame, levels: list[Level] | None = None, left_id: str = "row_id",
                   level_col: str = "matched_level", unmatched: str = "Unmatched") -> DataFrame:
    """Left columns + ``level_col`` + ``match_count``: how many rows
    ``cascade_join`` would give for each left row, with no right row joined."""
    levels = levels or bpg_levels()
    return (left.join(first_hits(left, right, levels, left_id), left_id, "left")
            .select(*left.columns, _level_name(levels, unmatched).alias(level_col),
                    F.coalesce("match_count", F.lit(0)).cast("long").alias("match_count")))


def match_summary(matches: DataFrame, key_col: str = "bpg", level_col: str = "matched_level",
                  unmatched: str = "Unmatched", count_col: str | None = None) -> DataFrame:
    """Per key, number of matched rows and the sorted distinct levels used.

    Repeated left keys add up.  Null keys are dropped (as a group-by would).
    Both aggregates combine map-side, so a hot key is no straggler.  With
    ``count_col`` a row stands for that many matches (``cascade_counts``).
    """
    hits = matches.where((F.col(level_col) != unmatched) & F.col(level_col).isNotNull()
                         & F.col(key_col).isNotNull())
    return hits.groupBy(key_col).agg(
        (F.sum(count_col) if count_col else F.count(F.lit(1))).alias("match_count"),
        F.array_join(F.array_sort(F.collect_set(level_col)), ", ").alias("rules_used"))


def attach_summary(keys: DataFrame, summary: DataFrame, key_col: str = "bpg",
                   no_match: str = "No Match") -> DataFrame:
    """Summary re-attached to every key row; defaults 0 / ``No Match``."""
    return (keys.join(summary, key_col, "left")
            .withColumn("match_count", F.coalesce(F.col("match_count"), F.lit(0)).cast("long"))
            .withColumn("rules_used", F.coalesce(F.col("rules_used"), F.lit(no_match))))


def per_row_levels(matches: DataFrame, left_id: str = "row_id", level_col: str = "matched_level",
                   unmatched: str = "Unmatched") -> DataFrame:
    """E5: per left row, the level it settled at and its number of matches."""
    return matches.groupBy(left_id).agg(
        F.max(level_col).alias(level_col),
        F.count_if(F.col(level_col) != unmatched).cast("long").alias("match_count"))
