"""Fuzzy name matching (B11 B12 C5 C6 C7): best match and top-k by token-sort ratio.

Plan:
  1. names are split on '/'; each distinct text is cleaned (B11) and its tokens
     are expanded (B12) by a join with the abbreviation table, of any size;
  2. the *distinct* cleaned parts are scored against every choice in cells of
     one group of parts and one block of choices (``cogroup``): both sides are
     shuffled to the cells, so nothing passes through the driver, no side is
     broadcast and a task holds one block whatever the sizes;
  3. each cell keeps only a part's top-k (score, choice position) rows: pairs
     are never materialised as rows; the cells of a part are then ranked;
  4. per-part results join back to the name rows on the part text and reduce
     per row (best = highest score, then first part, then first choice).

Score: token-sort ratio = 100 * 2 * LCS(a', b') / (|a'| + |b'|) where x' is x's
whitespace tokens sorted and joined by one space (normalised Indel
similarity).  LCS uses the bit-parallel row update of Hyyro (2004), run for
one part against all choices of a block at once with numpy uint64 words, as
many as the part needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_name

DEFAULT_THRESHOLD = 85.0
PART_GROUP, CHOICE_BLOCK = 64, 1 << 14  # expected rows of a scoring cell, on either side


# ------------------------------------------------------------------ scoring
def sort_tokens(s: str) -> str:
    return " ".join(sorted(s.split()))


def _lcs_python(a: str, b: str) -> int:
    """Bit-parallel LCS with Python integers (any length)."""
    if not a or not b:
        return 0
    pm: dict[str, int] = {}
    for i, ch in enumerate(a):
        pm[ch] = pm.get(ch, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    v = mask
    for ch in b:
        u = v & pm.get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return len(a) - bin(v).count("1")


class ChoiceBlock:
    """Choices encoded once per cell: the codes of the sorted-token texts, one
    text after the other, longest first, so a long choice widens no other."""

    def __init__(self, texts: list[str], positions: list[int]):
        self.texts = [sort_tokens(t) for t in texts]
        self.positions = np.asarray(positions, dtype=np.int64)
        self.lens = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.order = np.argsort(-self.lens, kind="stable")
        alphabet = sorted({ch for t in self.texts for ch in t})
        self.index = {ch: i for i, ch in enumerate(alphabet)}
        self.codes = np.array([self.index[ch] for i in self.order for ch in self.texts[i]], dtype=np.int64)
        lens = self.lens[self.order]
        self.first = np.cumsum(lens) - lens
        # how many texts have a character at each place
        self.active = np.searchsorted(-lens, -np.arange(lens.max(initial=0)), side="left")

    def lcs(self, a: str) -> np.ndarray:
        n, m = len(self.texts), len(a)
        if m == 0 or n == 0:
            return np.zeros(n, dtype=np.int64)
        words = -(-m // 64)
        pm = np.zeros((words, max(len(self.index), 1)), dtype=np.uint64)
        for i, ch in enumerate(a):
            k = self.index.get(ch)
            if k is not None:
                pm[i // 64, k] |= np.uint64(1) << np.uint64(i % 64)
        v = np.full((words, n), np.uint64(0xFFFFFFFFFFFFFFFF))
        for j, k in enumerate(self.active):
            code = self.codes[self.first[:k] + j]
            carry = np.zeros(k, dtype=np.uint64)
            for w in range(words):
                old = v[w, :k]
                u = old & pm[w, code]
                part = old + u
                total = part + carry
                carry = ((part < old) | (total < part)).astype(np.uint64)
                v[w, :k] = total | (old & ~u)
        out = np.zeros(n, dtype=np.int64)
        for w in range(words):  # a matched character is a zero bit
            bits = min(64, m - 64 * w)
            mask = np.uint64((1 << bits) - 1)
            out[self.order] += bits - np.bitwise_count(v[w] & mask).astype(np.int64)
        return out

    def scores(self, part: str) -> np.ndarray:
        a = sort_tokens(part)
        total = len(a) + self.lens
        lcs = self.lcs(a)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0)
        return s


def token_sort_ratio(a: str | None, b: str | None) -> float | None:
    """Scalar version (tests, small helpers): both empty = 100, null = null."""
    if a is None or b is None:
        return None
    x, y = sort_tokens(a), sort_tokens(b)
    if not x and not y:
        return 100.0
    return 200.0 * _lcs_python(x, y) / (len(x) + len(y))


def top_k_for_parts(parts: list[str], block: ChoiceBlock, k: int) -> pd.DataFrame:
    """The k best choices of the block for each part: (part, score, choice_pos)."""
    out_part, out_score, out_pos = [], [], []
    for part in parts:
        s = block.scores(part)
        # highest score first, then lowest choice position
        for i in np.lexsort((block.positions, -s))[:k]:
            out_part.append(part)
            out_score.append(float(s[i]))
            out_pos.append(int(block.positions[i]))
    return pd.DataFrame({"part": out_part, "score": out_score, "choice_pos": out_pos})


# ---------------------------------------------------------------- plan
def abbreviation_table(abbrevs: DataFrame) -> DataFrame:
    """B12 dictionary (tok, full): of repeated abbreviations the last by ``seq``,
    then by full form, wins."""
    full = F.lower(F.trim("full_form")).alias("full")
    return (abbrevs.select(F.lower(F.trim("abbreviation")).alias("tok"), full, "seq")
            .where(F.col("tok").isNotNull())
            .groupBy("tok").agg(F.max(F.struct("seq", "full"))["full"].alias("full")))


def prepared(texts: DataFrame, abbrevs: DataFrame) -> DataFrame:
    """(raw, cleaned) for each distinct non-null ``raw``: B11, then B12 token by
    token through a join; the tokens of one text come together again."""
    toks = (texts.where(F.col("raw").isNotNull()).select("raw").distinct()
            .select("raw", F.posexplode_outer(F.split(clean_name("raw"), r"\s+", -1)).alias("i", "tok")))
    joined = toks.join(abbreviation_table(abbrevs), "tok", "left")
    word = F.struct("i", F.coalesce("full", "tok").alias("w"))
    return joined.groupBy("raw").agg(F.array_sort(F.collect_list(word)).alias("ws")).select(
        "raw", F.array_join(F.filter(F.transform("ws", lambda x: x["w"]), lambda w: w != ""), " ").alias("cleaned"))


def prepare_choices(choices: DataFrame, abbrevs: DataFrame, name_col: str = "plan", seq_col: str = "seq") -> DataFrame:
    """One row per cleaned choice: first position and first original name."""
    c = choices.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("raw")).agg(F.min(seq_col).alias("pos"))
    return c.join(prepared(c, abbrevs), "raw").groupBy("cleaned").agg(
        F.min("pos").alias("choice_pos"), F.min_by("raw", "pos").alias("original"))


def _explode_parts(names: DataFrame, abbrevs: DataFrame, id_col: str, name_col: str) -> DataFrame:
    raw = (names.where(F.col(name_col).isNotNull())
           .select(id_col, F.posexplode(F.split(name_col, "/", -1)).alias("part_idx", "raw")))
    return raw.join(prepared(raw, abbrevs), "raw").select(id_col, "part_idx", F.col("cleaned").alias("part"))


def score_parts(spark: SparkSession, parts: DataFrame, choices: DataFrame, k: int) -> DataFrame:
    """(part) -> top-k (part, rank, score, choice_pos) against every choice."""
    distinct_parts = parts.select("part").distinct()
    groups = max(1, -(-distinct_parts.count() // PART_GROUP))
    blocks = max(1, -(-choices.count() // CHOICE_BLOCK))

    def cell(own, other, n_own, n_other, col):
        spread = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return lambda df: df.withColumn(own, F.pmod(F.xxhash64(col), F.lit(n_own)).cast("int")).withColumn(other, spread)

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    left = distinct_parts.transform(cell("g", "b", groups, blocks, "part")).repartition(n, "g", "b")
    right = choices.select("cleaned", "choice_pos").transform(cell("b", "g", blocks, groups, "cleaned")).repartition(n, "g", "b")

    def score(some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return top_k_for_parts(some["part"].tolist(), ChoiceBlock(block["cleaned"].tolist(), block["choice_pos"].tolist()), k)

    best = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInPandas(
        score, "part string, score double, choice_pos long")
    w = Window.partitionBy("part").orderBy(F.col("score").desc(), F.col("choice_pos").asc())
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fuzzy_best(spark: SparkSession, names: DataFrame, choices: DataFrame, abbrevs: DataFrame,
               id_col: str = "seq", name_col: str = "plan_name", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per name row, best original choice (null below ``threshold``) and its score.
    A null name gives a null match and a null score (D14)."""
    ch = prepare_choices(choices, abbrevs)
    parts = _explode_parts(names, abbrevs, id_col, name_col)
    top = score_parts(spark, parts, ch, 1).where(F.col("rank") == 1)
    scored = parts.join(top, "part").join(ch.select("choice_pos", "original"), "choice_pos")
    best = scored.groupBy(id_col).agg(F.max(F.struct(
        F.col("score"), (-F.col("part_idx")).alias("np"), (-F.col("choice_pos")).alias("nc"),
        F.col("original"))).alias("b"))
    return (names.join(best, id_col, "left")
            .select(id_col, name_col,
                    F.when(F.col("b.score") >= threshold, F.col("b.original")).alias("best_match"),
                    F.col("b.score").alias("match_score")))


def fuzzy_top_k(spark: SparkSession, names: DataFrame, choices: DataFrame, abbrevs: DataFrame,
                id_col: str = "seq", name_col: str = "plan_name", k: int = 3) -> DataFrame:
    """Per name row, the top ``k`` distinct choices over all parts as
    ``match{i}_plan`` / ``match{i}_score`` (no threshold, as the reference).
    Order: score desc, then part order, then rank inside the part."""
    ch = prepare_choices(choices, abbrevs)
    parts = _explode_parts(names, abbrevs, id_col, name_col)
    top = score_parts(spark, parts, ch, k)
    scored = parts.join(top, "part").join(ch.select("choice_pos", "original"), "choice_pos")
    per_row = scored.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("ns"), F.col("part_idx"), F.col("rank"),
        F.col("choice_pos"), F.col("score"), F.col("original")))).alias("m"))
    # keep the first occurrence of each choice, then the first k
    uniq = F.filter("m", lambda x, i: ~F.exists(F.slice("m", 1, i), lambda y: y["choice_pos"] == x["choice_pos"]))
    per_row = per_row.select(id_col, F.slice(uniq, 1, k).alias("m"))
    cols = []
    for i in range(1, k + 1):
        e = F.try_element_at("m", F.lit(i))
        cols += [e["original"].alias(f"match{i}_plan"), e["score"].alias(f"match{i}_score")]
    return names.join(per_row, id_col, "left").select(id_col, name_col, *cols)
