"""Exact top-k inner products over M-trees (operator 10).

A component x becomes floor(256 x).  With one more component sqrt(M**2 - |v|**2), where M is the largest length, and
0 for a query, the inner product falls as the Euclidean distance grows: |q|**2 + M**2 - d**2 = 2 q.v.  So the vectors
lie in a metric space, and M-trees hold them.

Index: a region is what lies nearest to one of at most REGIONS pivots; a region of many rows is dealt into trees of
about TREE rows.  A tree's root knows its pivot and covering radius, its nodes theirs and the distance to the root's
pivot, its pages their vectors and each one's distance to the node's pivot.  Every row is in exactly one page.

Search: a query first descends the nearest region's first tree, best node first, for a bound on its k-th distance.
Then every tree whose region and root can hold something as near is searched with that bound.  A node is left out by
its parent distance before its own is computed, a vector by its distance to its pivot before the inner product is.
Queries of a block meet the trees of a group in one cell: a query's vector is sent once for each group, a tree once for
each block, and queries at the same node are scored by one product.
Bounds have a margin for rounding; scores are exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import BATCH_BYTES, bounded_batches, keep, read

REGIONS, TREE, PAGE = 256, 4096, 128
QUERIES = 4096  # of a block
CELLS, CELL_BYTES = 64, 32 << 20  # trees are searched together where that leaves as many cells, up to so many bytes
SLACK = 1e-6


def scaled(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, v): the vectors that take part, as long arrays, with a number for each row."""
    ok = F.coalesce(F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return vectors.where(ok).select(F.monotonically_increasing_id().alias("row"), "vec_id", v.alias("v"))


def matrix(vs: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(vs), dim), np.int64)
    for i, v in enumerate(vs):  # shorter vectors end in zeros
        out[i, : len(v)] = v
    return out


def lifted(v: np.ndarray, largest: float) -> np.ndarray:
    x = v.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0))])


def far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a to the row b."""
    return np.sqrt(np.maximum(((a - b) ** 2).sum(axis=-1), 0))


def build_tree(own: np.ndarray, ids: np.ndarray, v: np.ndarray, largest: float) -> list[dict]:
    """The pages of one tree, each with its node: pivot, radius, distance to the root's pivot, distances of its rows."""
    x = lifted(v, largest)
    root = x[0]
    pages, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) > PAGE:
            # split by the generalized hyperplane between two far rows
            one = x[rows[far(x[rows], x[rows[0]]).argmax()]]
            two = x[rows[far(x[rows], one).argmax()]]
            near = far(x[rows], one) < far(x[rows], two)
            if near.any() and not near.all():
                todo += [rows[near], rows[~near]]
                continue
            todo += [part for part in np.array_split(rows, -(-len(rows) // PAGE))[1:]]  # all alike
            rows = np.array_split(rows, -(-len(rows) // PAGE))[0]
        centre = x[rows].mean(axis=0)
        pivot = x[rows[far(x[rows], centre).argmin()]]
        d = far(x[rows], pivot)
        order = np.argsort(d, kind="stable")
        rows, d = rows[order], d[order]
        pages.append({"pivot": pivot, "radius": float(d.max()), "up": float(far(pivot, root)), "rows": own[rows], "ids": ids[rows], "v": smallest(v[rows]), "d": d})
    return pages


def smallest(v: np.ndarray) -> np.ndarray:
    """The same whole numbers in two or four bytes each, where they fit."""
    most = int(np.abs(v).max(initial=0))
    return v.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


class Asked:
    """Queries that search trees together, each with the k best rows it has met and its own bound."""

    def __init__(self, rows: np.ndarray, q: np.ndarray, bound: np.ndarray, largest: float, k: int):
        self.rows, self.k = rows, k
        x = q.astype(np.float64)
        self.q = x if largest < 2.0**53 else q  # below that, sums of whole numbers are exact in doubles too
        self.x = np.column_stack([x, np.zeros(len(x))])
        self.own = (x * x).sum(axis=1)
        self.base = self.own + largest
        self.slack = SLACK * (1 + np.sqrt(self.base))
        self.bound = bound.astype(np.float64)
        # no row at the bound or nearer scores less
        reach = np.where(np.isfinite(self.bound), self.bound + self.slack, 0)
        self.least = np.where(np.isfinite(self.bound), np.floor((self.base - reach * reach) / 2) - 1, -np.inf)
        self.met = np.zeros((0, 3), np.int64)  # (query, score, vec_id), the best k of each

    def far(self, points: np.ndarray) -> np.ndarray:
        """Distances of the queries to the points."""
        return np.sqrt(np.maximum(self.own[:, None] + (points * points).sum(axis=1) - 2 * self.x @ points.T, 0))

    def take(self, found: list[np.ndarray]) -> None:
        met = np.concatenate([self.met, *found])
        met = met[np.lexsort((met[:, 2], -met[:, 1], met[:, 0]))]
        first = np.searchsorted(met[:, 0], met[:, 0])
        place = np.arange(len(met)) - first
        self.met = met[place < self.k]
        last = met[place == self.k - 1]
        self.least[last[:, 0]] = np.maximum(self.least[last[:, 0]], last[:, 1])
        near = np.sqrt(np.maximum(self.base[last[:, 0]] - 2 * last[:, 1], 0))
        self.bound[last[:, 0]] = np.minimum(self.bound[last[:, 0]], near)


def descend(pages: list[dict], root: np.ndarray, radius: float, asked: Asked) -> None:
    """The queries meet the rows of a tree, each query its best page first; a query's own row is left out.

    In each round every query that is not done goes to its next page; those that go to the same one are scored together."""
    to_root = asked.far(root[None, :])[:, 0]
    live = np.flatnonzero(to_root - radius <= asked.bound + asked.slack)
    if not len(live):
        return
    up, radii = (np.array([p[c] for p in pages]) for c in ("up", "radius"))
    least = np.abs(to_root[:, None] - up) - radii  # without the nodes' own distances
    near = (least[live] <= (asked.bound + asked.slack)[live, None]).any(axis=0)
    own = np.zeros(least.shape)
    at = np.flatnonzero(near)
    if not len(at):
        return
    own[:, at] = asked.far(np.stack([pages[n]["pivot"] for n in at]))
    least[:, at] = np.maximum(least[:, at], own[:, at] - radii[at])
    order = np.argsort(least, axis=1, kind="stable")
    vectors = [None] * len(pages)
    for turn in range(len(pages)):
        page = order[live, turn]
        open_ = least[live, page] <= (asked.bound + asked.slack)[live]
        live, page = live[open_], page[open_]
        if not len(live):
            return
        found, by_page = [], np.argsort(page, kind="stable")
        cuts = np.flatnonzero(np.diff(page[by_page])) + 1
        for some in np.split(by_page, cuts):
            n, who = page[some[0]], live[some]
            p, reach = pages[n], (asked.bound + asked.slack)[who]
            a = np.searchsorted(p["d"], (own[who, n] - reach).min())
            b = np.searchsorted(p["d"], (own[who, n] + reach).max(), side="right")
            if vectors[n] is None:
                vectors[n] = p["v"].astype(asked.q.dtype)
            scores = vectors[n][a:b] @ asked.q[who].T
            row, col = np.nonzero(scores >= asked.least[who])
            other = p["rows"][a:b][row] != asked.rows[who[col]]
            row, col = row[other], col[other]
            if len(row):
                found.append(np.column_stack([who[col], scores[row, col].astype(np.int64), p["ids"][a:b][row]]))
        if found:
            asked.take(found)


TREES = "region int, tree int, n long, pivot array<double>, radius double, nodes binary"


def top_inner_products(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` the k best other rows.

    Rows without a vec_id, null vectors and those with null or non-finite components take no part.  Rows that repeat a
    vec_id are each a candidate for the others, and each a query with ranks of its own.  A shorter vector ends in zeros; an empty one has score 0 with all.  Ties go to the smaller
    vec_id.  Components whose products leave 63 bits raise an error.  Columns besides vec_id and embedding are left out."""
    import pickle

    spark = vectors.sparkSession
    bounded_batches(spark)
    points = keep(scaled(vectors), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = points.agg(F.max(square), F.max(F.size("v")), F.count("*")).first()
    largest, dim, count = float(sizes[0] or 0), int(sizes[1] or 0), int(sizes[2])
    if largest >= 2.0**62:
        raise ValueError("components are too large for scores of 63 bits")
    want = max(1, min(REGIONS, count // TREE))
    drawn = points.orderBy(F.xxhash64("row"), "row").limit(want).toPandas()
    pivots = lifted(matrix(drawn["v"], dim), largest)  # REGIONS rows at most

    def nearest(batches):
        for pdf in batches:  # lifted vectors are equally long: the nearest pivot has the largest product
            x = lifted(matrix(pdf["v"], dim), largest)
            yield pdf.assign(region=(x @ pivots.T).argmax(axis=1).astype("int32"))

    placed = keep(points.mapInPandas(nearest, "row long, vec_id long, v array<long>, region int"), "regions") if count else points.withColumn("region", F.lit(0))
    is_query = F.col("vec_id") % every == 0
    regions = placed.groupBy("region").agg(F.ceil(F.count("*") / TREE).cast("int").alias("trees"), F.count_if(is_query).alias("asking")).orderBy("region").collect()  # REGIONS rows at most
    total, asking = sum(r["trees"] for r in regions), sum(r["asking"] for r in regions)
    blocks = max(1, -(-asking // QUERIES))
    # trees of one group and queries of one block meet in one cell
    size = max(1, min(total * blocks // CELLS, CELL_BYTES // (TREE * 8 * max(dim, 1))))
    before, groups_of = 0, {}
    for r in regions:
        groups_of[r["region"]] = (before, range(before // size, (before + r["trees"] - 1) // size + 1))
        before += r["trees"]
    laid = spark.createDataFrame([(r["region"], r["trees"], groups_of[r["region"]][0], max(1, -(-r["asking"] // QUERIES))) for r in regions], "region int, trees int, before int, own_blocks int")
    dealt = placed.join(F.broadcast(laid), "region").withColumn("tree", F.pmod(F.xxhash64("row"), F.col("trees")).cast("int"))

    def plant(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "row"])
        v = matrix(pdf["v"], dim)
        pages = build_tree(pdf["row"].to_numpy(np.int64), pdf["vec_id"].to_numpy(np.int64), v, largest)
        root = lifted(v[:1], largest)[0]
        radius = max(p["up"] + p["radius"] for p in pages)
        return pd.DataFrame([{"region": key[0], "tree": key[1], "n": len(pdf), "pivot": root, "radius": radius, "nodes": pickle.dumps(pages)}])

    index = keep(dealt.groupBy("region", "tree").applyInPandas(plant, TREES), "m-trees")
    trees = index.join(F.broadcast(laid), "region").withColumn("group", F.floor((F.col("before") + F.col("tree")) / size).cast("int")).drop("trees", "before", "own_blocks")
    queries = placed.where(is_query).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("region").alias("home"))
    found = "query long, query_id long, vec_id long, score long, bound double"

    def search(key, trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        who = Asked(asked["query"].to_numpy(np.int64), matrix(asked["q"], dim), asked["bound"].to_numpy(np.float64), largest, k)
        for t in trees.itertuples():
            descend(pickle.loads(t.nodes), np.array(t.pivot), t.radius, who)
        n, score, vec_id = who.met.T
        return pd.DataFrame({"query": asked["query"].to_numpy(np.int64)[n], "query_id": asked["query_id"].to_numpy(np.int64)[n], "vec_id": vec_id, "score": score, "bound": who.bound[n]})

    def searched(asked: DataFrame, trees: DataFrame) -> DataFrame:
        """``asked`` has group and block; the trees of a group go to every block that asks for it."""
        asked = keep(asked, "asked")
        cells = asked.select(*[F.col(c).alias(c) for c in ("group", "block")]).distinct()
        mine = trees.select(*[F.col(c).alias(c) for c in trees.columns]).join(cells, "group")
        return mine.groupBy("group", "block").cogroup(asked.groupBy("group", "block")).applyInPandas(search, found)

    # the first tree of the nearest region gives a bound
    at_home = queries.join(F.broadcast(laid), queries["home"] == laid["region"]).select(
        "query", "query_id", "q", F.lit(float("inf")).alias("bound"), F.col("home").alias("group"), F.pmod(F.xxhash64("query"), F.col("own_blocks")).cast("int").alias("block"))
    bounds = searched(at_home, trees.where("tree = 0").withColumn("group", F.col("region"))).groupBy("query").agg(F.min("bound").alias("bound"))
    queries = keep(queries.join(bounds, "query", "left").na.fill({"bound": float("inf")}), "queries")

    # regions that can hold something as near: their pivot and the farthest row of theirs, REGIONS rows at most
    reach = _reach(index, pivots)
    covered, radii = sorted(reach), np.array([reach[r] for r in sorted(reach)])

    def groups_asked(batches):
        most = max(1, BATCH_BYTES // (64 + 8 * dim))  # a query's vector goes to each group: batches don't grow with those
        for pdf in batches:
            who = Asked(pdf["query"].to_numpy(np.int64), matrix(pdf["q"], dim), pdf["bound"].to_numpy(np.float64), largest, k)
            near = who.far(pivots[covered]) - radii <= (who.bound + who.slack)[:, None]
            at, group = [], []
            for i, regions_near in enumerate(near):
                mine = sorted({g for r in np.flatnonzero(regions_near) for g in groups_of[covered[r]][1]})
                at += [i] * len(mine)
                group += mine
            for a in range(0, len(at), most):
                yield pdf.iloc[at[a : a + most]].assign(group=np.array(group[a : a + most], "int32"))

    wide = queries.select("query", "query_id", "q", "bound", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"))
    asked = wide.mapInPandas(groups_asked, "query long, query_id long, q array<long>, bound double, block int, group int")
    best = searched(asked, trees).drop("bound")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _reach(index: DataFrame, pivots: np.ndarray) -> dict[int, float]:
    """For each region a radius around its pivot that covers its trees."""
    distance = F.sqrt(F.aggregate(F.zip_with("pivot", "p", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))
    table = index.sparkSession.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pivots)], "region int, p array<double>")
    rows = index.join(F.broadcast(table), "region").groupBy("region").agg(F.max(distance + F.col("radius")).alias("radius"))
    return {r[0]: float(r[1]) for r in rows.collect()}


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(read(spark, sf_dir, "embeddings"))
