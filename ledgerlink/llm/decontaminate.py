"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks (operator 8).

DataFrame functions only.  A text's words are its lower-cased runs of letters and digits; a shingle is five words in a
row, or the whole text where it has fewer.  The weight of a shingle is how often it occurs, and two texts are as
similar as the sum of the smaller weights over the sum of the larger ones.

1. Windows: a window has the size of a benchmark item and stands where a shingle that both share puts it.  A window
   that shares no shingle has similarity 0, so none is left out that could pass.  Windows with the same words are
   handled once, however many documents hold them.
2. Fingerprints: 64-bit SimHash over the words, of windows and of items.
3. Blocks: RADIUS + 1 runs of bits.  Two fingerprints within RADIUS bits agree in one run at least, so the join on
   (size, run, its bits) meets every such pair; their distance is then counted.
4. Shared shingles: no radius is certain, as words that are cut off at an edge or repeated move many bits at once.  A
   window that passes lacks a quarter of an item's shingles at most, so it holds one of any n // 4 + 1 of the n.  The
   join on (size, one of those that the fewest items have) meets every such pair, whatever its distance.
5. The exact weighted similarity decides, at 0.75, for the pairs of both joins: none that passes is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import fresh, keep, read

RADIUS = 17
MOST_BROADCAST = 500_000


def word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def grams(h: Column, width: int) -> Column:
    """The hash of every ``width`` words in a row."""
    at = F.sequence(F.lit(0), F.size(h) - width)
    return F.when(F.size(h) >= width, F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))).otherwise(F.array().cast("array<bigint>"))


def shingles(h: Column) -> Column:
    short = F.when(F.size(h) > 0, F.array(F.xxhash64(h)))
    return F.when(F.size(h) >= 5, grams(h, 5)).otherwise(F.coalesce(short, F.array().cast("array<bigint>")))


def simhash(words: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, fingerprint) from rows of a key and a word hash: each bit is what most of the words have there."""
    votes = [F.sum(F.shiftright(value, b).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"v{b}") for b in range(64)]
    bits = [F.when(F.col(f"v{b}") > 0, F.lit((1 << b) if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(64)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return words.groupBy(*key).agg(*votes).select(*key, out.alias("fingerprint"))


def blocks(fingerprint: Column, radius: int) -> Column:
    """An array of (run, its bits), radius + 1 runs that make up the 64 bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("run"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])


def shared_weight(a: Column, b: Column) -> Column:
    """The sum over shingles of the smaller count."""
    def count(x: Column, s: Column) -> Column:
        return F.size(F.filter(x, lambda y: y == s))

    return F.aggregate(F.array_distinct(a), F.lit(0), lambda n, s: n + F.least(count(a, s), count(b, s)))


def rare_grams(items: DataFrame) -> DataFrame:
    """(size, gram, item): of each item's n shingles the n // 4 + 1 that the fewest items have."""
    each = items.select("item", "size", F.size("grams").alias("n"), F.posexplode("grams").alias("place", "gram"))
    spread = each.groupBy("gram").agg(F.count_distinct("item").alias("items"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("items", "gram", "place"))
    return each.join(spread, "gram").withColumn("rank", rank).where("rank <= n div 4 + 1").select("size", "gram", "item").distinct()


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that tell rows of documents apart; null for a null text."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), text)))


def words_key(words: Column) -> Column:
    return F.unhex(F.md5(F.array_join(words.cast("array<string>"), " ")))


def hits(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row for each document and item found in it: row_key, doc_id, item_id, start (of the best window, in words),
    n_words, similarity, distance.

    Null and empty texts on either side are found nowhere.  Repeated rows give repeated finds once, by (doc_id, text);
    an item is its item_id, null too, and its words: items with the same words or the same item_id are each reported.
    Very long texts are read whole.  Empty tables give no rows.  Only doc_id, text and item_id are read."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("h")).where("size(h) > 0").distinct()
    item = F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("-")), F.lit(":"), F.hex(words_key(F.col("h"))))
    items = keep(items.select(item.alias("item"), "item_id", "h", F.size("h").alias("size"), shingles(F.col("h")).alias("grams")), "items")
    short = sorted(r[0] for r in items.where("size < 5").select("size").distinct().collect())  # four at most

    anchors = items.where("size >= 5").select(F.lit(5).alias("width"), "size", F.posexplode("grams").alias("place", "gram"))
    for width in short:
        anchors = anchors.union(items.where(F.col("size") == width).select(F.lit(width), "size", F.lit(0), F.element_at(grams(F.col("h"), width), 1)))
    anchors = anchors.distinct()
    sent = items.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] <= MOST_BROADCAST  # anchors are four numbers each

    base = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", word_hashes(F.col("text")).alias("h"))
    windows = None
    for width in [5, *short]:
        of_width = anchors.where(F.col("width") == width).drop("width")
        # an outer explode: the optimizer would filter by the size of an inner one's array, and compute it twice
        if sent:
            found = base.select("row_key", "doc_id", "h", F.posexplode_outer(grams(F.col("h"), width)).alias("at", "gram")).join(F.broadcast(of_width), "gram")
        else:  # the words stay behind, and are fetched where a shingle is shared
            at = base.select("row_key", F.size("h").alias("n"), F.posexplode_outer(grams(F.col("h"), width)).alias("at", "gram"))
            shared = at.join(of_width, "gram").select("row_key", F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("n") - F.col("size"))).alias("at"), F.lit(0).alias("place"), "size").distinct()
            found = shared.join(base.dropDuplicates(["row_key"]), "row_key")
        start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.size("h") - F.col("size")))
        found = found.select("row_key", "doc_id", start.alias("start"), "size", F.slice("h", start + 1, F.col("size")).alias("words"))
        windows = found if windows is None else windows.union(found)
    windows = windows.withColumn("content", words_key(F.col("words")))
    windows = keep(windows.groupBy("row_key", "doc_id", "start", "size", "content").agg(F.first("words").alias("words")), "windows")

    contents = keep(windows.groupBy("content", "size").agg(F.first("words").alias("words")), "contents")
    of_windows = simhash(contents.select("content", "size", F.explode("words").alias("word")), ["content", "size"], "word")
    of_items = simhash(items.select("item", F.explode("h").alias("word")), ["item"], "word")
    prints = keep(contents.select("content", "size").join(of_windows, ["content", "size"]), "fingerprints")
    left = prints.select("content", "size", F.col("fingerprint").alias("of_window"), F.inline(blocks(F.col("fingerprint"), radius)))
    right = items.select("item", "size").join(of_items, "item").select("item", "size", F.col("fingerprint").alias("of_item"), F.inline(blocks(F.col("fingerprint"), radius)))
    distance = F.bit_count(F.col("of_window").bitwiseXOR(F.col("of_item")))
    near = left.join(right, ["size", "run", "bits"]).where(distance <= radius).select("content", "size", "item")
    held = contents.select("content", "size", F.explode_outer(F.array_distinct(shingles(F.col("words")))).alias("gram"))
    near = near.union(held.join(rare_grams(items), ["size", "gram"]).select("content", "size", "item")).distinct()

    pairs = near.join(contents.select("content", "size", shingles(F.col("words")).alias("a")), ["content", "size"]).join(items.select("item", F.col("grams").alias("b")), "item")
    pairs = pairs.withColumn("both", shared_weight(F.col("a"), F.col("b"))).withColumn("all", F.size("a") + F.size("b") - F.col("both"))
    passed = pairs.where("4 * both >= 3 * all").select("content", "size", "item", (F.col("both") / F.col("all")).alias("similarity"))
    passed = passed.join(prints.select("content", "size", F.col("fingerprint").alias("of_window")), ["content", "size"]).join(of_items.withColumnRenamed("fingerprint", "of_item"), "item")
    passed = passed.select("content", "size", "item", distance.alias("distance"), "similarity")
    best = F.max_by(F.struct("start", F.size("words").alias("n_words"), "similarity", "distance"), F.struct("similarity", -F.col("start"), -F.col("distance")))
    out = windows.join(passed, ["content", "size"]).groupBy("row_key", "doc_id", "item").agg(best.alias("best"))
    return out.join(items.select("item", "item_id"), "item").select("row_key", "doc_id", "item_id", "best.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    hit = fresh(docs, "hit")
    found = hits(docs, benchmark, radius).select(F.col("row_key").alias(hit)).distinct()
    return docs.join(found, row_key(docs["doc_id"], docs["text"]) == F.col(hit), "left_anti")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("row_key", "distance")


# The same hits without fingerprints: every window that shares a shingle is compared.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
bk AS (SELECT row_number() OVER () AS item, item_id, w, len(w) AS size FROM b WHERE len(w) > 0),
bi AS (SELECT item AS item_id, w, size FROM bk),
bg AS (SELECT item_id, size, unnest(CASE WHEN size >= 5 THEN list_transform(range(0, size - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) ELSE [array_to_string(w, ' ')] END) AS gram,
              unnest(range(0, greatest(size - 4, 1))) AS place FROM bi),
widths AS (SELECT DISTINCT least(size, 5) AS k FROM bi),
dg AS (SELECT doc_id, w, k, unnest(list_transform(range(0, len(w) - k + 1), lambda i: array_to_string(w[i + 1 : i + k], ' '))) AS gram, unnest(range(0, len(w) - k + 1)) AS at
       FROM d, widths WHERE len(w) >= k),
win AS (SELECT DISTINCT dg.doc_id, greatest(0, least(dg.at - bg.place, len(dg.w) - bg.size)) AS start, bg.size AS size, dg.w[greatest(0, least(dg.at - bg.place, len(dg.w) - bg.size)) + 1 : greatest(0, least(dg.at - bg.place, len(dg.w) - bg.size)) + bg.size] AS words
        FROM dg JOIN bg ON dg.gram = bg.gram AND dg.k = least(bg.size, 5)),
wid AS (SELECT row_number() OVER () AS wid, * FROM win),
wg AS (SELECT wid, gram, count(*) AS c FROM (SELECT wid, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(0, len(words) - 4), lambda i: array_to_string(words[i + 1 : i + 5], ' ')) ELSE [array_to_string(words, ' ')] END) AS gram FROM wid) GROUP BY wid, gram),
wn AS (SELECT wid, sum(c) AS n FROM wg GROUP BY wid),
ig AS (SELECT item_id, gram, count(*) AS c FROM bg GROUP BY item_id, gram),
inn AS (SELECT item_id, sum(c) AS n FROM ig GROUP BY item_id),
both_ AS (SELECT wid, item_id, sum(least(wg.c, ig.c)) AS m FROM wg JOIN ig USING (gram) GROUP BY wid, item_id),
sim AS (SELECT wid.doc_id, b2.item_id, wid.start, len(wid.words) AS n_words, b2.m, wn.n + inn.n - b2.m AS al
        FROM both_ b2 JOIN wid USING (wid) JOIN wn USING (wid) JOIN inn USING (item_id) JOIN bi ON bi.item_id = b2.item_id AND bi.size = wid.size
        WHERE 4 * b2.m >= 3 * (wn.n + inn.n - b2.m)),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY m::DOUBLE / al::DOUBLE DESC, start) AS rn FROM sim)
SELECT doc_id, bk.item_id, start::INTEGER AS start, n_words::INTEGER AS n_words, m::DOUBLE / al::DOUBLE AS similarity
FROM best JOIN bk ON bk.item = best.item_id WHERE rn = 1
"""
