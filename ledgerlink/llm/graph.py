"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (long columns a, b); nodes of one component, and only they, have the
    same label, a 64-bit number.

    Each round renames the nodes by a hash, sends each to the smallest of itself and its neighbours and from there
    once more, and keeps the links that still join different names.  In hashed order no chain is long in a falling
    row, so each round is expected to leave a fixed share of the names at most, whatever the shape.  Each round's
    tables are written to the shared folder: the plan stays short, and a lost executor costs one round's tasks.
    Nothing but whether links are left reaches the driver."""
    links = keep(links.select("a", "b").where("a <> b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("a").alias("label"))
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = nodes.withColumn("label", F.col("node"))
    turn = 0
    while not links.isEmpty():
        turn += 1
        named = links.select(F.xxhash64("a", F.lit(turn)).alias("a"), F.xxhash64("b", F.lit(turn)).alias("b"))
        both = named.union(named.select("b", "a"))
        up = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "forest")
        higher = up.select(F.col("a").alias("up"), F.col("up").alias("top"))
        top = keep(up.join(higher, "up").select(F.col("a").alias("name"), "top"), "forest")
        renamed = labels.select("node", F.xxhash64("label", F.lit(turn)).alias("name"))
        labels = keep(renamed.join(top, "name", "left").select("node", F.coalesce("top", "name").alias("label")), "labels")
        of_a, of_b = top.select(F.col("name").alias("a"), F.col("top").alias("ta")), top.select(F.col("name").alias("b"), F.col("top").alias("tb"))
        moved = named.join(of_a, "a").join(of_b, "b").where("ta <> tb")
        links = keep(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "links")
    return labels
