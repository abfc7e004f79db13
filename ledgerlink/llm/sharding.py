"""Minimax contiguous shards (operator 1).

DataFrame functions only.  Equal texts stay together: the first bits of their MD5 put them into one of UNITS atomic
units, in the order of those bits.  Units too large for an even share come first, each a shard of its own.  For the
others a binary search finds the smallest capacity with which a greedy pass over the ordered units needs no more than
the shards that are left.  The cuts keep to that capacity: a shard ends where the next unit would go beyond it, or
where its even share of what is left is met and the rest still fits.

The search works on one array of unit sizes, UNITS numbers whatever the data, inside one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import keep, read

SHARDS = 40
UNIT_BITS = 14
ROW_BYTES = 16


def _struct(**fields: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def _shards_needed(sizes: Column, capacity: Column) -> Column:
    start = _struct(n=F.lit(1).cast("long"), held=F.lit(0).cast("long"))
    return F.aggregate(sizes, start, lambda a, x: F.when(a["held"] + x <= capacity, _struct(n=a["n"], held=a["held"] + x)).otherwise(_struct(n=a["n"] + 1, held=x)), lambda a: a["n"])


def _smallest_capacity(sizes: Column, shards: Column, total: Column) -> Column:
    """Between the larger of the even share and the largest unit, and the sum of both, which always is enough."""
    largest = F.coalesce(F.array_max(sizes), F.lit(0).cast("long"))
    share = F.ceil(total / shards).cast("long")
    start = _struct(low=F.greatest(largest, share), high=share + largest)

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("long")
        fits = _shards_needed(sizes, middle) <= shards
        return F.when(a["low"] >= a["high"], a).when(fits, _struct(low=a["low"], high=middle)).otherwise(_struct(low=middle + 1, high=a["high"]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(62)), start, halve, lambda a: a["low"])


def _latest_starts(sizes: Column, capacity: Column) -> Column:
    """Element k: the earliest unit number from which the rest fits into k + 1 shards of the capacity."""
    n = F.size(sizes)
    start = _struct(held=F.lit(0).cast("long"), at=n, found=F.array().cast("array<int>"))

    def back(a: Column, x: Column) -> Column:
        more = _struct(held=a["held"] + x, at=a["at"] - 1, found=a["found"])
        full = _struct(held=x, at=a["at"] - 1, found=F.concat(a["found"], F.array(a["at"])))
        return F.when(a["held"] + x <= capacity, more).otherwise(full)

    return F.aggregate(F.reverse(sizes), start, back, lambda a: F.concat(a["found"], F.array(F.lit(0))))


def _cuts(sizes: Column, capacity: Column, latest: Column, shards: Column, total: Column) -> Column:
    """The unit numbers at which a new shard starts."""
    zero = F.lit(0).cast("long")
    start = _struct(at=F.lit(0), held=zero, done=zero, cuts=F.array().cast("array<int>"))

    def step(a: Column, x: Column) -> Column:
        left = shards - F.size(a["cuts"]) - 1  # shards behind the current one
        even = (total - a["done"]) / (left + 1)
        rest_fits = a["at"] >= F.coalesce(F.get(latest, F.least(left, F.size(latest)).cast("int") - 1), F.size(sizes))
        end = (a["held"] + x > capacity) | ((a["held"] > 0) & (left > 0) & rest_fits & (a["held"] + x / 2 > even))
        cut = _struct(at=a["at"] + 1, held=x, done=a["done"] + a["held"], cuts=F.concat(a["cuts"], F.array(a["at"])))
        return F.when(end, cut).otherwise(_struct(at=a["at"] + 1, held=a["held"] + x, done=a["done"], cuts=a["cuts"]))

    return F.aggregate(sizes, start, step, lambda a: a["cuts"])


def unit_shards(units: DataFrame, shards: int) -> DataFrame:
    """(unit, shard) from (unit, bytes): at most 2**UNIT_BITS rows, in one row while the cuts are sought."""
    by_size = Window.orderBy(F.desc("bytes"), "unit")
    ranked = units.withColumn("rank", F.row_number().over(by_size) - 1).withColumn("rest", F.sum("bytes").over(by_size.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    even = (F.col("bytes") * (shards - F.col("rank")) >= F.col("rest")) & (F.col("rank") < shards - 1)
    # only as long as every larger one is too large as well
    alone = ranked.withColumn("alone", F.min(even.cast("int")).over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1)
    rows = F.sort_array(F.collect_list(F.when(~F.col("alone"), F.struct("unit", "bytes"))))
    one = alone.agg(F.sum(F.col("alone").cast("int")).alias("large"), F.sort_array(F.collect_list(F.when(F.col("alone"), F.struct("rank", "unit")))).alias("first"), rows.alias("rows"))
    one = one.withColumn("sizes", F.transform("rows", lambda r: r["bytes"])).withColumn("left", F.lit(shards).cast("long") - F.col("large"))
    one = one.withColumn("total", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))
    one = one.withColumn("capacity", _smallest_capacity(F.col("sizes"), F.col("left"), F.col("total")))
    one = one.withColumn("latest", _latest_starts(F.col("sizes"), F.col("capacity")))
    one = one.withColumn("cuts", _cuts(F.col("sizes"), F.col("capacity"), F.col("latest"), F.col("left"), F.col("total")))
    one = keep(one.select("large", "first", "rows", "cuts"), "shard-cuts")
    alone_rows = one.select(F.explode("first").alias("r")).select("r.unit", F.col("r.rank").cast("int").alias("shard"))
    others = one.select("large", "cuts", F.posexplode("rows").alias("at", "r"))
    number = F.size(F.filter("cuts", lambda c: c <= F.col("at")))
    return alone_rows.union(others.select("r.unit", (F.col("large") + number).cast("int").alias("shard")))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, size, text_crc32, shard, slot.

    A null text has no bytes and lies with the empty ones.  Equal rows keep a slot each; null doc_ids come first among
    equal texts.  An empty table gives no rows; with fewer units than shards, some shards are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    unit = F.shiftright(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int"), 16 - UNIT_BITS)
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"), F.crc32(text).alias("text_crc32"), unit.alias("unit"), F.xxhash64(text).alias("group"))
    rows = keep(rows, "shard-rows")
    where = unit_shards(rows.groupBy("unit").agg(F.sum("size").alias("bytes")), shards)
    placed = rows.join(F.broadcast(where), "unit")  # 2**UNIT_BITS rows at most

    # slots: rows in order over equal ranges, numbered within each range, and the ranges' counts before them
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "unit", "group", "doc_id"]
    ordered = placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered = keep(ordered.select("doc_id", "size", "text_crc32", "shard", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "shard-order")
    runs = ordered.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = runs.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    out = ordered.join(F.broadcast(runs), ["shard", "part"])  # partitions and shards
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at") - F.col("first")).alias("slot"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharded(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
