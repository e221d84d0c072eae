"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has SLOTS slots. Each shard owns ``replicas`` virtual nodes, put on
slots by hash; a key's slot is the hash of its id, and its arc belongs to the
next virtual node clockwise. A shard takes rows up to its capacity; the rest of
an arc continues clockwise to the next shard that isn't full. Capacities are
the row count dealt evenly (the bound of the load is 1), so shard sizes differ
by one row at most, while most rows stay where the plain ring puts them.

Rows aren't moved one by one. They are counted by slot, the counts are added up
by arc (shards x replicas of them), and one loop over the arcs in ring order
decides how many rows of each arc go to which shard. A row then finds its place
by its rank within its slot; a slot with very many rows (those of one key, say)
is ranked in shares, and the shares before are added. Only DataFrame functions
are used.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small, table, text_bytes, written

#: Slots of the ring: the most rows that any lookup table here has, about 2 MB.
SLOTS = 65_536
REPLICAS = 64
#: Rows of a slot that are ranked in one task.
SHARE_ROWS = 50_000


def _slot(*key: Column | str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(SLOTS)).cast("int")


def ring(spark: SparkSession, shards: int, replicas: int = REPLICAS) -> DataFrame:
    """(slot, arc): the arc of each slot; arcs are numbered clockwise."""
    node = spark.range(shards).select(F.col("id").cast("int").alias("shard")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(replicas))))
    # Nodes that fall on one slot: the smallest shard keeps it.
    node = node.select(_slot(F.lit("node"), "shard", "copy").alias("slot"), "shard").groupBy("slot").agg(F.min("shard").alias("shard"))
    slots = spark.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    # From the last slot down: a slot's node is the one met last.
    downwards = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = slots.join(F.broadcast(node), "slot", "left")
    # Behind the last node, the first one is next.
    first = node.agg(F.min_by(F.struct(F.col("slot").alias("arc"), "shard"), "slot").alias("first"))
    own = F.when(F.col("shard").isNotNull(), F.struct(F.col("slot").alias("arc"), "shard"))
    found = marked.select("slot", F.last(own, ignorenulls=True).over(downwards).alias("own")).join(F.broadcast(first), F.lit(True))
    return found.select("slot", F.coalesce("own", "first").alias("own")).select("slot", "own.arc", "own.shard")


def deal(arcs: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, shard, low, high, start) from (arc, shard, rows), clockwise: rows low..high-1 of the arc go to the shard, from its slot number start on."""
    rows = sum(n for _, _, n in arcs)
    free = [rows // shards + (s < rows % shards) for s in range(shards)]
    used, out = [0] * shards, []
    for at, (arc, _, n) in enumerate(arcs):
        low = 0
        for step in range(len(arcs)):
            if low == n:
                break
            shard = arcs[(at + step) % len(arcs)][1]
            if taken := min(n - low, free[shard]):
                out.append((arc, shard, low, low + taken, used[shard]))
                free[shard] -= taken
                used[shard] += taken
                low += taken
    return out


def bounded_ring(rows: DataFrame, key: str, shards: int = 16, replicas: int = REPLICAS, tie: tuple[str, ...] = (), share_rows: int = SHARE_ROWS) -> DataFrame:
    """rows with shard and slot (its number within the shard, gapless from 0).

    ``key`` decides the place on the ring; ties of equal keys are broken by
    ``tie``, and rows that are alike in all of these may swap places, which
    changes nothing. A null key has a place like any other. An empty table
    gives no rows. Columns of the names shard and slot are replaced, others
    kept. The rows are written once, with a number each, so keep them narrow:
    what is long is better joined by key behind.
    """
    spark = rows.sparkSession
    rows = written(rows.drop("shard", "slot").withColumns({"__slot": _slot(F.lit("key"), key), "__row": F.monotonically_increasing_id()}), "ring-rows")
    places = ring(spark, shards, replicas)
    count = rows.groupBy("__slot").agg(F.count("*").alias("n"))
    slots = places.join(count, F.col("slot") == F.col("__slot"), "left").select("slot", "arc", "shard", F.coalesce("n", F.lit(0)).alias("n"))
    before = Window.partitionBy("arc").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    arcs = slots.groupBy("arc").agg(F.min("shard").alias("shard"), F.sum("n").alias("n"))
    # At most shards x replicas counts come to the driver, and as many pieces and a few more go back, as a literal.
    dealt = deal([(r.arc, r.shard, r.n) for r in arcs.orderBy("arc").collect()], shards)
    kind = "array<struct<__arc:int,__shard:int,low:bigint,high:bigint,start:bigint>>"
    named = [dict(zip(("__arc", "__shard", "low", "high", "start"), piece, strict=True)) for piece in dealt]
    pieces = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(named)), kind)))
    # At most SLOTS + shards x replicas + (overflowing pieces) rows: bounded, however many rows there are.
    plan = slots.where("n > 0").join(F.broadcast(pieces), (F.col("arc") == F.col("__arc")) & (F.col("low") < F.col("before") + F.col("n")) & (F.col("high") > F.col("before")))
    plan = plan.select(F.col("slot").alias("__slot"), F.col("__shard").alias("shard"), (F.col("low") - F.col("before")).alias("__low"), (F.col("high") - F.col("before")).alias("__high"), (F.col("start") - F.col("low") + F.col("before")).alias("__start"))
    # Slots of more rows than a task should rank have shares, by the row's number: as many as their rows need.
    many = slots.where(F.col("n") > share_rows).select(F.col("slot").alias("__slot"), F.ceil(F.col("n") / share_rows).cast("int").alias("__shares"))
    own = rows.join(F.broadcast(many), "__slot", "left").withColumn("__share", F.coalesce(F.pmod(F.xxhash64("__row"), "__shares"), F.lit(0)).cast("int"))
    shares = own.where("__shares is not null").groupBy("__slot", "__share").agg(F.count("*").alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy("__slot").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1))
    shares = shares.select("__slot", "__share", F.coalesce(earlier, F.lit(0)).alias("__earlier"))
    rank = F.row_number().over(Window.partitionBy("__slot", "__share").orderBy(key, *tie)) - 1
    ranked = own.withColumn("__rank", rank).join(small(shares), ["__slot", "__share"], "left").withColumn("__rank", F.col("__rank") + F.coalesce("__earlier", F.lit(0)))
    placed = ranked.join(F.broadcast(plan), "__slot").where("__rank >= __low and __rank < __high")
    return placed.withColumn("slot", F.col("__start") + F.col("__rank")).drop("__slot", "__row", "__shares", "__share", "__earlier", "__rank", "__low", "__high", "__start")


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"), F.crc32(text_bytes(F.col("text"))).alias("text_crc32"))
    out = bounded_ring(rows, "doc_id", 16, tie=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
