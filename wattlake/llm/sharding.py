"""Sharding by balanced label propagation: linked documents end in few shards, sizes stay even.

Method. Documents of equal text (MD5 and length) are linked. Every document starts in the shard that
its place in hash order gives it, which cuts the bytes evenly. The linked ones are then gathered into
cells (group, first shard), and rounds of Spark joins move cells: a group's preferred shard is the one
with room that holds most of its bytes, ties by hash; the cells that want to go there are admitted in
hash order while their running sum fits under the shard's capacity, mean size times 1 + SLACK. A group
larger than a shard so fills several in turn. At the end documents without links, in hash order, fill
up what each shard lacks, which makes the sizes even again to within one document.

Law `bytes`. Null texts have size 1, no crc32 and no links; empty ones have size 1 and are linked with
each other. An empty table gives no rows. Rows repeated with the same doc_id are documents of their
own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import before, read, written

SHARDS = 16
ROUNDS = 4
SLACK = 0.01


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, g: what stands for the text, null for null texts."""
    raw = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("g"))


def even_shard(start, size, total, shards: int):
    """The shard of a document whose middle lies at start + size / 2 of total bytes."""
    return F.least(F.lit(shards - 1), F.floor((start + size / 2) * shards / total).cast("int"))


def propagate(cells: DataFrame, capacity, total_bytes: int, shards: int, rounds: int) -> DataFrame:
    """cells: g, first, bytes. Adds shard: where the cell ends after some rounds of moves."""
    cells = cells.withColumn("shard", F.col("first"))
    for turn in range(rounds):
        load = cells.groupBy("shard").agg(F.sum("bytes").alias("load"))
        every = cells.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
        # one row a shard
        room = F.broadcast(every.join(load, "shard", "left").select(F.col("shard").alias("to"), (F.lit(capacity) - F.coalesce("load", F.lit(0))).alias("room")))
        held = cells.groupBy("g", "shard").agg(F.sum("bytes").alias("held"))
        least = cells.groupBy("g").agg(F.min("bytes").alias("least"))
        open_ = held.join(room, held["shard"] == F.col("to")).join(least, "g").where("room >= least")
        target = open_.groupBy("g").agg(F.max(F.struct("held", F.xxhash64("g", "to", F.lit(turn)).alias("h"), "to"))["to"].alias("to"))
        here = held.select("g", F.col("shard"), F.col("held").alias("here"))
        there = held.select("g", F.col("shard").alias("to"), F.col("held").alias("there"))
        asked = cells.join(target, "g").where("to <> shard").join(here, ["g", "shard"]).join(there, ["g", "to"]).where("there > here or (there = here and xxhash64(g, to) > xxhash64(g, shard))")
        asked = asked.withColumn("key", F.xxhash64("g", "first"))
        admitted = before(asked.select("g", "first", "to", "bytes", "key"), ["to"], ["key", "g", "first"], "bytes", "ahead", "key").join(room, "to").where("ahead + bytes <= room").select("g", "first", "to")
        cells = written(cells.join(admitted, ["g", "first"], "left").select("g", "first", "bytes", F.coalesce("to", "shard").alias("shard")))
    return cells


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard of every row of docs."""
    rows = sized(docs)
    groups = rows.where("g is not null").groupBy("g", "size").agg(F.count("*").alias("n")).where("n > 1").select("g", "size", F.lit(True).alias("linked"))
    rows = rows.join(groups, ["g", "size"], "left").withColumn("linked", F.coalesce("linked", F.lit(False)))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "g")).withColumn("all", F.lit(0))
    rows = written(before(rows, ["all"], ["key", "doc_id"], "size", "start", "key").drop("all"))
    total = rows.agg(F.sum("size")).first()[0] or 1
    mean = total / shards
    rows = rows.withColumn("first", even_shard(F.col("start"), F.col("size"), F.lit(total), shards))
    linked = rows.where("linked")
    cells = propagate(written(linked.groupBy("g", "first").agg(F.sum("size").alias("bytes"))), mean * (1 + SLACK), total, shards, rounds)
    placed = linked.join(cells.select("g", "first", "shard"), ["g", "first"]).select("doc_id", "size", "text_crc32", "key", "shard")
    # what each shard lacks, one row a shard, and the stretch of the unlinked bytes that fills it
    load = cells.groupBy("shard").agg(F.sum("bytes").alias("load"))
    need = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(load, "shard", "left").select("shard", F.greatest(F.lit(0.0), mean - F.coalesce("load", F.lit(0))).alias("need"))
    lacks = {r.shard: r.need for r in need.collect()}
    single = rows.where("not linked").select("doc_id", "size", "text_crc32", "key").withColumn("all", F.lit(0))
    free = total - sum(r.load for r in load.collect())
    scale = free / (sum(lacks.values()) or 1)
    edges, at = [], 0.0
    for k in range(shards):
        at += lacks[k] * scale
        edges.append(at)
    middle = F.col("ahead") + F.col("size") / 2
    shard = F.lit(shards - 1)
    for k in reversed(range(shards - 1)):
        shard = F.when(middle < edges[k], k).otherwise(shard)
    filled = before(single, ["all"], ["key", "doc_id"], "size", "ahead", "key").withColumn("shard", shard)
    return placed.unionByName(filled.select("doc_id", "size", "text_crc32", "key", "shard"))


def cut_report(rows: DataFrame) -> DataFrame:
    """One row of rows (text_crc32, size, shard): groups of several rows, links (one less than a group's rows), cuts (one less
    than the shards a group lies in), the lightest and the heaviest shard in bytes."""
    groups = rows.groupBy("text_crc32", "size", "shard").agg(F.count("*").alias("n")).groupBy("text_crc32", "size").agg(F.sum("n").alias("n"), F.count("*").alias("shards")).where("n > 1")
    shards = rows.groupBy("shard").agg(F.sum("size").alias("bytes"))
    links = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("links"), F.coalesce(F.sum(F.col("shards") - 1), F.lit(0)).alias("cuts"))
    return links.crossJoin(shards.agg(F.min("bytes").alias("lightest"), F.max("bytes").alias("heaviest")))  # one row each


def slotted(rows: DataFrame) -> DataFrame:
    """Adds slot: the rows of each shard numbered from 0, in hash order."""
    return before(rows.withColumn("one", F.lit(1)), ["shard"], ["key", "doc_id"], "one", "slot", "key").withColumn("slot", F.col("slot").cast("long")).drop("one")


def op4_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = slotted(written(assign(read(spark, sf_dir, "documents"))))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_balanced_sharding": op4_balanced_sharding}
SQL: dict[str, str] = {}
