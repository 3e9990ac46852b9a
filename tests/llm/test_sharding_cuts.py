"""Cut links of the placement, counted by hand and against placing rows by hash."""

from pyspark.sql import functions as F

from wattlake.llm import sharding


def test_cuts_are_counted(spark):
    rows = spark.createDataFrame([(1, 5, 0), (1, 5, 0), (1, 5, 1), (2, 9, 3), (2, 9, 3), (3, 1, 0), (1, 6, 2)], "text_crc32 long, size long, shard int")
    r = sharding.cut_report(rows).first()
    assert (r.groups, r.links, r.cuts, r.lightest, r.heaviest) == (2, 3, 1, 5, 18)


def test_copies_are_cut_less_than_by_hash(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.when(F.col("id") % 4 == 0, F.col("id") % 80).otherwise(F.col("id")).cast("string")).alias("text"))
    placed = sharding.assign(docs).select("doc_id", "size", "text_crc32", "shard")
    ours = sharding.cut_report(placed).first()
    plain = sharding.cut_report(placed.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int"))).first()
    assert ours.links == plain.links > 900 and ours.cuts == 0 < plain.cuts
    assert ours.heaviest - ours.lightest <= 2 * 20 * 50
