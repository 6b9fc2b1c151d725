"""The salted lookup join spreads a hot key over several tasks and gives
the same rows as a plain join."""

from pyspark.sql import functions as F

from amity.operators.skew import hot_pieces, lookup_join


def test_hot_key_is_split_over_tasks(spark):
    # one key holds 90% of the rows of the big side
    big = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(F.lit(7)).alias("k"),
        F.col("id").alias("payload"))
    lookup = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("val"))
    counts = big.groupBy("k").count()
    pieces = hot_pieces(counts, "k", "count", floor_rows=1000)
    n7 = big.where(F.col("k") == 7).count()
    assert {r[0]: r[1] for r in pieces.collect()} == {7: -(-n7 // 1000)}

    spark.conf.set("spark.sql.adaptive.enabled", "false")   # keep the 8 shuffle partitions visible
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(big, lookup, "k", pieces, "left")
        parts = (joined.where(F.col("k") == 7)
                 .select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1   # the hot key is no longer one task
        plain = big.join(lookup, "k", "left").select("k", "payload", "val")
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_inner_drops_missing(spark):
    big = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, p string")
    lookup = spark.createDataFrame([(1, 10)], "k long, val long")
    pieces = spark.createDataFrame([(1, 3)], "k long, __pieces int")
    assert sorted(map(tuple, lookup_join(big, lookup, "k", pieces, "inner").collect())) == [(1, "a", 10)]
    assert sorted(map(tuple, lookup_join(big, lookup, "k", pieces, "left").collect()),
                  key=str) == sorted([(1, "a", 10), (2, "b", None), (None, "c", None)], key=str)


def test_every_hot_key_is_named_within_the_bound(spark):
    # 50 keys of 100 rows: the threshold follows the total, never a count of keys
    counts = spark.range(0, 50).select(F.col("id").alias("k"), F.lit(100).cast("bigint").alias("count"))
    assert hot_pieces(counts, "k", "count", floor_rows=10).count() == 50
    assert hot_pieces(counts, "k", "count", floor_rows=10, max_hot=40).count() == 0      # 5000 / 40 = 125 rows
    uneven = counts.withColumn("count", F.when(F.col("k") < 3, F.lit(1000)).otherwise(F.col("count")).cast("bigint"))
    assert {r.k for r in hot_pieces(uneven, "k", "count", floor_rows=10, max_hot=40).collect()} == {0, 1, 2}
