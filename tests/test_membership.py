"""The Bloom filter never loses a key and the semi join is exact."""

from pyspark.sql import functions as F

from zonecast.operators import membership


def test_semi_join_is_exact(spark):
    rows = spark.range(20_000).select((F.col("id") % 5_000).cast("string").alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "k string, id long"))
    keys = spark.range(0, 5_000, 7).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,), ("no",)], "k string"))
    got = membership.semi_join_filtered(rows, keys, "k")
    want = {i for i in range(20_000) if (i % 5_000) % 7 == 0}
    assert sorted(r.id for r in got.collect()) == sorted(want)
    assert got.columns == rows.columns


def test_filter_lets_little_through(spark):
    bits = membership.bloom_filter(spark.range(10_000), "id").first().bits
    assert len(bits) == membership.WORDS
    others = spark.range(10**6, 10**6 + 50_000).withColumn("b", F.lit(bits))
    assert others.where(membership.may_contain(F.col("b"), F.col("id"))).count() < 100
    assert spark.range(10_000).withColumn("b", F.lit(bits)).where(membership.may_contain(F.col("b"), F.col("id"))).count() == 10_000


def test_no_keys_and_full_filter(spark, monkeypatch):
    rows = spark.range(100)
    assert membership.semi_join_filtered(rows, rows.where("id < 0"), "id").count() == 0
    monkeypatch.setattr(membership, "WORDS", 1)                # everything passes: the join decides
    assert membership.semi_join_filtered(rows, rows.where("id % 2 = 0"), "id").count() == 50
