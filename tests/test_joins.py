"""Distributed dense index."""
from pyspark.sql import functions as F

from pricewell.operators.joins import with_ordered_index


def test_ordered_index_is_dense_and_in_key_order(spark):
    df = spark.range(0, 5000, 1, 7).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("key"))
    out = with_ordered_index(df, ["key"], "idx", start=100).collect()
    pairs = sorted((r.key, r.idx) for r in out)
    assert [p[1] for p in pairs] == list(range(101, 5101))


def test_ordered_index_start_may_be_a_column(spark):
    prev = spark.createDataFrame([(3,), (9,)], "k int")
    df = spark.createDataFrame([("b",), ("a",)], "key string")
    out = with_ordered_index(df, ["key"], "k", start=prev.agg(F.max("k")).scalar()).orderBy("key").collect()
    assert [(r.key, r.k) for r in out] == [("a", 10), ("b", 11)]
