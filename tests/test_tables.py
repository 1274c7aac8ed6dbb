"""Table sinks: clustered and bucketed layouts, typed reads."""

import pytest
from pyspark.sql import functions as F

from cinerank.session import scratch_path
from cinerank.sources import schema, tables


def test_sorted_save_clusters_files(spark):
    path = scratch_path(spark, "test-sorted")
    df = spark.range(0, 10000).selectExpr("id % 97 AS uid", "id AS mid", "CAST(1.0 AS DOUBLE) AS score", "id AS ts")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # tiny data would otherwise be coalesced into one file
    try:
        tables.save_table(df, path, sort_by=["uid", "mid"])
    finally:
        spark.conf.set(key, "true")
    back = tables.load_table(spark, path, schema=schema.RATING)
    assert back.count() == 10000
    # every file holds one contiguous uid range: per-file min/max do not overlap
    per_file = back.select("uid", F.col("_metadata.file_path").alias("f")).groupBy("f").agg(
        F.min("uid").alias("lo"), F.max("uid").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in per_file.collect())
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_bucketed_save_is_a_catalog_table(spark):
    path = scratch_path(spark, "test-bucketed")
    df = spark.range(0, 1000).selectExpr("id % 31 AS uid", "id AS mid")
    tables.save_table(df, path, bucket_by=["uid"], num_buckets=4, sort_by=["uid"], table_name="t_bucketed")
    t = spark.table("t_bucketed")
    assert t.count() == 1000
    plan = t.groupBy("uid").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # bucketing satisfies the aggregation's distribution
    with pytest.raises(ValueError):
        tables.save_table(df, path + "-x", bucket_by=["uid"])


def test_typed_read_rejects_wrong_schema(spark):
    path = scratch_path(spark, "test-typed")
    spark.range(3).selectExpr("id AS mid").write.parquet(path)
    with pytest.raises(ValueError, match="uid: expected bigint, found nothing"):
        tables.load_table(spark, path, schema=schema.RATING)
