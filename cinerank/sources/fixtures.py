"""Domain views derived from the driver's TPC-H-like Parquet tables.

ratings   lineitem join orders: uid=o_custkey, mid=l_partkey,
          score=ceil(l_quantity/5)/2 (0.5 .. 5.0), ts=epoch(l_shipdate)
movies    part: mid=p_partkey, name=p_name,
          genres=p_type|<words of p_name>
tags      every line: tag = the supplier's nation name
live      every event: uid=user_id, mid=props.k,
          score=least(5, greatest(0.5, ceil(value/25)/2))
factors   embeddings: mid=vec_id, features=embedding as array<double>

All views are lazy DataFrames; Catalyst prunes the Parquet columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The genre list used with the fixture data. Sixteen words of
# the part names and four part types, written in mixed case so the match is
# exercised case-insensitively ("Old" is also a substring of "cold").
GENRES = [
    "Anvil", "Blue", "Bolt", "Cold", "Gear", "Gizmo", "Hot", "Large",
    "New", "Old", "Plate", "Red", "Ring", "Rod", "Small", "Widget",
    "Economy", "Standard", "Promo", "Medium",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def _score_of_quantity(q):
    return (F.ceil(q / F.lit(5.0)) / F.lit(2.0)).cast("double")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rating_rows(spark, sf_dir)
    return r.select(
        F.col("o_custkey").cast("bigint").alias("uid"),
        F.col("l_partkey").cast("bigint").alias("mid"),
        _score_of_quantity(F.col("l_quantity")).alias("score"),
        F.unix_timestamp("l_shipdate").cast("bigint").alias("ts"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("mid"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("descri"),
        F.col("p_size").cast("string").alias("timelong"),
        F.lit("").alias("issue"),
        F.lit("").alias("shoot"),
        F.lit("").alias("language"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
        F.col("p_brand").alias("actors"),
        F.lit("").alias("directors"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line tags its part with the supplier's nation."""
    r = _rating_rows(spark, sf_dir)
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = r.join(s, r.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
    return r.select(
        F.col("o_custkey").cast("bigint").alias("uid"),
        F.col("l_partkey").cast("bigint").alias("mid"),
        F.col("n_name").alias("tag"),
        F.unix_timestamp("l_shipdate").cast("bigint").alias("ts"),
    )


def live_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, of whatever type, is a rating of the part it names."""
    e = table(spark, sf_dir, "events")
    score = F.least(F.lit(5.0), F.greatest(
        F.lit(0.5), (F.ceil(F.col("value") / F.lit(25.0)) / F.lit(2.0)).cast("double")))
    return e.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("uid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("mid"),
        score.alias("score"),
        F.unix_timestamp("ts").cast("bigint").alias("ts"),
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("bigint").alias("mid"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def genres(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The genre list as a one-column DataFrame, built JVM-side (no Python
    worker is started for a literal list)."""
    lits = [F.lit(g) for g in (names or GENRES)]
    return spark.range(1).select(F.explode(F.array(*lits)).alias("genre"))
