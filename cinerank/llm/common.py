"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers."""
    ship_package(spark)


def save(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write `df` below the shared folder; return it reread, and its path.

    The rows outlive lost executors, are computed once and have real sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that nothing reads any more."""
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the table carries."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def distinct_sample(rows: DataFrame, value: str, n: int) -> DataFrame:
    """`rows` with `h`, a hash of the column `value`: one row of each of the
    `n` values of the smallest hash, or of all where fewer are distinct."""
    rows = rows.withColumn("h", F.xxhash64(value))
    least, _ = save(rows.select("h").distinct().orderBy("h").limit(n), "sample")
    return rows.join(least, "h").dropDuplicates(["h"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`(id, component_id)` of every node with a link; component_id is the
    smallest id reachable.

    Large-star / small-star: every round replaces links by links to the
    smallest neighbour, as aggregations and joins; each round is a written
    table. Ends when a round changes nothing, whatever the size or depth.
    Self links and null ends are ignored; no links give an empty result.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    e = e.where("u is not null and v is not null and u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, path = save(e, "links")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = large.where("u <> v")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low2, "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            tied.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e2, path2 = save(small, "links")
        new = _state(e2)
        drop(spark, path)
        e, path = e2, path2
        if new == state:
            break
        state = new
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).groupBy("id").agg(
        F.min("component_id").alias("component_id"))


def _state(e: DataFrame) -> tuple:
    """Number and order-free checksum of the links: one row to the driver."""
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that a worker can hold several times over."""
    for b in batches:
        for a in range(0, len(b), rows):
            yield b.slice(a, rows)
