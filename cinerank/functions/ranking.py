"""Top-k per key and conversion between long and nested recommendation lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cinerank.session import materialize, release_unused, ship_package


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None,
          rank_col: str = "rank") -> DataFrame:
    """Rank rows within `keys` by `order` (which must be a total order) and keep
    the first `n`.

    `row_number() <= n` is planned as a partial WindowGroupLimit before the
    shuffle and a final one after it, so a hot key sends at most n rows per
    map task across the network. `n=None` ranks without a limit.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if n is not None:
        out = out.where(F.col(rank_col) <= n)
    return out


def nest_recs(df: DataFrame, key: str, mid: str = "mid", score: str = "score",
              rank: str = "rank", out: str = "recs") -> DataFrame:
    """Long (key, rank, mid, score) -> nested (key, recs array<struct<mid,score>>).

    Only for bounded lists (top-k outputs): a nested list is one row per key
    by definition. Order inside the array follows `rank`.
    """
    packed = F.struct(F.col(rank).alias("r"), F.col(mid).alias("mid"), F.col(score).alias("score"))
    arr = F.sort_array(F.collect_list(packed))
    return df.groupBy(key).agg(
        F.transform(arr, lambda s: F.struct(s["mid"].alias("mid"), s["score"].alias("score"))).alias(out))


def explode_recs(df: DataFrame, key: str, recs: str = "recs", rank: str = "rank") -> DataFrame:
    """Nested -> long form; position in the array becomes a 1-based rank."""
    return df.select(key, F.posexplode(recs).alias("pos", "rec")).select(
        key, (F.col("pos") + 1).cast("int").alias(rank),
        F.col("rec.mid").alias("mid"), F.col("rec.score").alias("score"))


def _place_fn(keys: Sequence[str]):
    """Adds each row's 1-based place among its key's rows of a sorted partition."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0      # the key before, and its rows so far
        for b in batches:
            if not b.num_rows:
                continue
            of = [b.column(k) for k in keys]
            row = np.arange(b.num_rows)
            new = np.zeros(b.num_rows, dtype=bool)
            new[0] = [c[0].as_py() for c in of] != last
            for c in of:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            start = np.maximum.accumulate(np.where(new, row, -1))
            place = np.where(start < 0, at + row, row - start) + 1
            last, at = [c[-1].as_py() for c in of], int(place[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place)], [*b.schema.names, "_place"])
    return fn


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "rank",
                size_col: str | None = None) -> DataFrame:
    """Every row's 1-based place (bigint) in the full order of its key, and
    optionally the number of the key's rows; rows with a null key are left out.

    No list is ever in one window: rows are sorted by range over (key, order),
    so a long list spans many tasks, and are written once with their place
    among the key's rows of their partition. Only a partition's first key can
    have rows in earlier partitions: their number, one row a partition at
    most, is added by a small broadcast, so the rows are shuffled once. The
    sizes of keys, if asked for, come by a join.
    """
    ship_package(df.sparkSession)
    names = [*keys, *[c for c in df.columns if c not in keys]]
    by = [*[F.asc(k) for k in keys], *order]
    dealt = df.dropna(subset=list(keys)).select(*names).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    rows = materialize(dealt.mapInArrow(_place_fn(keys), StructType([*dealt.schema, StructField("_place", LongType())])), "ranked")
    runs = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys)
    runs = runs.select(*keys, "_part", (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("_size"))
    if size_col:
        ranked = rows.join(runs, [*keys, "_part"])
        return ranked.select(*names, (F.col("_before") + F.col("_place")).alias(rank_col), F.col("_size").alias(size_col))
    later = runs.where("_before > 0").select(*keys, "_part", "_before")
    split = later.collect()
    if not split:
        return rows.select(*names, F.col("_place").alias(rank_col))
    later = F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in split], later.schema))
    ranked = rows.join(later, [*keys, "_part"], "left")
    return ranked.select(*names, (F.coalesce("_before", F.lit(0)) + F.col("_place")).alias(rank_col))


def ranked_pairs(pairs: DataFrame, key: str = "mid", other: str = "rec_mid", score: str = "score") -> DataFrame:
    """Every key's full similarity list with ranks (score descending, then the
    other id), with no limit."""
    ranked = rank_within(pairs.select(key, other, score), [key], [F.desc(score), F.asc(other)])
    release_unused(pairs.sparkSession)      # the shuffle that was written
    return ranked.select(key, "rank", other, score)
