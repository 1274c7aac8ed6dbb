"""Equi-joins whose hot keys are split on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# A key with more rows than this on a side is split there.
SPLIT_ROWS = 100_000
# So many keys a side are split at most, the hottest first. A key beyond them
# holds less than 1/MAX_HOT of its side, so no split is missed that matters,
# and the table of hot keys is small enough to broadcast at any input size.
MAX_HOT = 10_000

# A value of each type of keys.
_SOME = {StringType: "", LongType: 0, IntegerType: 0}


def hot_keys(counts: DataFrame, keys: Sequence[str], out: str, split_rows: int, max_hot: int = MAX_HOT) -> DataFrame:
    """(keys, out): the number of parts of each hot key, from (keys, _n)."""
    return (counts.where(F.col("_n") > split_rows).orderBy(F.desc("_n"), *keys).limit(max_hot)
            .select(*keys, F.ceil(F.col("_n") / F.lit(split_rows)).cast("int").alias(out)))


def skew_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], split_rows: int = SPLIT_ROWS,
              left_counts: DataFrame | None = None, right_counts: DataFrame | None = None,
              right_hot: bool = True) -> DataFrame:
    """left INNER JOIN right ON `on`, with a grid of salts for hot keys.

    A key with l rows on the left and r on the right gets L = ceil(l / split)
    by R = ceil(r / split) cells. A left row lies in one of the L rows of the
    grid, by a hash of all its columns, and is copied to the R columns; a
    right row the other way round. So a cell joins at most about `split` by
    `split` rows, whichever side is hot. Keys that are not hot have one cell
    and no copies. The sizes come from counts of each side (partial
    aggregates), or from `left_counts` / `right_counts` (keys, _n) if given;
    `right_hot=False` says that a key has few rows there by construction, so
    that R = 1 and nothing is counted.
    The hot keys, at most 2 * MAX_HOT rows, are known before the join is
    planned, and their table is never empty: joined with an empty one, a side
    would seem empty, and the adaptive planner would broadcast it, whatever its
    size. Without a hot key the table holds one that is not split, there are no
    salts, and the right side is left as it is.
    Columns other than the keys must have different names.
    """
    keys = [on] if isinstance(on, str) else list(on)

    def hot(df, given, own):
        counts = given if given is not None else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return hot_keys(counts.dropna(subset=keys), keys, "_parts", split_rows).select(*keys, "_parts", F.lit(own).alias("_own"))
    found = hot(left, left_counts, 0)
    if right_hot:
        found = found.unionByName(hot(right, right_counts, 1))
    parts: dict[tuple, list[int]] = {}
    for r in found.collect():
        parts.setdefault(tuple(r[k] for k in keys), [1, 1])[r["_own"]] = r["_parts"]
    schema = StructType([*[found.schema[k] for k in keys], StructField("_lparts", IntegerType()), StructField("_rparts", IntegerType())])
    some = [_SOME.get(type(found.schema[k].dataType)) for k in keys]
    rows = [(*k, *n) for k, n in parts.items()] or [(*some, 1, 1)]
    grid = F.broadcast(left.sparkSession.createDataFrame(rows, schema))
    if not parts:
        sized = left if None in some else left.join(grid, keys, "left").select(*left.columns)
        return sized.join(right, keys)

    def spread(df, own, own_salt, other, other_salt):
        parts = {c: F.coalesce(F.col(c), F.lit(1)) for c in (own, other)}
        return df.join(grid, keys, "left").select(
            *df.columns, F.pmod(F.xxhash64(*df.columns), parts[own]).cast("int").alias(own_salt),
            F.explode(F.sequence(F.lit(0), parts[other] - 1)).alias(other_salt))
    a = spread(left, "_lparts", "_ls", "_rparts", "_rs")
    b = spread(right, "_rparts", "_rs", "_lparts", "_ls")
    return a.join(b, [*keys, "_ls", "_rs"]).drop("_ls", "_rs")
