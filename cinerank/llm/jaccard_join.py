"""Operator 1: n-gram Jaccard join by T-occurrence search (DivideSkip).

A text is the set of its distinct word shingles. Two texts link when
`100 * |A n B| >= percent * |A u B|`. The result is exact: every linked
pair of different texts is found, and only pairs verified on their whole
sets link.

1. Texts with the same set collapse to one representative.
2. Order all shingles: frequent ones last, the rest by hash. A linked pair
   shares one of the first `n - ceil(percent*n/100) + 1` shingles of either
   text (its short inverted lists). These lists are formed by one shuffle on
   the shingle. Frequent shingles are those whose counts, over all texts,
   pass 1/2^19 of all shingle occurrences; so at most 2^19 of them exist at
   any size and the list sent to the tasks stays under 4 MB. The order only
   steers the search; any order gives the same links.
3. Each representative is first compared with the smallest document of its
   min-hash buckets: linear work that joins large groups of near copies
   into components without listing their pairs.
4. Then every pair of documents from different components that shares a
   short list, and whose sizes and positions still allow the overlap, is
   verified. Pairs inside a component need no further look. Parity
   signatures of the sets, a bit or two a shingle, first drop the pairs whose
   sets surely differ in too many shingles; they lose no link.
5. Verification is the T-occurrence search itself: per query the shortest
   lists over its candidates are merged, candidates with at least T - L
   hits are probed by binary search in the L longest lists. The sets are
   made from the texts again, only for documents in some pair.

Groups are dealt by salted bucket; a frequent shingle's list is split by
adaptive skew handling of the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm.common import columns, connected_components, drop, prepare, save, small
from cinerank.llm.shingles import mix, set_key, shingle_sets

WIDTH = 4
PERCENT = 85
HOT_PARTS = 1 << 19   # a frequent shingle has over 1/HOT_PARTS of all occurrences
HOT_LEAST = 64
CHUNK = 2_000_000     # shingle occurrences counted at a time in a task
CHUNK_LEAST = 3       # occurrences in a chunk that are reported
MINHASHES = 6
FILTER_BITS = 24      # log2 of the bits of the candidate filter (2 MB)
PAIRS_PER_BUCKET = 400
MAX_PARITY = 16       # log2 of the most bits of a parity signature (8 KB)
MU = 0.01             # DivideSkip's weight of a probe against a merge step

_SIG = "doc_id long, n long, k1 long, k2 long, shingle long, hits long"


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in small(batches):
            rows = []
            for h in shingle_sets(batch.column(1), width):
                rows.append((len(h), *set_key(h)))
                held.append(h)
                size += len(h)
                if size >= CHUNK:
                    yield _frequent(held)
                    held, size = [], 0
            n, k1, k2 = (pa.array(x, pa.int64()) for x in zip(*rows, strict=True)) if rows else 3 * (pa.array([], pa.int64()),)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), n, k1, k2, none, none],
                                             ["doc_id", "n", "k1", "k2", "shingle", "hits"])
        if size:
            yield _frequent(held)
    return run


def _frequent(held: list[np.ndarray]) -> pa.RecordBatch:
    h, c = np.unique(np.concatenate(held), return_counts=True)
    h, c = h[c >= CHUNK_LEAST], c[c >= CHUNK_LEAST]
    none = pa.nulls(len(h), pa.int64())
    return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))],
                                      ["doc_id", "n", "k1", "k2", "shingle", "hits"])


def _prefixes(width: int, percent: int, hot):
    seeds = mix(np.arange(1, MINHASHES + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = hot.value
        for batch in small(batches):
            n, k1, k2, lists, least, parity = [], [], [], [], [], []
            for h in shingle_sets(batch.column(1), width):
                size = len(h)
                least += [mix(h ^ x).min().astype(np.int64) for x in seeds] if size else [0] * MINHASHES
                parity.append(_parity(h))
                if len(common) and size:
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    last = common[at] == h
                    h2 = np.concatenate((h[~last], h[last]))
                else:
                    h2 = h
                key = set_key(h)
                n.append(size)
                k1.append(key[0])
                k2.append(key[1])
                lists.append(h2[:size - (-(-percent * size // 100)) + 1 if size else 0].view(np.int64))
            flat = np.concatenate(lists) if lists else np.empty(0, np.int64)
            ends = np.cumsum([0, *map(len, lists)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * MINHASHES, pa.int32()), pa.array(least, pa.int64())),
                 pa.array(parity, pa.binary())],
                ["doc_id", "n", "k1", "k2", "prefix", "minhash", "parity"])
    return run


def _parity(h: np.ndarray) -> bytes:
    """For each value of the hash's last bits, whether it is hit oddly often;
    at least two such values a shingle, up to 2^MAX_PARITY."""
    bits = 1 << min(MAX_PARITY, max(6, int(2 * len(h) - 1).bit_length()))
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one set only: each adds one odd hit.
    Dropping a bit of the hash adds up the halves."""
    x, y = (np.frombuffer(v, dtype=np.uint8) for v in (a, b))
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _plausible(percent: int):
    """Drops pairs whose sets differ in more shingles than a link allows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            size = np.asarray(b.column(2)) + np.asarray(b.column(3))
            most = size - 2 * -(-percent * size // (100 + percent))
            ok = [_apart(x, y) <= m for x, y, m in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), most.tolist(), strict=True)]
            yield b.select(["q", "c"]).filter(pa.array(ok, pa.bool_()))
    return run


def _sets(width: int, wanted):
    """Whole sets of the documents the filter lets pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in small(batches):
            ids = batch.column(0).cast(pa.int64())
            slot = np.asarray(ids) & ((1 << FILTER_BITS) - 1)  # other documents may pass: they only cost their set
            take = pa.array(((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool))
            ids, text = ids.filter(take), batch.column(1).filter(take)
            out = [(i, len(h), *set_key(h), h.tobytes()) for i, h in zip(ids.to_pylist(), shingle_sets(text, width), strict=True) if len(h)]
            cols = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, 4 * [pa.int64()] + [pa.binary()], strict=True)],
                                             ["doc_id", "n", "k1", "k2", "hashes"])
    return run


def _sets_of(pairs: DataFrame, docs: DataFrame, groups: DataFrame, width: int) -> tuple[DataFrame, str]:
    """The sets of the documents in `pairs`, read from their texts again: a
    filter of fixed size goes to the tasks, the texts stay where they are."""
    spark = docs.sparkSession
    ids = pairs.select(F.explode(F.array("q", "c")).alias("doc_id")).distinct()
    words = ids.select(F.expr(f"cast(doc_id & {(1 << FILTER_BITS) - 1} as int)").alias("i")).groupBy(F.shiftright("i", 5).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(i & 31 as int))")).alias("bits")).collect()  # at most 2^19 rows
    wanted = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    for r in words:
        wanted[r["w"]] = r["bits"]
    wanted = spark.sparkContext.broadcast(wanted.view(np.uint8))
    sets = docs.where("doc_id is not null").mapInArrow(_sets(width, wanted), "doc_id long, n long, k1 long, k2 long, hashes binary")
    sure = groups.withColumnRenamed("rep", "doc_id").join(ids, "doc_id", "left_semi")
    sets = sets.join(sure, ["doc_id", "n", "k1", "k2"], "left_semi").dropDuplicates(["doc_id", "n", "k1", "k2"])
    return save(sets.select("doc_id", "hashes"), "op1-sets")


def divide_skip(query: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of `sets` reach the overlap that `percent` asks of them with
    `query`: the short inverted lists are merged, the long ones probed."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    need = -(-percent * (sizes + len(query)) // (100 + percent))
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]          # inverted lists, owners ascending
    low, high = np.searchsorted(flat, query, "left"), np.searchsorted(flat, query, "right")
    length = high - low
    by_length = np.argsort(length, kind="stable")
    longest = int(max(length.max(initial=1), 2))
    n_long = int(need.min() / (MU * np.log2(longest) + 1))
    n_long = min(n_long, int(need.min()) - 1, len(query))
    short, long_ = by_length[:len(query) - n_long], by_length[len(query) - n_long:]
    hits = np.zeros(len(sets), dtype=np.int64)
    part = length[short]
    if part.sum():  # merge of the short lists
        at = np.repeat(low[short] - np.concatenate(([0], np.cumsum(part)[:-1])), part) + np.arange(part.sum())
        hits += np.bincount(owner[at], minlength=len(sets))
    alive = np.flatnonzero(hits >= need - n_long)
    if len(alive) and n_long:  # binary probes of the long lists
        width = len(sets)
        filled = long_[length[long_] > 0]
        part = length[filled]
        if len(filled):
            at = np.repeat(low[filled] - np.concatenate(([0], np.cumsum(part)[:-1])), part) + np.arange(part.sum())
            index = np.repeat(np.arange(len(filled)), part) * width + owner[at]
            for i in alive:
                probe = np.arange(len(filled)) * width + i
                where = np.minimum(np.searchsorted(index, probe), len(index) - 1)
                hits[i] += int((index[where] == probe).sum())
    return hits >= need


def _verify(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        candidates = group[group["c"].notna()]
        queries = group[group["c"].isna()]
        sets = {}
        for q, c, b in zip(candidates["q"], candidates["c"], candidates["hashes"], strict=True):
            sets.setdefault(q, []).append((int(c), np.frombuffer(b, dtype=np.uint64)))
        for q, b in zip(queries["q"], queries["hashes"], strict=True):
            mine = sets.get(q, [])
            if mine:
                ok = divide_skip(np.frombuffer(b, dtype=np.uint64), [h for _, h in mine], percent)
                found += [(int(q), c) for (c, _), good in zip(mine, ok, strict=True) if good and c != q]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _links(pairs: DataFrame, docs: DataFrame, reps: DataFrame, groups: DataFrame, width: int, percent: int, name: str) -> tuple[DataFrame, str]:
    """Pairs `(q, c)` that reach the overlap, as a written table `(a, b)`.

    A query is dealt with its candidates; one with very many is dealt in
    parts, each with the query's set."""
    signed = reps.select("doc_id", "n", "parity")
    p, q = signed.toDF("q", "qn", "qp"), signed.toDF("c", "cn", "cp")
    pairs = pairs.join(q, "c").join(p, "q").select("q", "c", "qn", "cn", "qp", "cp").mapInArrow(_plausible(percent), "q long, c long")
    pairs, path = save(pairs.distinct(), f"{name}-pairs")
    buckets = max(1, -(-pairs.count() // PAIRS_PER_BUCKET))
    sets, sets_path = _sets_of(pairs, docs, groups, width)
    many = pairs.groupBy("q").agg(F.ceil(F.count("*") / PAIRS_PER_BUCKET).cast("long").alias("parts"))
    pairs = pairs.join(many, "q").select("q", "c", F.pmod(F.xxhash64("c"), F.col("parts")).alias("part"))
    bucket = F.pmod(F.xxhash64("q", "part"), F.lit(buckets)).alias("bucket")
    left = pairs.join(sets, F.col("c") == F.col("doc_id")).select(bucket, "q", "c", "hashes")
    mine = (pairs.select("q", "part").distinct().join(sets, F.col("q") == F.col("doc_id"))
            .select(bucket, "q", F.lit(None).cast("long").alias("c"), "hashes"))
    found = left.unionByName(mine).groupBy("bucket").applyInPandas(_verify(percent), "a long, b long").distinct()
    out, to = save(found, f"{name}-links")
    drop(pairs.sparkSession, path, sets_path)
    return out, to


def jaccard_join(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): doc_id, n_shingles,
    component_id (smallest doc_id reachable by links, itself included).

    Null, empty or blank texts have no shingles and are their own component.
    A null doc_id takes no part and gets a null component. Repeated rows
    come back as often as they came; other columns are ignored. An empty
    table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    docs = columns(docs, "doc_id", "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig, _ = save(docs.mapInArrow(_signatures(width), _SIG), "op1-sig")
    rows = sig.where("hits is null")
    total = rows.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_LEAST, total // HOT_PARTS)
    hot = [r[0] for r in sig.where("hits is not null").groupBy("shingle").agg(F.sum("hits").alias("hits"))
           .where(F.col("hits") >= limit).select("shingle").collect()]  # at most HOT_PARTS longs
    hot = spark.sparkContext.broadcast(np.sort(np.array(hot, dtype=np.int64).view(np.uint64)))
    groups, _ = save(rows.where("n > 0 and doc_id is not null").groupBy("n", "k1", "k2")
                     .agg(F.min("doc_id").alias("rep")), "op1-groups")

    lists = docs.where("doc_id is not null").mapInArrow(
        _prefixes(width, percent, hot),
        "doc_id long, n long, k1 long, k2 long, prefix array<long>, minhash array<long>, parity binary").where("n > 0")
    reps = lists.join(groups.withColumnRenamed("rep", "doc_id"), ["doc_id", "n", "k1", "k2"], "left_semi")
    reps, reps_path = save(reps.dropDuplicates(["doc_id", "n", "k1", "k2"]), "op1-reps")
    entries = reps.select("doc_id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "shingle"))
    entries = entries.withColumn("in_list", F.expr("count(1) over (partition by shingle)")).where("in_list > 1").drop("in_list")
    entries, entries_path = save(entries, "op1-lists")

    # large groups first: each document against the smallest of its min-hash buckets
    keyed = reps.select("doc_id", F.posexplode("minhash").alias("k", "h"))
    pivot = keyed.groupBy("k", "h").agg(F.min("doc_id").alias("q"), F.count("*").alias("m")).where("m > 1").drop("m")
    pairs = (keyed.join(pivot, ["k", "h"]).where("q <> doc_id").groupBy("q", F.col("doc_id").alias("c"))
             .agg(F.count("*").alias("same")).where(f"same * 2 >= {MINHASHES}").select("q", "c"))
    near, near_path = _links(pairs, docs, reps, groups, width, percent, "op1-near")
    first, _ = save(connected_components(near), "op1-first")

    # then whatever pair of different components can still reach the overlap
    known = entries.join(first.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    mixed = known.groupBy("shingle").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where(
        "lo < hi").select("shingle")
    known, known_path = save(known.join(mixed, "shingle"), "op1-open")
    x, y = known.alias("x"), known.alias("y")
    need = f"ceil({percent} * (x.n + y.n) / {100 + percent}.0)"
    rest = x.join(y, F.expr(
        "x.shingle = y.shingle and x.doc_id < y.doc_id and x.component_id <> y.component_id"
        f" and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
        f" and least(x.n - x.pos, y.n - y.pos) >= {need}")).select(
        F.col("x.doc_id").alias("q"), F.col("y.doc_id").alias("c")).distinct()
    more, more_path = _links(rest, docs, reps, groups, width, percent, "op1-rest")
    lead = first.select(F.col("id").alias("i"), F.col("component_id").alias("l"))
    over = (more.join(lead, F.col("a") == F.col("i"), "left").select(F.coalesce("l", "a").alias("a"), "b")
            .join(lead, F.col("b") == F.col("i"), "left").select("a", F.coalesce("l", "b").alias("b")))
    second = connected_components(over).select(F.col("id").alias("l"), F.col("component_id").alias("top"))
    labels = (groups.join(first, F.col("rep") == F.col("id"), "left")
              .select("n", "k1", "k2", F.coalesce("component_id", "rep").alias("l"))
              .join(second, "l", "left").select("n", "k1", "k2", F.coalesce("top", "l").alias("component_id")))
    labels, _ = save(labels, "op1-labels")
    drop(spark, reps_path, entries_path, near_path, known_path, more_path)
    return (rows.join(labels, ["n", "k1", "k2"], "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))
