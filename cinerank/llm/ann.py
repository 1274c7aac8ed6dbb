"""Operator 4: approximate nearest neighbours by NN-descent and graph search.

Index, over every row. Equal vectors share a node. Each node starts with the
nearest of some leaves of random hyperplane partitions (a leaf has about LEAF
nodes; larger ones are split by a hash). Then ROUNDS rounds of NN-descent:
MEMBERS of the neighbours that a node has, new ones first, and MEMBERS of the
nodes that have it meet in a local join. Of the pairs nearer than what either
end has, a join offers each member its OFFERS nearest and a block passes on
each node's KEPT nearest; the K nearest of old and offered ones become the
list. A round is a Spark join that deals nodes out in blocks, with each vector
a block needs once: a vector goes to a block for each node it is a member of
at most, so TREES and 2 * MEMBERS a round bound its copies on average,
whatever the number of rows.

Vectors are compared with those of their own length only. All lengths share
the jobs: leaves, blocks and entries are made for each length, so lists never
lead from one length to another.

Search. All queries advance together: a round expands the EXPAND nearest
unexpanded nodes of each query's beam of BEAM nodes by a join with the
graph, scores what that query has not scored yet, and ends when every beam is
expanded. A query's beam is one row of arrays. Beams start from the query's
own neighbours, as it is a node too, and ENTRIES others.

K, BEAM and EXPAND bound the search, not the data: every row is indexed, and
a table with at most BEAM nodes is searched whole. Members beyond MEMBERS are
skipped in a round of the descent and reverse neighbours beyond REVERSE in the
search; that is the method's sampling, and recall is measured against brute
force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, drop, prepare, save
from cinerank.llm.embedding_dedup import usable

K = 24
LEAF = 1000
TREES = 8
ROUNDS = 2
MEMBERS = 6
BLOCK = 512
REVERSE = 48
BEAM = 448
EXPAND = 112
ENTRIES = 64
OFFERS = 4
KEPT = 10

# n: the vectors' length, blocks: the blocks that its nodes are dealt to
_EDGE = "id long, nbr long, d double, n int, blocks int"


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.frombuffer(b"".join(column), dtype=np.float32).reshape(len(column), -1)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(len(column), -1)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(-1)[..., :, None] + (y * y).sum(-1)[..., None, :] - 2 * (x @ np.swapaxes(y, -1, -2))
    return np.maximum(d, 0)


def _edges(id_, nbr, d, like: pd.DataFrame) -> pd.DataFrame:
    """Edges between nodes of one length, that of the rows in `like`."""
    return pd.DataFrame({"id": np.asarray(id_, dtype=np.int64), "nbr": np.asarray(nbr, dtype=np.int64), "d": np.asarray(d, dtype=np.float64),
                         "n": np.int32(like["n"].iat[0]), "blocks": np.int32(like["blocks"].iat[0])})


def _leaf_neighbours(k: int):
    def run(leaf: pd.DataFrame) -> pd.DataFrame:
        ids, x = leaf["id"].to_numpy(), _matrix(leaf["v"])
        d = _squared(x, x)
        np.fill_diagonal(d, np.inf)
        n = min(k, len(ids) - 1)
        if n < 1:
            return _edges([], [], [], leaf)
        at = np.argpartition(d, n - 1, axis=1)[:, :n]
        return _edges(np.repeat(ids, n), ids[at].ravel(), np.take_along_axis(d, at, 1).ravel(), leaf)
    return run


def _local_join(block: pd.DataFrame) -> pd.DataFrame:
    """Rows with a vector are the block's vectors, the others memberships."""
    has = block["v"].notna()
    vec = block[has].drop_duplicates("u").sort_values("u")
    ids, x, worst = vec["u"].to_numpy(), _matrix(vec["v"]), vec["worst"].to_numpy()
    member = block[~has].sort_values(["node", "u", "new"], ascending=[True, True, False]).drop_duplicates(["node", "u"])
    node, u, new = member["node"].to_numpy(), np.searchsorted(ids, member["u"].to_numpy()), member["new"].to_numpy(dtype=bool)
    start = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.empty(0, int)
    size = np.diff(np.concatenate((start, [len(node)])))
    a_all, b_all, d_all = [], [], []
    for lo in range(0, len(start), 256):
        s, c = start[lo:lo + 256], size[lo:lo + 256]
        width = int(c.max())
        if width < 2:
            continue
        grid = np.minimum(s[:, None] + np.arange(width), len(node) - 1)
        real = np.arange(width) < c[:, None]
        m, fresh = u[grid], new[grid] & real
        d = _squared(x[m], x[m]).astype(np.float32)
        fine = real[:, :, None] & real[:, None, :] & (fresh[:, :, None] | fresh[:, None, :]) & (m[:, :, None] != m[:, None, :])
        d[~fine | (d >= worst[m][:, :, None])] = np.inf
        n = min(OFFERS, width)
        best = np.argpartition(d, n - 1, axis=2)[:, :, :n]
        value = np.take_along_axis(d, best, 2)
        g, i, j = np.nonzero(np.isfinite(value))
        a_all.append(m[g, i])
        b_all.append(m[g, best[g, i, j]])
        d_all.append(value[g, i, j])
    if not a_all:
        return _edges([], [], [], block)
    a, b, d = np.concatenate(a_all), np.concatenate(b_all), np.concatenate(d_all)
    key = a.astype(np.int64) * len(ids) + b
    _, first = np.unique(key, return_index=True)
    a, b, d = a[first], b[first], d[first]
    order = np.lexsort((d, a))
    a, b, d = a[order], b[order], d[order]
    begin = np.concatenate(([True], a[1:] != a[:-1]))
    place = np.arange(len(a)) - np.maximum.accumulate(np.where(begin, np.arange(len(a)), 0))
    keep = place < KEPT
    return _edges(ids[a[keep]], ids[b[keep]], d[keep], block)


def _nearest(edges: DataFrame, k: int, turn: int) -> DataFrame:
    """The k nearest of each node, with their rank `r` and whether they are
    `drawn` as members of the next round. Rows are dealt by id once."""
    edges = edges.repartition("id").groupBy("id", "nbr").agg(
        F.min("d").alias("d"), F.min("new").alias("new"), F.first("n").alias("n"), F.first("blocks").alias("blocks"))
    ranked = edges.withColumn("r", F.expr("row_number() over (partition by id order by d, nbr)")).where(F.col("r") <= k)
    return ranked.withColumn("drawn", F.expr(f"row_number() over (partition by id order by not new, xxhash64(id, nbr, {turn})) <= {MEMBERS}"))


def _reverse(graph: DataFrame, limit: int, order: str) -> DataFrame:
    back = graph.withColumn("r", F.expr(f"row_number() over (partition by nbr order by {order})"))
    return back.where(F.col("r") <= limit).drop("r")


def build_graph(nodes: DataFrame, *, k: int = K, rounds: int = ROUNDS, leaf: int = LEAF, trees: int = TREES, seed: int = 7) -> tuple[DataFrame, str]:
    """`(id, nbr, d)`, the k nearest found of each of `nodes` (`id`, `v`:
    float32 bytes) among those of its length, nearest by squared distance;
    and the table's path."""
    spark = nodes.sparkSession
    prepare(spark)
    nodes = nodes.select("id", "v", (F.length("v") / 4).cast("int").alias("n"))
    lengths = nodes.groupBy("n").agg(F.count("*").alias("c"))
    lengths = lengths.select("n", "c", F.greatest(F.ceil(F.log2(F.col("c") / F.lit(float(leaf)))), F.lit(0)).cast("int").alias("bits"),
                             F.ceil(F.col("c") / F.lit(float(BLOCK))).cast("int").alias("blocks"))
    lengths, lengths_path = save(lengths, "op4-lengths")

    def deal(vectors: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                length = b.column(2).to_numpy()
                for n in np.unique(length):
                    mine = b.filter(pa.array(length == n))
                    x, bits = _matrix(mine.column(1)), mine.column(3)[0].as_py()
                    planes = np.random.default_rng([seed, n]).normal(size=(trees, bits, n)).astype(np.float32)
                    for t in range(trees):
                        code = ((x @ planes[t].T > 0) << np.arange(bits)).sum(1) if bits else np.zeros(len(x), dtype=np.int64)
                        place = [mine.column(2), pa.array(np.full(len(x), t), pa.int32()), pa.array(code.astype(np.int64))]
                        if vectors:
                            yield pa.RecordBatch.from_arrays([*place, mine.column(0), mine.column(1), mine.column(4)], ["n", "tree", "code", "id", "v", "blocks"])
                        else:
                            yield pa.RecordBatch.from_arrays(place, ["n", "tree", "code"])
        return run

    dealt = nodes.join(lengths, "n").select("id", "v", "n", "bits", "blocks")
    sizes = dealt.mapInArrow(deal(False), "n int, tree int, code long").groupBy("n", "tree", "code").agg(
        F.ceil(F.count("*") / (2.0 * leaf)).cast("long").alias("parts"))
    sizes, sizes_path = save(sizes, "op4-leaves")
    dealt = dealt.mapInArrow(deal(True), "n int, tree int, code long, id long, v binary, blocks int").join(sizes, ["n", "tree", "code"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))
    first = dealt.groupBy("n", "tree", "code", "part").applyInPandas(_leaf_neighbours(k), _EDGE)
    graph, path = save(_nearest(first.withColumn("new", F.lit(True)), k, 0), "op4-graph")
    drop(spark, sizes_path, lengths_path)
    for turn in range(rounds):
        mine = graph.where("drawn").select(F.col("id").alias("node"), F.col("nbr").alias("u"), "new", "n", "blocks")
        back = _reverse(graph, MEMBERS, f"not new, xxhash64(id, nbr, {turn})").select(F.col("nbr").alias("node"), F.col("id").alias("u"), "new", "n", "blocks")
        member = mine.unionByName(back).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        worst = graph.where(F.col("r") == k).select("id", F.col("d").alias("worst"))
        held = nodes.select("id", "v").join(worst, "id", "left").select("id", "v", F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
        need = member.select("n", "block", F.col("u").alias("id"), "blocks").repartition("id").distinct().join(held, "id")
        # no column but v is null, as nulls would turn numbers into floats
        need = need.select("n", "block", F.col("id").alias("node"), F.col("id").alias("u"), F.lit(False).alias("new"), "v", "worst", "blocks")
        rows = member.select("n", "block", "node", "u", "new", F.lit(None).cast("binary").alias("v"), F.lit(0.0).alias("worst"), "blocks").unionByName(need)
        offers = rows.groupBy("n", "block").applyInPandas(_local_join, _EDGE).withColumn("new", F.lit(True))
        before = graph.select("id", "nbr", "d", "n", "blocks", F.expr("new and not drawn").alias("new"))
        after, after_path = save(_nearest(before.unionByName(offers), k, turn + 1), "op4-graph")
        drop(spark, path)
        graph, path = after, after_path
    return graph.select("id", "nbr", "d"), path


_STATE = "q long, w binary, ids array<long>, ds array<double>, done array<boolean>, seen array<long>, front array<long>"


def _advance(beam: int, expand: int):
    """One query's rows: its state, and the nodes to score with their vectors."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        has = rows["v"].notna()
        fresh, state = rows[has], rows[~has].iloc[0]
        q, w = int(state["q"]), state["w"]
        ids, ds, done = (np.asarray(state[c], dtype=t) for c, t in (("ids", np.int64), ("ds", np.float64), ("done", bool)))
        seen = np.asarray(state["seen"], dtype=np.int64)
        if len(fresh):
            node = fresh["node"].to_numpy(dtype=np.int64)
            x = _matrix(fresh["v"]).astype(np.float64) - np.frombuffer(w, dtype=np.float32)
            ids, ds = np.concatenate((ids, node)), np.concatenate((ds, (x * x).sum(1)))
            done, seen = np.concatenate((done, node == q)), np.concatenate((seen, node))
        at = np.lexsort((ids, ds))[:beam]
        ids, ds, done = ids[at], ds[at], done[at].copy()
        front = np.flatnonzero(~done)[:expand]
        done[front] = True
        return pd.DataFrame({"q": [q], "w": [w], "ids": [ids], "ds": [ds], "done": [done], "seen": [seen], "front": [ids[front]]})
    return run


def graph_search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, *, beam: int = BEAM, expand: int = EXPAND,
                 entries: int = ENTRIES, reverse: int = REVERSE) -> DataFrame:
    """`(q, node, d)`: the beam of each of `queries` (`q`: a node's id)."""
    spark = nodes.sparkSession
    prepare(spark)
    adjacent = graph.select("id", "nbr").unionByName(
        _reverse(graph, reverse, "d, id").select(F.col("nbr").alias("id"), F.col("id").alias("nbr")))
    adjacent, adjacent_path = save(adjacent.groupBy("id").agg(F.collect_set("nbr").alias("nbrs")), "op4-adjacent")
    vectors = nodes.select(F.col("id").alias("node"), "v")
    own = queries.join(nodes.select(F.col("id").alias("q"), F.col("v").alias("w")), "q")

    # a fixed number of nodes of each length
    start = nodes.select("id", F.length("v").alias("n")).withColumn("h", F.xxhash64("id", F.lit(11)))
    start = start.withColumn("r", F.expr("row_number() over (partition by n order by h, id)")).where(F.col("r") <= entries)
    start = start.groupBy("n").agg(F.collect_list("id").alias("starts"))
    state = own.withColumn("n", F.length("w")).join(start, "n").join(adjacent, F.col("q") == F.col("id"), "left").select(
        "q", "w", *[F.array().cast(f"array<{t}>").alias(c) for c, t in (("ids", "long"), ("ds", "double"), ("done", "boolean"), ("seen", "long"))],
        F.array_union(F.array_union(F.array("q"), "starts"), F.coalesce("nbrs", F.array().cast("array<long>"))).alias("front"))
    state, path = save(state, "op4-beam")
    first = True
    while first or state.where("size(front) > 0").limit(1).count():
        if first:
            fresh = state.select("q", F.explode("front").alias("node"))
        else:
            reached = state.select("q", F.explode("front").alias("id")).join(adjacent, "id").select("q", "nbrs", F.lit(None).cast("array<long>").alias("seen"))
            reached = reached.unionByName(state.select("q", F.lit(None).cast("array<long>").alias("nbrs"), "seen")).groupBy("q").agg(
                F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs"), F.first("seen", ignorenulls=True).alias("seen"))
            fresh = reached.select("q", F.explode(F.array_except("nbrs", "seen")).alias("node"))
        held = state.drop("front").select("q", F.col("q").alias("node"), F.lit(None).cast("binary").alias("v"), "w", "ids", "ds", "done", "seen")
        rows = fresh.join(vectors, "node").select("q", "node", "v").unionByName(held, allowMissingColumns=True)
        after, after_path = save(rows.groupBy("q").applyInPandas(_advance(beam, expand), _STATE), "op4-beam")
        drop(spark, path)
        state, path, first = after, after_path, False
    drop(spark, adjacent_path)
    return state.select("q", F.explode(F.arrays_zip("ids", "ds")).alias("b")).select("q", F.col("b.ids").alias("node"), F.col("b.ds").alias("d"))


def _beam(state: DataFrame, beam: int) -> DataFrame:
    ranked = state.withColumn("r", F.expr("row_number() over (partition by q order by d, node)"))
    return ranked.where(F.col("r") <= beam).drop("r")


def nearest(vectors: DataFrame, is_query: str = "vec_id % 100 = 0", *, top: int = 10, beam: int = BEAM, **build) -> DataFrame:
    """Per row of `vectors` (`vec_id`, `embedding`) that `is_query` selects,
    its `top` nearest other rows found by Euclidean distance: query_id, rank,
    vec_id, score; ties go to the smaller vec_id.

    Null ids and vectors that are null, empty, zero or hold null or
    non-finite components take no part. Vectors of different lengths have no
    distance: each length is indexed and searched on its own. A repeated row
    counts once, and rows with the query's own id are not its neighbours.
    Other columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = columns(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where(
        usable() & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", "e", F.xxhash64("e").alias("k1"), F.xxhash64("e", F.lit(1)).alias("k2"))
    nodes = rows.groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.first("e").alias("e"))
    to_bytes = F.pandas_udf(lambda s: s.map(lambda v: np.asarray(v, dtype=np.float32).tobytes()), "binary")
    nodes, _ = save(nodes.select("k1", "k2", "id", "e", to_bytes("e").alias("v")), "op4-nodes")
    held = rows.select("vec_id", "k1", "k2").distinct().join(nodes.select("k1", "k2", "id"), ["k1", "k2"]).select("id", "vec_id")
    held, _ = save(held, "op4-held")
    asked = held.where(is_query)
    queries = asked.select(F.col("id").alias("q")).distinct()
    graph, graph_path = build_graph(nodes.select("id", "v"), **build)
    found = graph_search(nodes.select("id", "v"), graph, queries, beam=beam)
    some = held.withColumn("r", F.expr("row_number() over (partition by id order by vec_id)")).where(F.col("r") <= top + 1).drop("r")
    close = _beam(found, top + 2)
    e = nodes.select("id", "e")
    close = close.join(e.withColumnRenamed("e", "x"), F.col("node") == F.col("id")).select("q", "node", "x")
    close = close.join(e.withColumnRenamed("e", "y"), F.col("q") == F.col("id")).select("q", "node", F.sqrt(F.aggregate(
        F.zip_with("x", "y", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)).alias("score"))
    out = (close.join(some.select(F.col("id").alias("node"), "vec_id"), "node")
           .join(asked.select(F.col("id").alias("q"), F.col("vec_id").alias("query_id")).distinct(), "q").where("vec_id <> query_id"))
    out = out.withColumn("rank", F.expr("row_number() over (partition by query_id order by score, vec_id)")).where(F.col("rank") <= top)
    out, _ = save(out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "op4-out")
    drop(spark, graph_path)
    return out
