"""Operator 2: near copies among embeddings by an exact metric range join.

Unit vectors with cosine >= c lie within eps = sqrt(2 - 2c). Pivots (rows in
the order of a hash; at most MAX_PIVOTS) partition the vectors: each belongs
to the cell of its nearest pivot. By the triangle inequality a vector x of
cell i can reach one of cell j only if x is within eps of the plane halfway
between both pivots,

    d(x, p_j)^2 - d(x, p_i)^2 <= 2 eps d(p_i, p_j);

then x is also sent to cell j (to j > i, which finds each pair once). Cells
join on their own, within a label; pairs are confirmed by their cosine in
double precision. Where vectors are so spread that pivots hardly separate
them, copies would outnumber what they save: the number of pivots is the
largest that sends, in a sample of SAMPLE vectors, each to at most
MAX_COPIES cells. It changes the plan, never the links.

Equal vectors collapse before the join. Cells are cut into blocks of about
BLOCK rows and joined block by block, so a large cell is spread over many
tasks and a task holds two blocks. A task returns, for each vector, how many
it links with, and links that span its groups, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, connected_components, prepare, save

COSINE = 0.98
MAX_PIVOTS = 256
MAX_COPIES = 6
SAMPLE = 512
BLOCK = 1000
_SLACK = 1e-9     # for rounding, in distances


def usable(embedding: str = "embedding") -> F.Column:
    """Not null, not empty, every component finite, not all zero."""
    e = F.col(embedding).cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(e, lambda x: x != 0) & (F.size(e) > 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(x: np.ndarray, pivots: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which cells it must be sent to."""
    d2 = np.maximum(0, 2 - 2 * (x @ pivots.T))
    home = d2.argmin(1)
    between = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))
    send = d2 - d2[np.arange(len(x)), home][:, None] <= 2 * eps * between[home] + _SLACK
    send &= np.arange(len(pivots)) > home[:, None]
    return home, send


def _choose(vectors: list, eps: float, max_pivots: int, max_copies: int) -> np.ndarray:
    x = _unit(vectors)
    n = min(max_pivots, max(1, len(x) // 2))
    while n > 1:
        _, send = _cells(x, x[:n], eps)
        if send.sum(1).mean() <= max_copies:
            break
        n //= 2
    return x[:n]


def _span(adjacent: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Links that join each group of linked rows to its first row."""
    links, left = [], np.ones(len(ids), dtype=bool)
    left[~adjacent.any(1)] = False
    while left.any():
        first = int(left.argmax())
        left[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(adjacent[front].any(0) & left)
            left[front] = False
            links += [(int(ids[first]), int(ids[k])) for k in front]
    return links


def _join_blocks(cosine: float):
    def run(task: pd.DataFrame) -> pd.DataFrame:
        task = task.sort_values(["vec_id", "home"], kind="stable")
        x, ids, m = _unit(task["embedding"]), task["vec_id"].to_numpy(), task["m"].to_numpy()
        c = x @ x.T
        close = np.abs(c - cosine) < 1e-9          # too near to the threshold for normalised products
        if close.any():
            raw = np.array([np.asarray(v, dtype=np.float64) for v in task["embedding"]])
            size = np.linalg.norm(raw, axis=1)
            for i, j in zip(*np.nonzero(close), strict=True):
                c[i, j] = raw[i] @ raw[j] / (size[i] * size[j])
        block, home = task["block"].to_numpy(), task["home"].to_numpy()
        ok = (c >= cosine) & (home[:, None] | home)       # some pair of sent copies meets where one is at home
        if task["lo"].iloc[0] != task["hi"].iloc[0]:
            ok &= block[:, None] != block                 # pairs of one block are that block's own task
        np.fill_diagonal(ok, False)
        counts = ok @ m
        some = counts > 0
        links = _span(ok, ids) if some.any() else []
        return pd.DataFrame({"u": [*ids[some], *(a for a, _ in links)],
                             "v": pd.array([*[None] * int(some.sum()), *(b for _, b in links)], dtype="Int64"),
                             "n": [*counts[some], *[0] * len(links)]}).astype({"u": "int64", "n": "int64"})
    return run


def near_copies(vectors: DataFrame, *, cosine: float = COSINE, max_pivots: int = MAX_PIVOTS, max_copies: int = MAX_COPIES,
                block: int = BLOCK) -> DataFrame:
    """Per row of `vectors` (`vec_id`, `embedding`, `label`): vec_id,
    n_links, component_id, kept.

    n_links counts the other rows of the same label with a cosine of at
    least `cosine`. Vectors that are null, empty, zero or hold null or
    non-finite components, null labels and null ids link with nothing;
    vectors of different lengths never link. Repeated rows are rows of their
    own that link with each other. Other columns are ignored; no rows give
    no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = columns(vectors, "vec_id", "embedding", "label").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    good = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(good, F.xxhash64("label", "embedding")).alias("k1"),
                       F.when(good, F.xxhash64("embedding", "label", F.lit(1))).alias("k2"), "label", "embedding")
    reps, _ = save(rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("m"), F.first("embedding").alias("embedding"),
        F.concat_ws("/", F.xxhash64(F.first("label")).cast("string"), F.size(F.first("embedding")).cast("string")).alias("label")), "op2-reps")
    sample = reps.select("embedding", F.size("embedding").alias("n")).orderBy(F.xxhash64("embedding")).limit(SAMPLE).collect()
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + _SLACK
    pivots = {}
    for n in {r["n"] for r in sample}:
        pivots[n] = _choose([r["embedding"] for r in sample if r["n"] == n], eps, max_pivots, max_copies)
    held = spark.sparkContext.broadcast(pivots)

    def send(frames):
        for f in frames:
            for n, part in f.groupby(f["embedding"].map(len)):
                p = held.value.get(n)
                home, to = (np.zeros(len(part), dtype=int), np.zeros((len(part), 1), bool)) if p is None else _cells(
                    _unit(part["embedding"]), p, eps)
                for cell in range(to.shape[1]):
                    there = (home == cell) | to[:, cell]
                    if there.any():
                        yield part[there].assign(cell=cell, home=home[there] == cell)[["vec_id", "m", "embedding", "label", "cell", "home"]]

    kind = reps.schema["embedding"].dataType.simpleString()
    cells, _ = save(reps.select("vec_id", "m", "embedding", "label").mapInPandas(
        send, f"vec_id long, m long, embedding {kind}, label string, cell int, home boolean"), "op2-cells")
    blocks = cells.groupBy("label", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = cells.join(blocks, ["label", "cell"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("vec_id", "m", "embedding", "label", "cell", "home", "block",
                         F.least("block", "k").alias("lo"), F.greatest("block", "k").alias("hi"))
    found, _ = save(dealt.groupBy("label", "cell", "lo", "hi").applyInPandas(_join_blocks(cosine), "u long, v long, n long"), "op2-found")
    counts = found.where("v is null").groupBy(F.col("u").alias("i")).agg(F.sum("n").alias("n"))
    top = connected_components(found.where("v is not null"), "u", "v").withColumnRenamed("id", "j")
    labels = reps.select("k1", "k2", "vec_id", "m").join(counts, F.col("vec_id") == F.col("i"), "left").join(
        top, F.col("vec_id") == F.col("j"), "left").select(
        "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    labels, _ = save(labels, "op2-labels")
    out = rows.select("vec_id", "k1", "k2").join(labels, ["k1", "k2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
