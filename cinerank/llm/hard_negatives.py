"""Operator 13: hard negatives by a threshold join over inverted lists.

Components become integers, floor(256 x); a score is the integer inner
product with the anchor. Rows lie in blocks of about BLOCK, anchors in blocks
of ANCHORS; each (anchor block, row block) is one task, which keeps inverted
lists of its rows in the manner of L2AP: with components in one fixed order,
an entry of component d is filed under the norm of its row's components up
to d, largest first. For a threshold t and an anchor whose components up to d
have norm q, entries under less than t / q need not be read: by
Cauchy-Schwarz what the row has up to there adds less than t. So a scan reads
the head of each list, last component first, adds up partial scores, drops
the rows that can't reach t with the norms that remain, and scores the rest
exactly. Then t is lowered, which only lengthens the heads, until the windows
asked for are full or nothing lies below. At t <= 0 every row is scored.
TOGETHER anchors, each with its own t, read the lists at once, as far as any
of them needs.

First each anchor's positives are found, then, in the windows
[LOW %, HIGH %] below their scores, the negatives. A block returns no more
than what can stand in a window; windows over all blocks are ranked by Spark.

Nulls: rows with a null id, label or vector or with a null or non-finite
component take no part. Rows equal in id, label and vector count once; an
anchor never meets rows of its own id. A vector shorter than its anchor's has
zeros for what it lacks; an empty one scores 0. A positive score below zero
has no window; at zero the window holds scores of zero. An empty table or one
without anchors gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.ranking import top_n
from cinerank.llm.common import columns, drop, prepare, save

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
SCALE = 256
BLOCK = 4096
ANCHORS = 2048
TOGETHER = 64      # anchors that read the lists together
_SLACK = 1e-9      # of a bound, for rounding of norms


def integer_rows(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): the rows that take part, v of integers."""
    e = F.col("embedding").cast("array<double>")
    fine = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = columns(embeddings, "vec_id", "embedding", "label")
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x).cast("double")).alias("v")).distinct()


class Lists:
    """The inverted lists of some rows."""

    def __init__(self, v: np.ndarray):
        self.order = np.lexsort(((v * v).sum(0), -(v != 0).sum(0)))   # long lists first: they are omitted first
        self.v = v[:, self.order]
        self.norms = np.sqrt(np.cumsum(self.v * self.v, axis=1))
        self.lists = []
        for d in range(v.shape[1]):
            rows = np.flatnonzero(self.v[:, d])
            rows = rows[np.argsort(-self.norms[rows, d], kind="stable")]
            self.lists.append((rows, self.v[rows, d], -self.norms[rows, d]))

    def scan(self, x: np.ndarray) -> Callable[[float], tuple[np.ndarray, np.ndarray]]:
        """For one anchor: a function of a threshold, which may only fall, to
        all rows that score it or more, with their scores."""
        reach = self.scan_all(x[None, :])
        return lambda t: reach([t], np.zeros(1, dtype=np.int64))[0]

    def scan_all(self, x: np.ndarray) -> Callable[[list[float], np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """The same for the anchors `x`, read together: a function of the
        thresholds of some of them, and their places, which may only become
        fewer. A list is read as far as any of them needs it."""
        x = x[:, self.order]
        norms = np.sqrt(np.cumsum(x * x, axis=1))
        n, width = self.v.shape
        partial = np.zeros((n, len(x)))
        done = [0] * width
        # the first component read of a row; the norm of those before it, for 0 none
        first = np.full(n, width, dtype=np.int64)
        before = np.concatenate((np.zeros((n, 1)), self.norms), axis=1)
        anchor_before = np.concatenate((np.zeros((len(x), 1)), norms), axis=1)

        def reach(thresholds: list[float], which: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            t = np.asarray(thresholds, dtype=np.float64)
            out: list = [None] * len(t)
            for j in np.flatnonzero((t <= 0) | (width == 0)):
                s = self.v @ x[which[j]]
                rows = np.flatnonzero(s >= t[j])
                out[j] = (rows, s[rows])
            above = np.flatnonzero((t > 0) & (width > 0))
            if not len(above):
                return out
            at, need = which[above], t[above] * (1 - _SLACK)
            some = len(at) < len(x)
            for d in range(width - 1, -1, -1):
                most = float((norms[at, d] / need).max())
                if most == 0:
                    break
                rows, values, under = self.lists[d]
                head = int(np.searchsorted(under, -1 / most * (1 - _SLACK), side="right"))
                if head > done[d]:
                    new, values = rows[done[d]:head], values[done[d]:head]
                    if some:
                        partial[np.ix_(new, which)] += values[:, None] * x[which, d]
                    else:
                        partial[new] += values[:, None] * x[:, d]
                    done[d] = head
                    first[new] = np.minimum(first[new], d)
            # what is left out of a row are its first components, up to where its norm is too small
            rest = before[np.arange(n), first][:, None] * anchor_before[at].T[first]
            rest += partial[:, at] if some else partial
            row, place = np.nonzero(rest >= need)
            order = np.argsort(place, kind="stable")
            row, place = row[order], place[order]
            s = np.empty(len(row))
            for lo in range(0, len(row), 65536):
                part = slice(lo, lo + 65536)
                s[part] = np.einsum("ij,ij->i", self.v[row[part]], x[at[place[part]]])
            hit = s >= t[above][place]
            row, place, s = row[hit], place[hit], s[hit]
            ends = np.searchsorted(place, np.arange(len(at) + 1))
            for k, j in enumerate(above):
                out[j] = (row[ends[k]:ends[k + 1]], s[ends[k]:ends[k + 1]])
            return out
        return reach


def _matrix(vectors, width: int) -> np.ndarray:
    m = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        m[k, :len(v)] = v
    return m


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, pd.DataFrame, np.ndarray]:
    a, r = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    width = max([0, *(len(v) for v in pdf["v"])])
    return a, _matrix(a["v"].to_list(), width), r, _matrix(r["v"].to_list(), width)


def _best(usable: np.ndarray, ids: np.ndarray, k: int, start: float):
    """Asks for thresholds, is sent what reaches them, returns the k best."""
    t = start
    while True:
        rows, s = yield t
        keep = usable[rows]
        rows, s = rows[keep], s[keep]
        if len(rows) >= k or t == -math.inf:
            first = np.lexsort((ids[rows], -s))[:k]
            return list(zip(ids[rows[first]].tolist(), s[first].tolist()))
        t = t * 0.75 if t > 1 else -math.inf


def _windows(usable: np.ndarray, ids: np.ndarray, tops: list[float], k: int, low: int, high: int):
    """As `_best`: returns the first k rows of each window."""
    floors = [math.ceil(low * p / high) for p in tops]
    live = [i for i, p in enumerate(tops) if floors[i] <= p]
    out: list[list[tuple[int, float]]] = [[] for _ in tops]
    t = max([tops[i] for i in live], default=0.0)
    while live:
        t = max(t * 0.9, min(floors[i] for i in live))
        rows, s = yield t
        keep = usable[rows]
        rows, s = rows[keep], s[keep]
        order = np.lexsort((ids[rows], -s))
        rows, s = rows[order], s[order]
        waiting = []
        for i in live:
            into = np.flatnonzero((s <= tops[i]) & (s >= floors[i]))[:k]
            if len(into) >= k or t <= floors[i]:
                out[i] = list(zip(ids[rows[into]].tolist(), s[into].tolist()))
            else:
                waiting.append(i)
        live = waiting
    return out


def _ask(reach, searches: list) -> list:
    """What the searches return; all of them go down together."""
    out: list = [None] * len(searches)
    asked: dict[int, float] = {}
    answers: dict[int, object] = dict.fromkeys(range(len(searches)))
    while answers:
        asked = {}
        for j, answer in answers.items():
            try:
                asked[j] = searches[j].send(answer)
            except StopIteration as end:
                out[j] = end.value
        answers = dict(zip(asked, reach(list(asked.values()), np.fromiter(asked, np.int64)))) if asked else {}
    return out


def best(reach, usable: np.ndarray, ids: np.ndarray, k: int, start: float) -> list[tuple[int, float]]:
    """The k usable rows of the highest scores, ties by id; all if fewer."""
    return _ask(lambda t, _: [reach(t[0])], [_best(usable, ids, k, start)])[0]


def windows(reach, usable: np.ndarray, ids: np.ndarray, tops: list[float], k: int,
            low: int = LOW, high: int = HIGH) -> list[list[tuple[int, float]]]:
    """For each of the scores `tops`, the first k usable rows of its window."""
    return _ask(lambda t, _: [reach(t[0])], [_windows(usable, ids, tops, k, low, high)])[0]


def _positives(k: int):
    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        a, x, r, v = _sides(pdf)
        ids, labels, out = r["vec_id"].to_numpy(), r["label"].to_numpy(), []
        keys, anchor_ids, anchor_labels = a["a_key"].to_numpy(), a["vec_id"].to_numpy(), a["label"].to_numpy()
        for label in np.unique(anchor_labels):
            at = np.flatnonzero(labels == label)
            if not len(at):
                continue
            lists, own = Lists(v[at]), ids[at]
            longest = float(lists.norms[:, -1].max()) if v.shape[1] else 0.0
            mine = np.flatnonzero(anchor_labels == label)
            for lo in range(0, len(mine), TOGETHER):
                js = mine[lo:lo + TOGETHER]
                searches = [_best(own != anchor_ids[j], own, k, 0.9 * longest * float(np.linalg.norm(x[j]))) for j in js]
                for j, found in zip(js, _ask(lists.scan_all(x[js]), searches)):
                    out += [(keys[j], i, s) for i, s in found]
        return pd.DataFrame(out, columns=["a_key", "vec_id", "score"])
    return task


def _negatives(k: int, low: int, high: int):
    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        a, x, r, v = _sides(pdf)
        ids, labels, out = r["vec_id"].to_numpy(), r["label"].to_numpy(), []
        keys, anchor_ids, anchor_labels, tops = a["a_key"].to_numpy(), a["vec_id"].to_numpy(), a["label"].to_numpy(), a["tops"].to_list()
        if len(a) and len(r):
            lists = Lists(v)
            for lo in range(0, len(a), TOGETHER):
                js = range(lo, min(lo + TOGETHER, len(a)))
                searches = [_windows((labels != anchor_labels[j]) & (ids != anchor_ids[j]), ids, [float(p) for p in tops[j]], k, low, high) for j in js]
                for j, lot in zip(js, _ask(lists.scan_all(x[lo:lo + TOGETHER]), searches)):
                    out += [(keys[j], w + 1, i, s) for w, found in enumerate(lot) for i, s in found]
        return pd.DataFrame(out, columns=["a_key", "p_rank", "vec_id", "score"])
    return task


def _meet(anchors: DataFrame, rows: DataFrame, na: int, nb: int) -> DataFrame:
    """Anchors and rows, each copied to the blocks of the other side."""
    a = anchors.select("a_key", "vec_id", "label", "v", "tops", F.lit(0).alias("side"),
                       F.pmod(F.xxhash64("a_key"), F.lit(na)).alias("ab"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("rb"))
    r = rows.select(F.lit(None).cast("bigint").alias("a_key"), "vec_id", "label", "v", F.lit(None).cast("array<bigint>").alias("tops"),
                    F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(na - 1).cast("bigint"))).alias("ab"),
                    F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(nb)).cast("int").alias("rb"))
    return a.unionByName(r).groupBy("ab", "rb")


def hard_negatives(embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, relabel: F.Column | None = None,
                   block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score); `relabel`, of vec_id and label, replaces the labels."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = integer_rows(embeddings)
    if relabel is not None:
        rows = rows.withColumn("label", relabel)
    rows, rpath = save(rows, "op13-rows")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).withColumn("a_key", F.monotonically_increasing_id())
    anchors, apath = save(anchors, "op13-anchors")
    nb, na = max(1, -(-rows.count() // block)), max(1, -(-anchors.count() // anchor_block))

    found = _meet(anchors.withColumn("tops", F.lit(None).cast("array<bigint>")), rows, na, nb).applyInPandas(
        _positives(positives), "a_key bigint, vec_id bigint, score double")
    found = top_n(found, ["a_key"], [F.desc("score"), F.asc("vec_id")], positives, "p_rank")
    found, fpath = save(found.select("a_key", "p_rank", F.col("vec_id").alias("positive_id"),
                                 F.col("score").cast("bigint").alias("positive_score")), "op13-positives")
    tops = found.groupBy("a_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_rank", "positive_score"))),
                                                  lambda p: p["positive_score"]).alias("tops"))
    near = _meet(anchors.join(tops, "a_key"), rows, na, nb).applyInPandas(
        _negatives(negatives, low, high), "a_key bigint, p_rank int, vec_id bigint, score double")
    near = top_n(near, ["a_key", "p_rank"], [F.desc("score"), F.asc("vec_id")], negatives)
    out = near.join(found, ["a_key", "p_rank"]).join(anchors.select("a_key", F.col("vec_id").alias("anchor_id")), "a_key")
    out, _ = save(out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                             "positive_score", F.col("score").cast("bigint").alias("negative_score")), "op13-out")
    drop(spark, rpath, apath, fpath)
    return out
