"""Property tests: cosine symmetry and range, top-k size and order."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cinerank.functions.ranking import top_n
from cinerank.operators.similarity import cosine_pairs

vec = st.lists(st.floats(-5, 5, allow_nan=False, width=32), min_size=3, max_size=3)


@settings(max_examples=5, deadline=None)
@given(st.lists(vec, min_size=2, max_size=25))
def test_cosine_symmetric_and_bounded(spark, vecs):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "mid bigint, features array<double>")
    got = {(a, b): s for a, b, s in cosine_pairs(df, threshold=-1.0, block_rows=4).collect()}
    for (a, b), s in got.items():
        assert (b, a) in got and got[(b, a)] == s
        assert -1.0 - 1e-6 <= s <= 1.0 + 1e-6
    norms = [np.linalg.norm(v) for v in vecs]
    live = [i for i, n in enumerate(norms) if n > 0]
    assert len(got) == len(live) * (len(live) - 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_top_n_size_and_order(spark, rows, k):
    df = spark.createDataFrame(rows, "g int, id int, v int")
    out = top_n(df, ["g"], [F.desc("v"), F.asc("id")], k).collect()
    by = {}
    for r in out:
        by.setdefault(r.g, []).append(r)
    for g, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert len(rs) <= k
        want = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:k]
        assert [(r.id, r.v) for r in rs] == [(i, v) for _, i, v in want]


def _brute(vecs, threshold):
    x = np.array(vecs)
    n = np.linalg.norm(x, axis=1)
    return {(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and n[i] and n[j] and x[i] @ x[j] / (n[i] * n[j]) >= threshold}


def test_blocks_that_cannot_reach_the_threshold_never_meet(spark):
    from cinerank.operators.similarity import block_plan
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 6))
    near = [(centres[i % 8] + rng.normal(0, 0.05, 6)).tolist() for i in range(200)] + [[0.0] * 6]
    far = rng.normal(size=(120, 6)).tolist()
    for vecs, threshold in ((near, 0.9), (near, -0.2), (far, 0.3), (far, 0.6)):
        df = spark.createDataFrame(list(enumerate(vecs)), "mid bigint, features array<double>")
        got = {(r.mid, r.rec_mid) for r in cosine_pairs(df, threshold=threshold, block_rows=16).collect()}
        assert got == _brute(vecs, threshold)
    plan = block_plan(spark.createDataFrame(list(enumerate(near)), "id bigint, vec array<double>"), 0.9, 16)
    pairs = plan.n_blocks * (plan.n_blocks + 1) // 2
    assert plan.n_blocks >= 12 and plan.skipped() > 0.5 * pairs
    assert plan.vectors.groupBy("block").count().agg({"count": "max"}).first()[0] <= 16


def test_top_k_skips_blocks_of_small_norm(spark):
    from cinerank.operators.similarity import blocks_ahead, top_k_inner_product
    rng = np.random.default_rng(9)
    uv = rng.normal(size=(40, 4))
    iv = rng.normal(size=(300, 4)) * np.exp(-np.arange(300) / 25)[:, None]
    uv[3] = 0
    users = spark.createDataFrame([(i, uv[i].tolist()) for i in range(40)], "id bigint, features array<double>")
    items = spark.createDataFrame([(1000 + j, iv[j].tolist()) for j in range(300)], "id bigint, features array<double>")
    for positive in (True, False):
        got = sorted((r.id, r["rank"], r.other) for r in top_k_inner_product(users, items, 5, block_rows=16, positive_only=positive).collect())
        want = []
        for i in range(40):
            scores = sorted((-float(uv[i] @ iv[j]), 1000 + j) for j in range(300) if not positive or uv[i] @ iv[j] > 0)[:5]
            want += [(i, r + 1, m) for r, (_, m) in enumerate(scores)]
        assert got == want
    norms = np.sort(np.linalg.norm(iv, axis=1))[::-1]
    asked = spark.createDataFrame([(i, float(np.linalg.norm(uv[i])), float(np.sort(iv @ uv[i])[-5])) for i in range(40) if i != 3],
                                  "id bigint, norm double, kth double")
    last = [r["last"] for r in blocks_ahead(asked, norms[::16].tolist(), 1, len(norms[::16])).collect()]
    assert max(last) < len(norms[::16]) - 1 and sum(last) < 0.5 * len(last) * len(norms[::16])
