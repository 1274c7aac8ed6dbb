import random

import numpy as np

from cinerank.llm.jaccard_join import _apart, _parity, divide_skip, jaccard_join
from tests.conftest import SF_MID
from tests.llm.brute import jaccard_components


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = jaccard_components({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    assert result(jaccard_join(docs)) == want
    assert sum(c != i for i, (_, c) in want.items()) > 20


def test_near_copies_chains_and_hot_group(spark):
    rng = random.Random(5)
    word = [f"w{i}" for i in range(4000)]
    base = [rng.choice(word) for _ in range(120)]
    texts = []
    for k in range(150):  # near copies at all distances
        t = list(base)
        for _ in range(rng.randrange(0, 9)):
            t[rng.randrange(len(t))] = rng.choice(word)
        texts.append(" ".join(t))
    texts += [texts[3]] * 40                                   # exact copies
    shared = " ".join(rng.choice(word) for _ in range(60))     # a passage many texts share
    texts += [shared + " " + " ".join(rng.choice(word) for _ in range(rng.randrange(5, 90))) for _ in range(150)]
    texts += [shared, shared + " tail", "a b", "A B", "a  b\t", "one", None, "", " \n ", "a b c d", "x " * 5000, "X " * 300]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard_join(df)) == jaccard_components(dict(rows))


def test_empty_null_ids_repeats_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join(empty).collect() == []
    df = spark.createDataFrame(
        [(1, "a b c d e", 9, 1), (1, "a b c d e", 9, 1), (2, "A b c d e", 9, 2), (None, "a b c d e", 9, 3), (4, None, None, 4)],
        "doc_id long, text string, component_id long, n int")
    got = sorted((tuple(r) for r in jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (4, 0, 4)], key=str)


def test_divide_skip_keeps_exactly_the_overlaps():
    rng = np.random.default_rng(1)
    for _ in range(40):
        q = np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64))
        sets = []
        for _ in range(12):
            s = q[rng.random(len(q)) < rng.uniform(0.7, 1)]
            sets.append(np.unique(np.concatenate((s, rng.integers(0, 3000, rng.integers(1, 30)).astype(np.uint64)))))
        got = divide_skip(q, sets, 85)
        assert got.tolist() == [100 * len(np.intersect1d(q, s)) >= 85 * len(np.union1d(q, s)) for s in sets]


def test_parity_never_overstates_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 62, rng.integers(1, 300)).astype(np.uint64))))
        assert _apart(_parity(a), _parity(b)) <= len(np.setxor1d(a, b))
    assert _apart(_parity(a), _parity(a)) == 0
