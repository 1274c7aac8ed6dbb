import numpy as np
import pandas as pd
import pytest

from cinerank.llm import ann
from cinerank.llm.ann import nearest
from tests.conftest import SF_MID


def brute(rows, top=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([e for _, e in rows], dtype=np.float64)
    out = {}
    for q in sorted({int(i) for i in ids if i % 100 == 0}):
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        best = sorted((float(s), int(i)) for s, i in zip(d, ids, strict=True) if i != q)[:top]
        out[q] = [(k, i, s) for k, (s, i) in enumerate(best, 1)]
    return out


def got(df, **how):
    out = {}
    for r in nearest(df, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall(have, want):
    return np.mean([len({i for _, i, _ in have[q]} & {i for _, i, _ in want[q]}) / len(want[q]) for q in want])


def test_whole_table_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    have = got(df)
    assert set(have) == set(want) and recall(have, want) >= 0.99
    for q in want:
        assert [r for r, _, _ in have[q]] == list(range(1, 11))
        assert [s for _, _, s in have[q]] == pytest.approx([s for _, _, s in want[q]], abs=1e-9)


def test_recall_where_the_beam_is_small_against_the_table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    x[500:900] = x[0] + rng.normal(size=(400, 24)).astype(np.float32) * 0.01   # a large tight group
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    assert recall(got(df, beam=150), brute(rows)) >= 0.9


def test_ties_copies_and_awkward_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, float(i % 3)]) for i in range(0, 60)] + [(100, [1.0, 1.0]), (200, [0.5, 0.5])]
    bad = [(300, None), (400, [nan, 1.0]), (500, [0.0, 0.0]), (600, [None, 1.0]), (None, [1.0, 1.0]), (700, [1.0, 2.0, 3.0]), (800, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<float>, rank int")
    have, want = got(df), brute(rows)
    assert {q: [(r, i, round(s, 12)) for r, i, s in v] for q, v in have.items()} == {q: [(r, i, round(s, 12)) for r, i, s in v] for q, v in want.items()}
    assert got(spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")).keys() == {0}
    assert len(got(spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>"))[0]) == 3
    assert got(spark.createDataFrame([], "vec_id long, embedding array<float>")) == {}


def test_every_length_is_indexed_and_searched(spark):
    rng = np.random.default_rng(5)
    by_length = {}
    for i in range(900):
        by_length.setdefault((2, 3, 16)[i // 10 % 3], []).append(i)
    rows = [(i, [float(v) for v in rng.normal(size=n) + 5]) for n, ids in by_length.items() for i in ids]
    have = got(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), leaf=40, k=8, beam=64)
    want = {}
    for n, ids in by_length.items():
        want |= brute([(i, np.float32(e).tolist()) for i, e in rows if i in set(ids)])
    assert set(have) == set(want) == {i for i in range(900) if i % 100 == 0}
    assert recall(have, want) >= 0.9


def test_a_round_copies_a_vector_to_few_of_many_blocks(spark, monkeypatch):
    def tell(block):
        """An edge to no node for each vector that a block got."""
        import numpy as np
        import pandas as pd
        u = block[block["v"].notna()]["u"].to_numpy()
        at = -1 - int(block["block"].iat[0])
        return pd.DataFrame({"id": u, "nbr": np.full(len(u), at), "d": np.full(len(u), -1.0), "n": np.int32(8), "blocks": np.int32(100)})

    monkeypatch.setattr(ann, "_local_join", tell)
    monkeypatch.setattr(ann, "BLOCK", 4)
    rng = np.random.default_rng(8)
    rows = [(i, bytearray(rng.normal(size=8).astype(np.float32).tobytes())) for i in range(400)]
    nodes = spark.createDataFrame(rows, "id long, v binary")
    graph, _ = ann.build_graph(nodes, k=100, rounds=1)
    copies = graph.where("nbr < 0")
    assert copies.select("id").distinct().count() == 400 and copies.count() <= 400 * 12


def test_rounds_do_not_depend_on_the_order_of_a_blocks_rows(spark, monkeypatch):
    """Rows of a group come in any order: vectors may be before memberships."""
    join = ann._local_join

    def vectors_first(block):
        first = block["v"].notna()
        return join(pd.concat([block[first], block[~first]], ignore_index=True))

    monkeypatch.setattr(ann, "_local_join", vectors_first)
    monkeypatch.setattr(ann, "BLOCK", 40)
    rng = np.random.default_rng(8)
    x, far = rng.normal(size=(400, 8)).astype(np.float32), 2 ** 60      # ids that no double holds
    nodes = spark.createDataFrame([(far + i, bytearray(e.tobytes())) for i, e in enumerate(x)], "id long, v binary").repartition(4)
    seen = []

    def nearest(edges, k, turn, real=ann._nearest):
        seen.append([r["blocks"] for r in edges.select("blocks").distinct().collect()])
        return real(edges, k, turn)

    monkeypatch.setattr(ann, "_nearest", nearest)
    graph, _ = ann.build_graph(nodes, k=5, leaf=60, trees=2)
    assert seen == [[10]] * 3       # 400 nodes in blocks of 40, whatever came first
    d = ((x[:, None].astype(np.float64) - x) ** 2).sum(-1)
    for r in graph.limit(200).collect():
        assert r["d"] == pytest.approx(d[r["id"] - far, r["nbr"] - far], abs=1e-3)
