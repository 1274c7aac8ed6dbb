"""Skewed inputs: one user holds a third of all ratings and events, one item
a third of all requests. Results must equal a brute-force evaluation of the
original per-event algorithm."""

import math
import random

from cinerank.operators import realtime


def _brute(events, sim_rows, ratings, k=20, n=20):
    sim = {}
    for a, b, s in sim_rows:
        sim.setdefault(a, {})[b] = s
    by_user = {}
    for u, m, s, t in ratings:
        by_user.setdefault(u, []).append((m, s, t))
    latest = {}
    for u, m, s, t, e in events:
        if u not in latest or (t, e) > latest[u][1]:
            latest[u] = (m, (t, e))
    out = {}
    for u, (m, _) in latest.items():
        rated = {x[0] for x in by_user.get(u, [])}
        partners = sorted(((-s, b) for b, s in sim.get(m, {}).items() if b not in rated))[:n]
        recents = sorted(by_user.get(u, []), key=lambda x: (-x[2], x[0], -x[1]))[:k]
        scores = {}
        for _, q in partners:
            vals, inc, dec = [], 0, 0
            for rm, rs, _ in recents:
                s = sim.get(q, {}).get(rm, 0.0)
                if s >= 0.7:
                    vals.append(s * rs)
                    inc += rs > 3
                    dec += rs <= 3
            if vals:
                scores[q] = round(sum(vals) / len(vals) + math.log10(max(inc, 1)) - math.log10(max(dec, 1)), 6)
        out[u] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
    return out


def test_hot_user_and_hot_item(spark):
    rnd = random.Random(11)
    items = list(range(60))
    sim_rows = []
    for a in items:
        for b in items:
            if a != b and rnd.random() < 0.5:
                s = round(0.6 + 0.4 * rnd.random(), 3)
                sim_rows.append((a, b, s))
    ratings = []
    for u in range(30):
        cnt = 300 if u == 0 else rnd.randrange(1, 12)  # user 0 holds about a third
        for _ in range(cnt):
            ratings.append((u, rnd.choice(items), float(rnd.randrange(1, 11)) / 2, rnd.randrange(1000)))
    events = []
    for e in range(400):
        u = 0 if e % 3 == 0 else rnd.randrange(30)
        m = 7 if e % 3 == 1 else rnd.choice(items)  # item 7 gets a third of the requests
        events.append((u, m, 3.0, rnd.randrange(2000), e))
    sim = spark.createDataFrame(sim_rows, "mid bigint, rec_mid bigint, score double")
    r = spark.createDataFrame(ratings, "uid bigint, mid bigint, score double, ts bigint")
    ev = spark.createDataFrame(events, "uid bigint, mid bigint, score double, ts bigint, event_id bigint")
    got = {}
    for row in realtime.stream_recs(ev, sim, r).collect():
        got.setdefault(row.uid, [])
        if row.mid is not None:
            got[row.uid].append((row["rank"], row.mid, row.score))
    want = _brute(events, sim_rows, ratings)
    assert set(got) == set(want)
    for u in want:
        assert [(m, s) for _, m, s in sorted(got[u])] == want[u], u


def test_skew_join_splits_both_sides(spark):
    from pyspark.sql import functions as F

    from cinerank.operators.skew import skew_join
    left = spark.range(600).selectExpr("if(id < 300, 7, id) AS k", "id AS a")
    right = spark.range(400).selectExpr("if(id < 90, 7, id + 250) AS k", "id AS b")
    plain = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    for how in ({}, {"right_hot": False}):
        j = skew_join(left, right, "k", split_rows=30, **how)
        assert j.columns == ["k", "a", "b"]
        assert sorted(map(tuple, j.collect())) == plain
    # the cells of the hot key: 10 x 3, none of them more than a small part of its 27,000 pairs
    grid = skew_join(left, right.withColumn("_p", F.lit(0)), "k", split_rows=30)
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert "_lparts" in plan and "_rparts" in plan
    sizes = {}
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        for r in grid.groupBy(F.spark_partition_id().alias("p")).count().collect():
            sizes[r.p] = r["count"]
    finally:
        spark.conf.set(key, "true")
    assert max(sizes.values()) < 0.5 * len(plain)


def test_a_third_of_the_requests_on_one_item(spark):
    from pyspark.sql import functions as F

    from cinerank.operators.simindex import PairSim
    sim = PairSim(spark.range(900).selectExpr("id % 30 AS mid", "id AS rec_mid", "1 - id / 2000D AS score"), split_rows=50)
    req = spark.range(1500).selectExpr("id AS uid", "if(id % 3 = 0, 7, id % 30) AS mid")
    rated = spark.range(1500).selectExpr("id AS uid", "id % 900 AS mid")
    got = realtime.candidate_movies(req, sim, rated)
    wide = PairSim(sim.table)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, realtime.candidate_movies(req, wide, rated).collect()))
    assert got.groupBy("uid", "mid").agg(F.max("rank").alias("n")).agg(F.min("n")).first()[0] == 20


def test_expansion_of_profiles_is_dealt_out_by_its_pairs(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cinerank.operators import simindex
    monkeypatch.setattr(simindex, "CHUNK", 16, raising=False)
    monkeypatch.setattr(simindex, "TASK_PAIRS", 4000, raising=False)
    # one profile holds half of the items; a null id, an id twice and one in two profiles
    members = [(i, "hot" if i % 2 else f"p{i % 6}") for i in range(200)] + [(None, "hot"), (7, "hot"), (7, "p0")]
    linked = {("hot", "hot"): 1.0, ("p0", "p0"): 1.0, ("p2", "p2"): 1.0, ("hot", "p0"): 0.8, ("p0", "hot"): 0.8, ("p2", "gone"): 0.7}
    sim = simindex.ProfileSim(spark.createDataFrame(members, "mid bigint, pkey string").coalesce(1),
                              spark.createDataFrame([(a, b, s, s) for (a, b), s in linked.items()], "pa string, pb string, sim double, score double").coalesce(1))
    pairs = sim.pairs()
    want = sorted((a, b, linked[p, q]) for a, p in members for b, q in members
                  if (p, q) in linked and a is not None and b is not None and a != b)
    assert pairs.columns == ["mid", "rec_mid", "score"] and sorted(map(tuple, pairs.collect())) == want
    # a few kilobytes of input, but no task makes most of the pairs
    sizes = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * len(want)
    none = simindex.ProfileSim(sim.members.where("mid < 0"), sim.profile_pairs)
    assert none.pairs().collect() == []


def test_sides_without_hot_keys_keep_their_sizes(spark):
    """An empty table of hot keys must not make a large side seem empty."""
    from pyspark.sql import functions as F

    from cinerank.operators.skew import skew_join
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "200000")
    try:
        left = spark.range(40_000).selectExpr("id % 20000 AS k", "uuid() AS a").groupBy("k").agg(F.max("a").alias("a"))
        right = spark.range(40_000).selectExpr("id % 20000 AS k", "uuid() AS b").groupBy("k").agg(F.max("b").alias("b"))
        for how in ({}, {"right_hot": False}):
            j = skew_join(left, right, "k", **how)
            assert len(j.collect()) == 20_000
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            plan = j._jdf.queryExecution().explainString(mode).split("== Initial Plan")[0]
            sent = [x for x in plan.splitlines() if "BroadcastQueryStage" in x and "rowCount" in x]
            assert len(sent) == 1 and "rowCount=1)" in sent[0]      # the table of hot keys, which is not empty
            assert "SortMergeJoin Inner" in plan
        few = skew_join(left, right.where("k < 3"), "k")    # a small side may still be sent
        assert len(few.collect()) == 3
    finally:
        spark.conf.set(key, before)
    # null keys meet nothing, however many there are
    nulls = spark.range(50).selectExpr("if(id < 40, null, id) AS k", "id AS a")
    assert skew_join(nulls, nulls.withColumnRenamed("a", "b"), "k", split_rows=5).count() == 10
