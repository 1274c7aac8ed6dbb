"""Hand-made rows with hand-computed answers (edges of every threshold)."""

import math

import pytest
from pyspark.sql import functions as F

from cinerank.functions.columns import yearmonth
from cinerank.functions.ranking import explode_recs, nest_recs, top_n
from cinerank.operators import content, lfm, realtime, stats
from cinerank.operators.similarity import cosine_pairs
from cinerank.operators.simindex import PairSim
from cinerank.sources import text
from cinerank.sources.fixtures import genres


def ratings_df(spark, rows):
    return spark.createDataFrame(rows, "uid bigint, mid bigint, score double, ts bigint")


def movies_df(spark, rows):
    full = [(m, n, "", "", "", "", "", g, "", "") for m, n, g in rows]
    return spark.createDataFrame(full, "mid bigint, name string, descri string, timelong string, issue string, "
                                       "shoot string, language string, genres string, actors string, directors string")


def sim_df(spark, rows, symmetric=True):
    rows = list(rows) + ([(b, a, s) for a, b, s in rows] if symmetric else [])
    return spark.createDataFrame(rows, "mid bigint, rec_mid bigint, score double")


def test_yearmonth_utc(spark):
    df = spark.createDataFrame([(1260759144,), (0,), (951868800,)], "ts bigint")
    assert [r[0] for r in df.select(yearmonth("ts")).collect()] == [200912, 197001, 200003]


def test_popularity_and_average(spark):
    r = ratings_df(spark, [(1, 10, 4.0, 0), (2, 10, 3.0, 0), (1, 11, 5.0, 0)])
    assert sorted(map(tuple, stats.rate_more_movies(r).collect())) == [(10, 2), (11, 1)]
    assert sorted(map(tuple, stats.average_movies(r).collect())) == [(10, 3.5), (11, 5.0)]


def test_monthly_popularity_order(spark):
    jan, feb = 1262304000, 1265000000  # 2010-01-01, 2010-02-01 (UTC)
    r = ratings_df(spark, [(1, 5, 1.0, jan), (2, 5, 1.0, jan), (1, 6, 1.0, jan), (1, 7, 1.0, feb)])
    got = [tuple(x) for x in stats.rate_more_recently_movies(r).collect()]
    assert got == [(7, 1, 201002), (5, 2, 201001), (6, 1, 201001)]


def test_genres_top_substring_ties_and_absences(spark):
    m = movies_df(spark, [(1, "a", "Cold|Plate"), (2, "b", "old|rod"), (3, "c", "Gear"), (4, "d", "old")])
    r = ratings_df(spark, [(1, 1, 4.0, 0), (1, 2, 4.0, 0), (1, 3, 2.0, 0)])  # movie 4 unrated
    g = genres(spark, ["Old", "Gear", "Anvil"])
    got = [tuple(x) for x in stats.genres_top_movies(m, r, g, k=10).orderBy("genre", "rank").collect()]
    # "old" is a substring of "cold"; ties by mid; unrated movie 4 and genre Anvil absent
    assert got == [("Gear", 1, 3, 2.0), ("Old", 1, 1, 4.0), ("Old", 2, 2, 4.0)]
    top1 = stats.genres_top_movies(m, r, g, k=1)
    assert top1.where("genre = 'Old'").select("mid").collect()[0][0] == 1
    token = stats.genres_top_movies(m, r, g, k=10, match="token").where("genre = 'Old'")
    assert [x.mid for x in token.collect()] == [2]


def test_movie_tags_sorted_distinct_and_null(spark):
    m = movies_df(spark, [(1, "a", "x"), (2, "b", "y")])
    t = spark.createDataFrame([(1, 1, "zeta", 0), (2, 1, "alpha", 0), (3, 1, "zeta", 0)],
                              "uid bigint, mid bigint, tag string, ts bigint")
    got = {r.mid: r.tags for r in stats.movies_with_tags(m, t).collect()}
    assert got == {1: "alpha|zeta", 2: None}


@pytest.mark.parametrize("inclusive,expected", [(True, 2), (False, 0)])
def test_cosine_threshold_edge_and_zero_norm(spark, inclusive, expected):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 0.0])],
                              "mid bigint, features array<double>")
    out = cosine_pairs(v, threshold=0.6, inclusive=inclusive)
    rows = sorted(map(tuple, out.collect()))
    assert len(rows) == expected
    if expected:
        assert rows == [(1, 2, 0.6), (2, 1, 0.6)]


def test_cosine_blocks_equal_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(300, 8))
    v = spark.createDataFrame([(i, vecs[i].tolist()) for i in range(300)], "mid bigint, features array<double>")
    got = {(a, b): s for a, b, s in cosine_pairs(v, threshold=0.5, block_rows=64).collect()}
    u = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    s = u @ u.T
    want = {(i, j): round(float(s[i, j]), 6) for i in range(300) for j in range(300)
            if i != j and round(float(s[i, j]), 6) >= 0.5}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 1.5e-6 for k in want)


def test_content_profile_collapse_equals_plain(spark):
    m = movies_df(spark, [(1, "a", "Action|Comedy"), (2, "b", "Comedy|Action"), (3, "c", "Drama"),
                          (4, "d", "Action|Drama"), (5, "e", "Horror")])
    got = sorted(map(tuple, content.content_movie_recs(m, threshold=0.0, inclusive=False).collect()))
    # plain computation from the long TF-IDF table
    w = content.content_tf_idf(m).collect()
    vec = {}
    for r in w:
        vec.setdefault(r.mid, {})[r.bucket] = r.tf * r.idf
    want = []
    for a in vec:
        for b in vec:
            if a == b:
                continue
            dot = sum(x * vec[b].get(k, 0.0) for k, x in vec[a].items())
            na = math.sqrt(sum(x * x for x in vec[a].values()))
            nb = math.sqrt(sum(x * x for x in vec[b].values()))
            if na and nb and round(dot / (na * nb), 6) > 0:
                want.append((a, b, round(dot / (na * nb), 6)))
    assert [(a, b) for a, b, _ in got] == sorted((a, b) for a, b, _ in want)
    # same token bag -> similarity 1 between two different movies
    assert (1, 2, 1.0) in got and (2, 1, 1.0) in got


def test_score_formula_hand_computed(spark):
    cands = spark.createDataFrame([(1, 100, 1, 9, 0.9)], "uid bigint, mid bigint, rank int, rec_mid bigint, score double")
    rec = spark.createDataFrame([(1, 1, 20, 5.0, 0), (1, 2, 21, 2.0, 0), (1, 3, 22, 3.0, 0), (1, 4, 23, 5.0, 0)],
                                "uid bigint, rank int, mid bigint, score double, ts bigint")
    # sims: 0.8 with a 5, 0.9 with a 2, exactly 0.7 with a 3 (kept), 0.699999 with a 5 (dropped)
    sim = sim_df(spark, [(9, 20, 0.8), (9, 21, 0.9), (9, 22, 0.7), (9, 23, 0.699999)])
    got = realtime.stream_scores(cands, rec, sim).collect()
    base = (0.8 * 5 + 0.9 * 2 + 0.7 * 3) / 3
    want = base + math.log10(1) - math.log10(2)  # one like (>3), two dislikes (2 and exactly 3)
    assert len(got) == 1 and abs(got[0].score - round(want, 6)) < 1e-9
    rec2 = rec.where("mid in (20, 21)")
    got2 = realtime.stream_scores(cands, rec2, sim).collect()
    assert got2[0].score == 2.9  # (4.0 + 1.8) / 2, logs cancel


def test_candidates_exclude_rated_before_top_n(spark):
    # partners of item 1 in order 10 > 11 > 12 > 13; user 7 rated 10 and 11
    sim = sim_df(spark, [(1, 10, 0.95), (1, 11, 0.9), (1, 12, 0.85), (1, 13, 0.8)], symmetric=False)
    rated = ratings_df(spark, [(7, 10, 4.0, 0), (7, 11, 4.0, 0), (7, 99, 1.0, 0)])
    req = spark.createDataFrame([(7, 1), (8, 1), (7, 555)], "uid bigint, mid bigint")
    got = [tuple(r) for r in realtime.candidate_movies(req, sim, rated, n=2).orderBy("uid", "rank").collect()]
    assert got == [(7, 1, 1, 12, 0.85), (7, 1, 2, 13, 0.8), (8, 1, 1, 10, 0.95), (8, 1, 2, 11, 0.9)]


def test_candidates_bounded_fetch_equals_unbounded(spark):
    import random
    rnd = random.Random(3)
    pairs = [(a, b, round(rnd.random(), 3)) for a in range(6) for b in range(40) if a != b]
    sim = spark.createDataFrame(pairs, "mid bigint, rec_mid bigint, score double")
    rated = ratings_df(spark, [(u, rnd.randrange(40), 3.0, 0) for u in range(5) for _ in range(rnd.randrange(30))])
    req = spark.createDataFrame([(u, a) for u in range(6) for a in range(6)], "uid bigint, mid bigint")
    got = sorted(map(tuple, realtime.candidate_movies(req, sim, rated, n=5).collect()))
    seen = {(r.uid, r.mid) for r in rated.collect()}
    want = []
    for u in range(6):
        for a in range(6):
            opts = sorted([(-s, b) for (x, b, s) in pairs if x == a and (u, b) not in seen])[:5]
            want += [(u, a, i + 1, b, -ns) for i, (ns, b) in enumerate(opts)]
    assert got == sorted(want)


def test_recent_ratings_newest_first_k(spark):
    r = ratings_df(spark, [(1, m, 1.0, ts) for m, ts in [(5, 10), (6, 30), (7, 20), (8, 30)]])
    got = [(x.rank, x.mid) for x in realtime.recent_ratings(r, k=3).orderBy("rank").collect()]
    assert got == [(1, 6), (2, 8), (3, 7)]


def test_stream_recs_empty_lists(spark):
    sim = sim_df(spark, [(1, 2, 0.9)])
    hist = ratings_df(spark, [(1, 1, 5.0, 10)])
    ev = spark.createDataFrame([(1, 1, 4.0, 100, 1), (2, 1, 4.0, 100, 2), (3, 999, 4.0, 100, 3)],
                               "uid bigint, mid bigint, score double, ts bigint, event_id bigint")
    got = {(r.uid, r.mid, r.score) for r in realtime.stream_recs(ev, sim, hist).collect()}
    # user 1: candidate 2 scored against its recent rating of 1 (0.9*5);
    # user 2 has no recent ratings, user 3 an unknown item: empty lists
    assert got == {(1, 2, 4.5), (2, None, None), (3, None, None)}


def test_latest_event_wins(spark):
    ev = spark.createDataFrame([(1, 5, 1.0, 10), (1, 6, 1.0, 20), (1, 7, 1.0, 20)],
                               "uid bigint, mid bigint, score double, ts bigint")
    assert realtime.latest_event_per_user(ev).collect()[0].mid == 7


def test_parsers_reject_malformed(spark):
    lines = spark.createDataFrame([("1,31,2.5,1260759144",), ("x,31,2.5,1",), ("1,31,2.5",), ("1,31,2.5,",),
                                   ("1.5,2,3.0,4",), (" 2 , 3 , 4.0 , 5 ",)], "value string")
    good, bad = text.parse_ratings(lines)
    assert sorted(map(tuple, good.collect())) == [(1, 31, 2.5, 1260759144), (2, 3, 4.0, 5)]
    reasons = {r.value: r.reason for r in bad.collect()}
    assert reasons == {"x,31,2.5,1": "bad uid", "1,31,2.5": "expected 4 fields", "1,31,2.5,": "bad ts",
                       "1.5,2,3.0,4": "bad uid"}


def test_movie_parser_keeps_blank_trailing_fields(spark):
    lines = spark.createDataFrame([("1^Toy Story ^d^81 minutes^x^y^English^Adventure|Comedy^Tom^ ",),
                                   ("oops^a",)], "value string")
    good, bad = text.parse_movies(lines)
    row = good.collect()[0]
    assert row.mid == 1 and row.name == "Toy Story" and row.genres == "Adventure|Comedy" and row.directors == ""
    assert bad.count() == 1


def test_message_parser(spark):
    msgs = spark.createDataFrame([("4|2|5.0|1260759144",), ("4|x|5.0|1",)], "value string")
    good, bad = text.parse_rating_messages(msgs)
    assert [tuple(r) for r in good.collect()] == [(4, 2, 5.0, 1260759144)] and bad.count() == 1


def test_top_n_nest_explode_roundtrip(spark):
    df = spark.createDataFrame([(1, m, float(m % 3)) for m in range(10)], "uid bigint, mid bigint, score double")
    ranked = top_n(df, ["uid"], [F.desc("score"), F.asc("mid")], 4)
    nested = nest_recs(ranked, "uid")
    back = explode_recs(nested, "uid")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ranked.select("uid", "rank", "mid", "score").collect()))
    assert [r.mid for r in nested.collect()[0].recs] == [2, 5, 8, 1]


def test_rmse_of_mean_predictor_by_hand(spark):
    r = ratings_df(spark, [(u, 1, float(s), u) for u, s in enumerate([1, 2, 3, 4, 5] * 20)])
    got = lfm.rmse_of_mean_predictor(r).collect()[0]
    flagged = lfm.holdout_flag(r).collect()
    train = [x.score for x in flagged if not x.is_test]
    test = [x.score for x in flagged if x.is_test]
    mean = sum(train) / len(train)
    want = math.sqrt(sum((t - mean) ** 2 for t in test) / len(test))
    assert got.n == len(test) and abs(got.rmse - round(want, 6)) < 1e-9


def test_pair_and_profile_sim_agree(spark):
    m = movies_df(spark, [(1, "a", "Action|Comedy"), (2, "b", "Comedy|Action"), (3, "c", "Drama|Action"),
                          (4, "d", "Action"), (5, "e", "Horror")])
    ps = content.content_similarity(m, threshold=0.1)
    pairs = ps.pairs()
    plain = PairSim(pairs)
    probe = spark.createDataFrame([(a, b) for a in range(1, 6) for b in range(1, 6)], "x bigint, y bigint")
    a = sorted((r.x, r.y, round(r.sim, 6)) for r in ps.lookup(probe, "x", "y").collect())
    b = sorted(map(tuple, plain.lookup(probe, "x", "y").collect()))
    assert a == b and len(a) > 0
    mids = spark.createDataFrame([(1,), (3,)], "mid bigint")
    found = [sorted(map(tuple, s.for_mids(mids).select("mid", "rec_mid", "score").collect())) for s in (ps, plain)]
    assert found[0] == found[1]
    asked = spark.createDataFrame([(7, a) for a in range(1, 6)], "uid bigint, mid bigint")
    rated = ratings_df(spark, [(7, 4, 1.0, 0)])
    found = [sorted(map(tuple, realtime.candidate_movies(asked, s, rated, n=2).collect())) for s in (ps, plain)]
    assert found[0] == found[1] and len(found[0]) > 0


def test_hot_profile_split_equals_plain(spark):
    from cinerank.operators.simindex import ProfileSim
    m = movies_df(spark, [(i, "x", "Action|Comedy" if i % 3 else "Action|Drama") for i in range(40)])
    ps = content.content_similarity(m, threshold=0.1)
    plain = sorted(map(tuple, ps.pairs().collect()))
    split = ProfileSim(ps.members, ps.profile_pairs, split_rows=4)
    assert "_lparts" in split.pairs()._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, split.pairs().collect())) == plain
    mids = spark.createDataFrame([(1,), (3,)], "mid bigint")
    assert sorted(map(tuple, split.for_mids(mids).collect())) == sorted(map(tuple, ps.for_mids(mids).collect()))


def test_top_k_inner_product_equals_brute_force(spark):
    import numpy as np
    from cinerank.operators.similarity import top_k_inner_product
    rng = np.random.default_rng(5)
    uv = rng.integers(-2, 3, size=(70, 3)).astype(float)  # small ints: many exact ties
    iv = rng.integers(-2, 3, size=(90, 3)).astype(float)
    users = spark.createDataFrame([(i, uv[i].tolist()) for i in range(70)], "id bigint, features array<double>")
    items = spark.createDataFrame([(100 + j, iv[j].tolist()) for j in range(90)], "id bigint, features array<double>")
    got = sorted(map(tuple, top_k_inner_product(users, items, k=5, block_rows=16)
                     .select("id", "rank", "other", "score").collect()))
    want = []
    for i in range(70):
        scores = sorted(((-float(uv[i] @ iv[j]), 100 + j) for j in range(90) if uv[i] @ iv[j] > 0))[:5]
        want += [(i, r + 1, m, -s) for r, (s, m) in enumerate(scores)]
    assert got == sorted(want)


def test_ranked_pairs_in_full_order(spark):
    from cinerank.functions.ranking import rank_within, ranked_pairs
    df = spark.createDataFrame([(2, 5, 0.7), (1, 3, 0.9), (1, 4, 0.9), (1, 2, 0.95), (2, 1, 0.8)],
                               "mid bigint, rec_mid bigint, score double")
    assert sorted((r.mid, r["rank"], r.rec_mid) for r in ranked_pairs(df).collect()) == [(1, 1, 2), (1, 2, 3), (1, 3, 4), (2, 1, 1), (2, 2, 5)]
    # a list that spans several partitions
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        rows = spark.range(5000).selectExpr("if(id % 10 = 0, id % 7, 9) AS mid", "id AS rec_mid", "(id * 7919) % 100 / 100D AS score")
        got = rank_within(rows, ["mid"], [F.desc("score"), F.asc("rec_mid")], size_col="n").collect()
    finally:
        spark.conf.set(key, "true")
    assert len(got) == 5000
    by = {}
    for r in got:
        by.setdefault(r.mid, []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: (-r.score, r.rec_mid))
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and {r.n for r in rows} == {len(rows)}


def test_scores_gate_and_rank_on_the_raw_similarity(spark):
    from cinerank.operators.simindex import PairSim
    # three partners of 1: the raw cosines order them, rounding to six places would not
    rows = [(1, 10, 0.9000004, 0.9), (1, 11, 0.9000001, 0.9), (1, 9, 0.8999996, 0.9), (10, 20, 0.6999997, 0.7), (11, 20, 0.7000003, 0.7)]
    sim = PairSim(spark.createDataFrame(rows, "mid bigint, rec_mid bigint, sim double, score double"))
    req = spark.createDataFrame([(5, 1)], "uid bigint, mid bigint")
    rated = ratings_df(spark, [(5, 20, 5.0, 0)])
    cands = realtime.candidate_movies(req, sim, rated)
    assert [(r.rec_mid, r.score) for r in cands.orderBy("rank").collect()] == [(10, 0.9), (11, 0.9), (9, 0.9)]
    scored = realtime.stream_scores(cands, realtime.recent_ratings(rated), sim).collect()
    assert [(r.rec_mid, r.score) for r in scored] == [(11, 3.500002)]       # 0.6999997 stays below the gate


def test_heavy_users_read_further_segments(spark):
    from cinerank.operators.simindex import PairSim
    pairs = [(1, b, 1.0 - b / 1000) for b in range(2, 400)]
    sim = PairSim(sim_df(spark, pairs, symmetric=False), segment=8)
    rated = ratings_df(spark, [(1, b, 3.0, 0) for b in range(2, 300)] + [(2, 5, 3.0, 0)] + [(3, b, 3.0, 0) for b in range(2, 395)])
    req = spark.createDataFrame([(u, 1) for u in range(1, 5)], "uid bigint, mid bigint")
    got = {}
    for r in realtime.candidate_movies(req, sim, rated).orderBy("uid", "rank").collect():
        got.setdefault(r.uid, []).append(r.rec_mid)
    assert got == {1: list(range(300, 320)), 2: [2, 3, 4, *range(6, 23)], 3: list(range(395, 400)), 4: list(range(2, 22))}


def test_similarity_threshold_uses_the_raw_value(spark):
    import math

    from cinerank.operators.similarity import cosine_pairs

    def pairs(c, inclusive):
        df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [c, math.sqrt(1 - c * c)])], "mid long, features array<double>")
        return cosine_pairs(df, id_col="mid", vec_col="features", threshold=0.6, inclusive=inclusive,
                            out_cols=("mid", "rec_mid", "score"), id_type="long").count()

    assert pairs(0.6000003, False) == 2 and pairs(0.5999996, True) == 0


def test_null_and_blank_genres_do_not_mix(spark):
    from cinerank.operators.content import content_movie_recs, tokenize

    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "  "), (6, "a|b"), (7, "a|b"), (8, "c")]
    found = [sorted(map(tuple, content_movie_recs(spark.createDataFrame(r, "mid long, genres string")).collect())) for r in (rows, rows[::-1])]
    assert found[0] == found[1]
    assert not {m for m, _, _ in found[0]} & {1, 2, 5}
    assert [r[0] for r in spark.createDataFrame([("  ",), ("",), (" a",)], "t string").select(tokenize("t")).collect()] == [[], [""], ["", "a"]]


def test_ml_form_treats_null_and_blank_genres_alike(spark):
    from cinerank.operators.content import content_movie_recs, content_movie_recs_ml
    rows = [(1, None), (3, ""), (4, ""), (5, " "), (9, " "), (6, "a|b"), (7, "a|b"), (8, "c"), (10, "d|e")]
    df = spark.createDataFrame(rows, "mid long, genres string")
    linked = [sorted((a, b) for a, b, s in f(df).collect() if s == 1.0) for f in (content_movie_recs, content_movie_recs_ml)]
    assert linked[0] == linked[1] == [(3, 4), (4, 3), (6, 7), (7, 6)]


def test_recent_lists_parse_and_reject(spark):
    rows = [(1, ["5:4.5", " 7 : 3 ", "x:2", "9", None, "8:1.5:extra"]), (2, []), (3, None)]
    good, bad = text.parse_recents(spark.createDataFrame(rows, "uid long, ratings array<string>"))
    assert sorted(map(tuple, good.collect())) == [(1, 1, 5, 4.5), (1, 2, 7, 3.0), (1, 6, 8, 1.5)]
    assert sorted((r["uid"], r["rank"], r["value"], r["reason"]) for r in bad.collect()) == [
        (1, 3, "x:2", "bad mid"), (1, 4, "9", "expected 2 fields"), (1, 5, "", "expected 2 fields")]
    assert sorted(map(tuple, text.parse_recents(text.render_recents(good.where("rank < 3")))[0].collect())) == [(1, 1, 5, 4.5), (1, 2, 7, 3.0)]


def test_candidates_keep_a_request_in_one_row_and_read_on_where_needed(spark, monkeypatch):
    """The first round holds one row a request, whatever n; users who rated the
    whole first segment read on; repeated and null rows count as before."""
    written = []
    write = realtime.materialize
    monkeypatch.setattr(realtime, "materialize", lambda df, name: written.append((name, write(df, name))) or written[-1][1])
    sim = spark.createDataFrame([(1, b, 1 - b / 100) for b in range(2, 80)], "mid bigint, rec_mid bigint, score double")
    rated = ratings_df(spark, [(7, b, 4.0, 0) for b in range(2, 50)] + [(8, 3, 4.0, 0), (8, 3, 2.0, 1), (8, None, 2.0, 1)])
    req = spark.createDataFrame([(7, 1), (8, 1), (8, 1), (9, 1), (9, None), (None, 1)], "uid bigint, mid bigint")
    got = {}
    for r in realtime.candidate_movies(req.where("uid <> 7"), sim, rated, n=5).collect():
        got.setdefault(r.uid, []).append((r["rank"], r.rec_mid))
    assert got == {8: [(1, 2), (2, 4), (3, 5), (4, 6), (5, 7)], 9: [(k, k + 1) for k in range(1, 6)]}
    assert [t.count() for name, t in written if name == "candidates"] == [2]
    far = sorted((r["rank"], r.rec_mid) for r in realtime.candidate_movies(req, sim, rated, n=5).where("uid = 7").collect())
    assert far == [(k, 49 + k) for k in range(1, 6)]


def test_cells_copy_a_vector_by_cells_and_not_by_blocks(spark, monkeypatch):
    """Many small blocks: what enters the groups grows with the cells, and the
    rows are those of brute force."""
    import numpy as np

    from cinerank.operators import similarity
    rng = np.random.default_rng(5)
    m = rng.standard_normal((400, 6)).astype("float32").astype(float)
    m[390:] = m[:10]    # copies: ties go to the smaller id
    sent, group = [], similarity._cell_pair_fn
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "mid bigint, features array<double>")
    monkeypatch.setattr(similarity, "CELLS", 4)
    got = {(a, b): s for a, b, s in cosine_pairs(v, threshold=0.5, block_rows=8).collect()}
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    cos = unit @ unit.T
    assert set(got) == {(i, j) for i in range(400) for j in range(400) if i != j and cos[i, j] >= 0.5}
    assert all(abs(s - cos[p]) < 2e-6 for p, s in got.items())
    plan = similarity.block_plan(v.select(F.col("mid").alias("id"), F.col("features").alias("vec")), 0.5, 8)
    assert plan.n_blocks > 50 and plan.cells.select("cell").distinct().count() < 12
    f = v.withColumnRenamed("mid", "id")
    send = similarity._score_cells
    monkeypatch.setattr(similarity, "_score_cells", lambda u, i, *a: sent.append(u.count() + i.count()) or send(u, i, *a))
    top = sorted((r.id, r["rank"], r.other) for r in similarity.top_k_inner_product(f, f, 3, block_rows=8, positive_only=False).collect())
    prod = m @ m.T
    assert top == [(i, k + 1, j) for i in range(400) for k, j in enumerate(sorted(range(400), key=lambda j: (-round(prod[i, j], 9), j))[:3])]
    assert sum(sent) < 400 * 16     # with a copy for each of 50 blocks it was many times as much
    assert group is similarity._cell_pair_fn


def test_first_k_of_a_cell_sorts_few_pairs(monkeypatch):
    """The k-th score of a user bounds what is sorted, in floats or doubles."""
    import numpy as np
    import pandas as pd

    from cinerank.operators import similarity
    rng = np.random.default_rng(3)
    u, it = rng.normal(size=(60, 12)) + 0.4, rng.normal(size=(5000, 12)) + 0.4
    it[4990:] = it[:10]         # ties
    sorted_rows, first = [], similarity._first_k
    monkeypatch.setattr(similarity, "_first_k", lambda r, o, s, k: sorted_rows.append(len(r)) or first(r, o, s, k))

    def run(u, it, k=7, positive_only=True, low=0.0):
        users = pd.DataFrame({"id": np.arange(len(u)), "vec": list(u), "kth": low, "side": 0})
        items = pd.DataFrame({"id": np.arange(len(it)), "vec": list(it), "kth": np.nan, "side": 1})
        out = pd.concat(list(similarity._topk_fn(k, positive_only)(iter([users, items]))))
        return sorted(zip(out["id"], -out["score"].round(9), out["other"], strict=True))

    def brute(u, it, k=7, positive_only=True):
        s = np.array([[np.dot(a, b) for b in it] for a in u])
        return [(i, -round(s[i, j], 9), j) for i in range(len(u))
                for j in sorted((j for j in range(len(it)) if s[i, j] > (0 if positive_only else -np.inf)), key=lambda j: (-round(s[i, j], 9), j))[:k]]
    for a, b in ((u, it), (u.astype("float32"), it.astype("float32")), (u * 1e20, it[:400]), (u * 1e-25, it[:400] * 1e25)):
        assert run(a, b) == brute(a.astype(float), b.astype(float))
    assert sum(sorted_rows) < 60 * 7 * 40       # 300,000 pairs, of which every positive one was sorted before
    assert run(u[:5], it[:300], positive_only=False, low=-np.inf) == brute(u[:5], it[:300], positive_only=False)
    odd = it[:3000].copy()
    odd[5] = np.nan             # no score, and in nobody's way
    assert run(u, odd) == brute(u, odd)
    assert run(u, it[:4]) == brute(u, it[:4])


def test_a_cell_of_alike_vectors_leaves_in_bounded_parts():
    """Where every pair is above the threshold, products and output stay small."""
    import numpy as np
    import pandas as pd

    from cinerank.operators import similarity
    rng = np.random.default_rng(4)
    n = 1500
    rows = pd.DataFrame({"id": np.arange(n), "vec": list((np.ones(4) + rng.normal(size=(n, 4)) * 0.01).astype("float32")), "block": 0, "bj": np.nan, "side": 0})
    ask = pd.DataFrame({"id": [np.nan], "vec": [None], "block": [0], "bj": [0.0], "side": [2]})
    parts = list(similarity._cell_pair_fn(0.9, False, 2048)(iter([rows, ask])))
    assert max(map(len, parts)) <= similarity.OUT_ROWS and sum(map(len, parts)) == n * (n - 1)
    assert len(pd.concat(parts)[["id", "other"]].drop_duplicates()) == n * (n - 1)
