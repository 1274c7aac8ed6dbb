"""Real-time re-ranking, expressed set-at-a-time.

For a batch of rating events the original job, per event, read the user's
recent ratings, took the item's most similar unseen items as candidates and
scored each candidate against the recent ratings:

    score(q) = sum(sim(q,r) * rating(r)) / n
               + log10(max(#{rating > 3}, 1)) - log10(max(#{rating <= 3}, 1))

over the n recent ratings r with sim(q, r) >= 0.7. Here the same is a few
joins over all events of a batch at once; the functions serve the batch
queries and the streaming `foreachBatch` alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.columns import log10_at_least_one, round6
from cinerank.functions.ranking import top_n
from cinerank.operators.simindex import as_sim, sim_order
from cinerank.operators.skew import skew_join
from cinerank.session import materialize

MAX_USER_RATINGS = 20
MAX_SIM_MOVIES = 20
SCORE_SIM_MIN = 0.7
LIKE_ABOVE = 3.0


def recent_ratings(ratings: DataFrame, k: int = MAX_USER_RATINGS) -> DataFrame:
    """(uid, rank, mid, score, ts): each user's k newest ratings, newest first.

    Equal timestamps are common (ship dates fall on midnight), so mid and
    score complete the order.
    """
    ranked = top_n(ratings.select("uid", "mid", "score", "ts"), ["uid"],
                   [F.desc("ts"), F.asc("mid"), F.desc("score")], k)
    return ranked.select("uid", "rank", "mid", "score", "ts")


def latest_event_per_user(events: DataFrame) -> DataFrame:
    """The last event of every user: a per-user upsert keeps only what the
    last write produced. Ties on ts are broken by event_id when the events
    carry one, else by the message content (mid, then score, descending)."""
    if "event_id" in events.columns:
        order = [F.desc("ts"), F.desc("event_id")]
    else:
        order = [F.desc("ts"), F.desc("mid"), F.desc("score")]
    return top_n(events, ["uid"], order, 1).drop("rank")


def candidate_movies(requests: DataFrame, sim, rated: DataFrame,
                     n: int = MAX_SIM_MOVIES, with_keys: bool = False) -> DataFrame:
    """(uid, mid, rank, rec_mid, score): for each requested (uid, mid), the n
    items most similar to mid that uid has not rated (rated items are removed
    before the top-n is taken). An unknown mid yields no candidates.

    Partner lists are read in segments. In the first round the rated items
    that the first segment of an asked list holds are gathered per user and
    list, at most SEGMENT of them, and every request takes its first n unseen
    partners from the segment as one array: a request is one row throughout.
    Only requests that then have fewer than n, while their list goes on, read
    the next segments, row by row, each time twice as many. A request thus
    reads about as far as its user's rated items force it to, and rounds grow
    with the logarithm of that. Requests for a hot item are split by
    `skew_join`.
    `sim` is a pair table or a `PairSim`/`ProfileSim`. `with_keys` adds the
    candidate's key in `sim` (rec_key) and the raw similarity.
    """
    sim = as_sim(sim)
    asked = requests.select("uid", "mid").where("uid is not null and mid is not null").distinct()
    asked = materialize(asked, "asked")
    req = materialize(sim.tag(asked, "mid", "key").select("uid", "mid", "key"), "requests")
    # only what the requesting users have rated is shuffled
    seen = rated.select("uid", F.col("mid").alias("rec_mid")).join(req.select("uid").distinct(), "uid", "left_semi").distinct()
    seen = materialize(seen, "seen")
    lists = sim.postings(req.select("key"))
    lengths = lists.groupBy("key").agg(F.first("n_seg").alias("n_seg"))
    by = [sim_order(), F.asc("rec_mid")]
    head = lists.where("seg = 0").select("key", "n_seg", "partners")
    entries = head.select("key", F.explode("partners.rec_mid").alias("rec_mid")).distinct()
    # an item is in many lists and rated by many users: hot on both sides
    hits = skew_join(seen.where("rec_mid is not null"), entries, "rec_mid", sim.split_rows)
    hits = hits.join(req.select("uid", "key").distinct(), ["uid", "key"], "left_semi")
    hits = hits.groupBy("uid", "key").agg(F.collect_list("rec_mid").alias("hit"))
    got = skew_join(req.join(hits, ["uid", "key"], "left"), head, "key", sim.split_rows, right_hot=False)
    unseen = F.filter("partners", lambda p: (p["rec_mid"] != F.col("mid")) & ~F.coalesce(F.array_contains("hit", p["rec_mid"]), F.lit(False)))
    got = materialize(got.select("uid", "mid", "key", "n_seg", F.slice(unseen, 1, n).alias("got")), "candidates")
    short = got.where((F.size("got") < n) & (F.col("n_seg") > 1)).select("uid", "mid", "key")
    columns = ["uid", "mid", "rank", "rec_mid", "score", *(["rec_key", "sim"] if with_keys else [])]
    once = req.count() == asked.count()     # an item of several profiles, or listed twice, has several requests
    if once and short.isEmpty():
        out = got.select("uid", "mid", F.posexplode("got").alias("pos", "p")).withColumn("rank", (F.col("pos") + 1).cast("int"))
        return out.select("uid", "mid", "rank", "p.rec_mid", "p.score", *(["p.rec_key", "p.sim"] if with_keys else []))
    rounds = [got.select("uid", "mid", F.explode("got").alias("p")).select("uid", "mid", "p.rec_mid", "p.rec_key", "p.sim", "p.score")]
    first, width = 1, 2
    while not short.isEmpty():
        part = lists.where((F.col("seg") >= first) & (F.col("seg") < first + width)).select("key", "partners")
        more = skew_join(short, part, "key", sim.split_rows, right_hot=False).select("uid", "mid", F.explode("partners").alias("p")).select("uid", "mid", "p.*")
        more = more.where("mid <> rec_mid").join(seen, ["uid", "rec_mid"], "left_anti")
        more = top_n(more.drop("rank"), ["uid", "mid"], by, n)
        rounds.append(materialize(more.select("uid", "mid", "rec_mid", "rec_key", "sim", "score"), "candidates"))
        first, width = first + width, 2 * width
        asking = short.select("uid", "mid").distinct()
        have = reduce(DataFrame.unionByName, rounds).join(asking, ["uid", "mid"], "left_semi").groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("_have"))
        going = lengths.where(F.col("n_seg") > first).select("key")
        short = skew_join(short, going, "key", sim.split_rows, right_hot=False).join(have, ["uid", "mid"], "left")
        short = materialize(short.where(F.coalesce("_have", F.lit(0)) < n).select("uid", "mid", "key"), "short")
    found = reduce(DataFrame.unionByName, rounds)
    return top_n(found, ["uid", "mid"], by, n).select(*columns)


def stream_scores(candidates: DataFrame, recents: DataFrame, sim,
                  min_sim: float = SCORE_SIM_MIN, like_above: float = LIKE_ABOVE) -> DataFrame:
    """(uid, mid, rec_mid, score): priority of every candidate of a request.

    The score of a candidate depends on its user, not on the item asked for,
    and its similarities on its key (profile). So each user's distinct
    candidate keys meet the user's at most k recent ratings, the similarity
    of each pair of keys is looked up once, and what passes the gate on the
    raw similarity is joined back to the candidates. A missing pair means
    similarity 0, which the gate drops, so the lookup is an inner join. A
    candidate with no qualifying recent rating gets no score. A user with
    very many candidates is split by `skew_join`.
    """
    sim = as_sim(sim)
    c = candidates if "rec_key" in candidates.columns else sim.tag(candidates.select("uid", "mid", "rec_mid"), "rec_mid", "rec_key")
    c = materialize(c.select("uid", "mid", "rec_mid", "rec_key"), "keyed-candidates")
    r = materialize(recents.select("uid", F.col("mid").alias("r_mid"), F.col("score").alias("r_score")), "recents")
    r = sim.tag(r, "r_mid", "r_key")
    keys = c.select("uid", "rec_key").distinct()
    # a user has at most k recent ratings: only the candidates' side can be hot
    near = sim.pair_lookup(skew_join(keys, r, "uid", sim.split_rows, right_hot=False), "rec_key", "r_key", "sim")
    near = near.where(F.col("sim") >= F.lit(float(min_sim))).select("uid", "rec_key", "r_mid", "r_score", "sim")
    each = c.select("uid", "rec_mid", "rec_key").distinct()
    j = skew_join(each, near, ["uid", "rec_key"], sim.split_rows, right_hot=False).where(F.col("rec_mid") != F.col("r_mid"))
    agg = j.groupBy("uid", "rec_mid").agg(
        F.avg(F.col("sim") * F.col("r_score")).alias("base"),
        F.count_if(F.col("r_score") > F.lit(like_above)).alias("incr"),
        F.count_if(F.col("r_score") <= F.lit(like_above)).alias("decr"))
    score = F.col("base") + log10_at_least_one("incr") - log10_at_least_one("decr")
    scored = agg.select("uid", "rec_mid", round6(score).alias("score"))
    return c.select("uid", "mid", "rec_mid").join(scored, ["uid", "rec_mid"]).select("uid", "mid", "rec_mid", "score")


def stream_recs(events: DataFrame, sim, ratings: DataFrame,
                k_recent: int = MAX_USER_RATINGS, n_candidates: int = MAX_SIM_MOVIES) -> DataFrame:
    """(uid, rank, mid, score): the list a batch of events leaves per user.

    Every user of the batch gets a row; a user without any scored candidate
    keeps one row with NULL rank/mid/score (the empty list). Lists are
    sorted by score, then mid.
    """
    latest = latest_event_per_user(events).select("uid", "mid")
    users = latest.select("uid")
    cands = candidate_movies(latest, sim, ratings, n_candidates, with_keys=True)
    history = ratings.join(users, "uid", "left_semi")
    recents = recent_ratings(history, k_recent)
    scores = stream_scores(cands, recents, sim)
    ranked = top_n(scores, ["uid"], [F.desc("score"), F.asc("rec_mid")], None)
    return users.join(ranked.select("uid", "rank", F.col("rec_mid").alias("mid"), "score"), "uid", "left")
