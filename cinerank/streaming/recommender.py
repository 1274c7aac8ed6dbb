"""The real-time recommender as a Structured Streaming query.

messages (`UID|MID|SCORE|TIMESTAMP`) -> parse (rejects kept aside)
  -> foreachBatch: latest event per user, candidates (similar, unseen),
     recent ratings, scores, one sorted list per user (empty if none)
  -> per-user upsert into the StreamRecs table (replay-safe by batch id)

The similarity and rating tables are read anew at each batch (so a refreshed
table is picked up) and joined set-at-a-time with the whole micro-batch. Both
lie in hash buckets: a batch opens the rating history of its own users and
the partner lists of its own items, by dynamic partition pruning, and no more.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.ranking import top_n
from cinerank.operators import realtime
from cinerank.operators.simindex import SIM_BUCKETS, load_sim
from cinerank.session import scratch_path
from cinerank.sources import fixtures as fx
from cinerank.sources import tables, text
from cinerank.streaming.state import recent_ratings_state

# Buckets of the rating history by user; a bucket is what a batch reads at least.
HISTORY_BUCKETS = 256
FIXTURE_BUCKETS = 16

def _nest(users: DataFrame, ranked: DataFrame) -> DataFrame:
    """(uid, recs array<struct<mid,score>>), an empty array for users
    without recommendations. Lists hold at most n_candidates entries."""
    packed = F.when(F.col("rank").isNotNull(), F.struct("rank", "mid", "score"))
    nested = users.join(ranked, "uid", "left").groupBy("uid").agg(
        F.sort_array(F.collect_list(packed)).alias("_r"))
    return nested.select("uid", F.transform("_r", lambda s: F.struct(
        s["mid"].alias("mid"), s["score"].alias("score"))).alias("recs"))


def recs_for_batch(events: DataFrame, sim, ratings: DataFrame,
                   k_recent: int = realtime.MAX_USER_RATINGS,
                   n_candidates: int = realtime.MAX_SIM_MOVIES) -> DataFrame:
    """Nested per-user lists for one batch; recent ratings from history."""
    long = realtime.stream_recs(events, sim, ratings, k_recent, n_candidates)
    return _nest(long.select("uid").distinct(), long.where(F.col("rank").isNotNull()))


def recs_from_state(latest: DataFrame, sim, ratings: DataFrame,
                    n_candidates: int = realtime.MAX_SIM_MOVIES) -> DataFrame:
    """Nested lists when the recent ratings come from the stream's own state
    (`latest` = output of `recent_ratings_state`)."""
    req = latest.select("uid", "mid")
    recents = latest.select("uid", F.posexplode("recents").alias("pos", "r")).select(
        "uid", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.mid").alias("mid"),
        F.col("r.score").alias("score"))
    cands = realtime.candidate_movies(req, sim, ratings, n_candidates, with_keys=True)
    scores = realtime.stream_scores(cands, recents, sim)
    ranked = top_n(scores, ["uid"], [F.desc("score"), F.asc("rec_mid")], None).select(
        "uid", "rank", F.col("rec_mid").alias("mid"), "score")
    return _nest(req.select("uid"), ranked)


def history_of(spark: SparkSession, ratings_path: str, users: DataFrame, buckets: int) -> DataFrame:
    """The rating history of the users given, from their buckets only."""
    return tables.rows_for_keys(spark, ratings_path, users, "uid", buckets)


def _batch_writer(sim_path: str, ratings_path: str, out_path: str, rejects_path: str | None,
                  from_state: bool, k_recent: int, n_candidates: int, history_buckets: int, sim_buckets: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sim = load_sim(spark, sim_path, sim_buckets)
        # the micro-batch feeds several actions: keep it, so the source (and
        # the stateful operator) run once per batch; likewise its history
        kept = batch.persist()
        events = kept
        if not from_state:
            events, bad = text.parse_rating_messages(kept)
            if rejects_path:
                tables.write_batch(bad, rejects_path, batch_id)
        ratings = history_of(spark, ratings_path, events.select("uid"), history_buckets).persist()
        try:
            make = recs_from_state if from_state else recs_for_batch
            more = {} if from_state else {"k_recent": k_recent}
            tables.upsert_by_key(make(events, sim, ratings, n_candidates=n_candidates, **more), out_path, "uid", batch_id)
        finally:
            ratings.unpersist()
            kept.unpersist()
    return write


class StreamRun:
    """The running queries of one recommender: with keyed state, lines that
    don't parse have a query of their own. Waiting waits for all of them and
    raises what any of them failed with; stopping stops all."""

    def __init__(self, query, rejects=None):
        self.query, self.rejects_query = query, rejects

    def queries(self) -> list:
        return [q for q in (self.query, self.rejects_query) if q is not None]

    def awaitTermination(self, timeout: float | None = None) -> bool:  # noqa: N802 (as the query's own)
        end = None if timeout is None else time.monotonic() + timeout
        while True:
            for q in self.queries():
                if q.exception() is not None:
                    self.stop()
                    raise q.exception()
            live = [q for q in self.queries() if q.isActive]
            if not live:
                return True
            if end is not None and time.monotonic() >= end:
                return False
            live[0].awaitTermination(1 if len(live) > 1 or end is not None else None)

    def processAllAvailable(self) -> None:  # noqa: N802
        for q in self.queries():
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries():
            q.stop()


def start_stream_recommender(messages: DataFrame, sim_path: str, ratings_path: str, out_path: str,
                             checkpoint: str | None = None, trigger: dict | None = None,
                             rejects_path: str | None = None, recents_from: str = "history",
                             k_recent: int = realtime.MAX_USER_RATINGS,
                             n_candidates: int = realtime.MAX_SIM_MOVIES,
                             state_partitions: int | None = None,
                             history_buckets: int = HISTORY_BUCKETS, sim_buckets: int = SIM_BUCKETS) -> StreamRun:
    """Start the query. `messages` is a streaming DataFrame with a string
    column `value` (Kafka `value` cast to string, a text/file source, ...);
    `ratings_path` a table written by `save_by_key` on uid, `sim_path` a
    saved similarity, both with the numbers of buckets given.

    recents_from='history' reads recent ratings from the ratings table, like
    the original (an outside writer keeps it current); 'stream' keeps them
    as keyed state fed by the stream itself.
    Default trigger: every 2 seconds. The checkpoint makes a restarted
    query resume at the first unfinished batch; the upsert of a replayed
    batch puts the same rows in place again.

    With keyed state the number of state partitions is fixed when the
    checkpoint is created (from `spark.sql.shuffle.partitions`); it is set
    to `state_partitions` (default: the cluster's default parallelism) for
    the creation of this query only.
    """
    spark = messages.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    from_state = recents_from == "stream"
    src, rejects = messages, None
    if from_state:
        good, bad = text.parse_rating_messages(messages)
        src = recent_ratings_state(good, k_recent)
    w = (src.writeStream
         .foreachBatch(_batch_writer(sim_path, ratings_path, out_path, rejects_path, from_state,
                                     k_recent, n_candidates, history_buckets, sim_buckets))
         .option("checkpointLocation", checkpoint)
         .outputMode("update" if from_state else "append"))
    w = w.trigger(**(trigger or {"processingTime": "2 seconds"}))
    if not from_state:
        return StreamRun(w.start())
    if rejects_path:
        rejects = _start_rejects(bad, rejects_path, f"{checkpoint.rstrip('/')}-rejects", trigger)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        return StreamRun(w.start(), rejects)
    finally:
        spark.conf.set(key, before)


def _start_rejects(bad: DataFrame, path: str, checkpoint: str, trigger: dict | None):
    w = (bad.writeStream
         .foreachBatch(lambda batch, batch_id: tables.write_batch(batch, path, batch_id))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def kafka_messages(spark: SparkSession, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Rating messages from a Kafka topic (needs the Kafka connector on the
    classpath; offsets are tracked by the query checkpoint).

    `max_offsets_per_trigger` bounds a micro-batch, so a backlog after a
    restart is worked off in several bounded batches.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(int(max_offsets_per_trigger)))
    return r.load().select(F.col("value").cast("string").alias("value"))


def stream_recs_long(spark: SparkSession, out_path: str) -> DataFrame:
    """Current StreamRecs in long form (uid, rank, mid, score); a user with
    an empty list keeps one row of NULLs."""
    state = tables.read_upserted(spark, out_path, "uid")
    return state.select("uid", F.posexplode_outer("recs").alias("pos", "r")).select(
        "uid", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.mid").alias("mid"),
        F.col("r.score").alias("score"))


def stage_fixture_inputs(spark: SparkSession, sf_dir: str, base: str, buckets: int = FIXTURE_BUCKETS) -> dict[str, str]:
    """Write what the offline jobs provide: the similarity and the history."""
    paths = {"sim": f"{base}/sim", "ratings": f"{base}/ratings", "messages": f"{base}/messages"}
    from cinerank.operators.content import content_similarity
    content_similarity(fx.movies(spark, sf_dir)).save(paths["sim"], buckets)
    tables.save_by_key(fx.ratings(spark, sf_dir), paths["ratings"], "uid", buckets)
    return paths


def run_available_now_over_fixture(spark: SparkSession, sf_dir: str, recents_from: str = "history",
                                   parts: int = 1) -> DataFrame:
    """Run the streaming query over the fixture's live ratings until all
    available messages are processed, and return the resulting lists.

    With several `parts` the messages arrive in that many files, in the order
    of their time, and the query is stopped and started again from its
    checkpoint for each of them, so it has to restore its state.
    """
    base = scratch_path(spark, "stream")
    p = stage_fixture_inputs(spark, sf_dir, base)
    live = fx.live_ratings(spark, sf_dir)
    cuts = live.approxQuantile("ts", [k / parts for k in range(1, parts)], 0.01) if parts > 1 else []
    ends = [*cuts, None]
    for k, end in enumerate(ends):
        part = live if end is None else live.where(F.col("ts") < end)
        part = part if k == 0 else part.where(F.col("ts") >= ends[k - 1])
        text.render_rating_messages(part).write.text(f"{p['messages']}/part={k}")
        messages = spark.readStream.schema("value string").text(f"{p['messages']}/*")
        start_stream_recommender(messages, p["sim"], p["ratings"], f"{base}/out",
                                 checkpoint=f"{base}/checkpoint", trigger={"availableNow": True},
                                 rejects_path=f"{base}/rejects", recents_from=recents_from,
                                 history_buckets=FIXTURE_BUCKETS, sim_buckets=FIXTURE_BUCKETS).awaitTermination()
    return stream_recs_long(spark, f"{base}/out")
