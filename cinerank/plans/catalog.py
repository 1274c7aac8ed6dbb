"""The query catalogue: one callable per operator, each (spark, sf_dir) ->
DataFrame over the driver tables (or tables Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.columns import register_sql_functions, round6
from cinerank.functions.ranking import ranked_pairs
from cinerank.operators import content, lfm, realtime, stats
from cinerank.operators.similarity import top_k_inner_product
from cinerank.sources import fixtures as fx
from cinerank.sources import text

Query = Callable[[SparkSession, str], DataFrame]

SPARSE_BUCKETS = 2 ** 16  # hashing buckets of the sparse content join
EMBEDDING_BLOCK = 256  # rows; several blocks also on the smaller fixtures
EMBEDDING_THRESHOLD = 0.3  # factor cosine >= 0.6 is empty on the fixture embeddings


def _content_sim(spark: SparkSession, d: str):
    return content.content_similarity(fx.movies(spark, d))


def q_rate_more_movies(spark, d):
    return stats.rate_more_movies(fx.ratings(spark, d))


def q_rate_more_recently_movies(spark, d):
    return stats.rate_more_recently_movies(fx.ratings(spark, d))


def q_rate_more_recently_movies_sql(spark, d):
    """The same statistic through the SQL API, with the `changeDate` alias."""
    register_sql_functions(spark)
    return spark.sql("""
        WITH dated AS (SELECT mid, changeDate(ts) AS yearmonth FROM {rated})
        SELECT yearmonth, mid, count(mid) AS count FROM dated GROUP BY ALL
        ORDER BY yearmonth DESC, count DESC, mid""", rated=fx.ratings(spark, d))


def q_average_movies(spark, d):
    return stats.average_movies(fx.ratings(spark, d))


def q_genres_top_movies(spark, d):
    return stats.genres_top_movies(fx.movies(spark, d), fx.ratings(spark, d), fx.genres(spark))


def q_genres_top_movies_token(spark, d):
    """Genre top-10 with whole-field matching ("old" does not hit "cold")."""
    return stats.genres_top_movies(fx.movies(spark, d), fx.ratings(spark, d), fx.genres(spark), match="token")


def q_movie_tags(spark, d):
    return stats.movie_tags(fx.tags(spark, d))


def q_movies_with_tags(spark, d):
    return stats.movies_with_tags(fx.movies(spark, d), fx.tags(spark, d))


def q_distinct_users(spark, d):
    return stats.distinct_users(fx.ratings(spark, d))


def q_distinct_items(spark, d):
    return stats.distinct_items(fx.ratings(spark, d))


def q_recent_ratings(spark, d):
    return realtime.recent_ratings(fx.ratings(spark, d))


def q_recent_ratings_lists(spark, d):
    """Every user's recent ratings, written as the list elements `MID:SCORE`
    that the list store held and read back from them."""
    lists = text.render_recents(realtime.recent_ratings(fx.ratings(spark, d)))
    return text.parse_recents(lists)[0]


def q_content_tf_idf(spark, d):
    return content.content_tf_idf(fx.movies(spark, d))


def q_content_movie_recs(spark, d):
    return content.content_movie_recs(fx.movies(spark, d))


def q_content_movie_recs_ml(spark, d):
    return content.content_movie_recs_ml(fx.movies(spark, d))


def q_content_profile_pairs(spark, d):
    """Similar profiles by inverted lists over many hashing buckets."""
    return content.content_profile_pairs(fx.movies(spark, d), num_features=SPARSE_BUCKETS)


def q_embedding_movie_recs(spark, d):
    return lfm.lfm_movie_recs(fx.item_factors(spark, d), threshold=EMBEDDING_THRESHOLD, block_rows=EMBEDDING_BLOCK)


def q_embedding_movie_recs_ranked(spark, d):
    """Every item's full list of similar items in order, with ranks."""
    return ranked_pairs(q_embedding_movie_recs(spark, d))


def q_candidate_movies(spark, d):
    live = fx.live_ratings(spark, d)
    return realtime.candidate_movies(live, _content_sim(spark, d), fx.ratings(spark, d))


def q_stream_scores(spark, d):
    live = fx.live_ratings(spark, d)
    ratings = fx.ratings(spark, d)
    sim = _content_sim(spark, d)
    cands = realtime.candidate_movies(live, sim, ratings, with_keys=True)
    recents = realtime.recent_ratings(ratings.join(live.select("uid"), "uid", "left_semi"))
    return realtime.stream_scores(cands, recents, sim)


def q_stream_recs_batch(spark, d):
    return realtime.stream_recs(fx.live_ratings(spark, d), _content_sim(spark, d), fx.ratings(spark, d))


def q_user_recs_als(spark, d):
    model = lfm.train_als(fx.ratings(spark, d))
    return lfm.user_recs(model)


def q_lfm_movie_recs_als(spark, d):
    model = lfm.train_als(fx.ratings(spark, d))
    return lfm.lfm_movie_recs(lfm.item_factors(model))


def q_tune_als(spark, d):
    return lfm.tune_als(fx.ratings(spark, d))


def q_rmse_of_mean_predictor(spark, d):
    return lfm.rmse_of_mean_predictor(fx.ratings(spark, d))


def q_factor_rmse(spark, d):
    """Error of given factors (embeddings by id) on all ratings they cover."""
    factors = fx.item_factors(spark, d)
    return lfm.factor_rmse(fx.ratings(spark, d), factors.withColumnRenamed("mid", "uid"), factors)


def q_embedding_user_recs(spark, d):
    """The 20 items of the largest inner product for every vector as a user."""
    f = fx.item_factors(spark, d).withColumnRenamed("mid", "id")
    top = top_k_inner_product(f, f, 20, block_rows=EMBEDDING_BLOCK)
    return top.select(F.col("id").alias("uid"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("mid"), round6("score").alias("score"))


def q_stream_recommender_available_now(spark, d):
    from cinerank.streaming.recommender import run_available_now_over_fixture
    return run_available_now_over_fixture(spark, d)


def q_stream_recommender_stateful(spark, d):
    """The streaming recommender with recent ratings kept as keyed state, over
    three restarts from its checkpoint."""
    from cinerank.streaming.recommender import run_available_now_over_fixture
    return run_available_now_over_fixture(spark, d, recents_from="stream", parts=3)


def q_ingest_roundtrip(spark, d):
    from cinerank.plans.jobs import ingest_roundtrip
    return ingest_roundtrip(spark, d)


def queries() -> dict[str, Query]:
    return {
        "rate_more_movies": q_rate_more_movies,
        "rate_more_recently_movies": q_rate_more_recently_movies,
        "rate_more_recently_movies_sql": q_rate_more_recently_movies_sql,
        "average_movies": q_average_movies,
        "genres_top_movies": q_genres_top_movies,
        "genres_top_movies_token": q_genres_top_movies_token,
        "movie_tags": q_movie_tags,
        "movies_with_tags": q_movies_with_tags,
        "distinct_users": q_distinct_users,
        "distinct_items": q_distinct_items,
        "recent_ratings": q_recent_ratings,
        "recent_ratings_lists": q_recent_ratings_lists,
        "content_tf_idf": q_content_tf_idf,
        "content_movie_recs": q_content_movie_recs,
        "content_movie_recs_ml": q_content_movie_recs_ml,
        "content_profile_pairs": q_content_profile_pairs,
        "embedding_movie_recs": q_embedding_movie_recs,
        "embedding_movie_recs_ranked": q_embedding_movie_recs_ranked,
        "candidate_movies": q_candidate_movies,
        "stream_scores": q_stream_scores,
        "stream_recs_batch": q_stream_recs_batch,
        "stream_recommender_available_now": q_stream_recommender_available_now,
        "stream_recommender_stateful": q_stream_recommender_stateful,
        "ingest_roundtrip": q_ingest_roundtrip,
        "rmse_of_mean_predictor": q_rmse_of_mean_predictor,
        "factor_rmse": q_factor_rmse,
        "embedding_user_recs": q_embedding_user_recs,
        "user_recs_als": q_user_recs_als,
        "lfm_movie_recs_als": q_lfm_movie_recs_als,
        "tune_als": q_tune_als,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_genres_top_movies(spark, sf_dir)

