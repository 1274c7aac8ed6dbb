"""Job-level compositions: what each batch job of the original computed and
persisted, as functions over DataFrames and table paths.

  ingest_job      parse movies/ratings/tags, save them clustered by key,
                  derive movies-with-tags and save it as well
  statistics_job  popularity, monthly popularity, averages, genre top-10
  offline_job     ALS user lists and factor-similarity lists
  content_job     TF-IDF similarity lists
  tuning_job      ALS grid search result
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.functions.columns import round6
from cinerank.functions.ranking import nest_recs, ranked_pairs
from cinerank.operators import content, lfm, stats
from cinerank.operators.simindex import PairSim
from cinerank.session import scratch_path
from cinerank.sources import fixtures as fx
from cinerank.sources import tables, text
from cinerank.streaming.recommender import FIXTURE_BUCKETS, HISTORY_BUCKETS


def ingest_job(spark: SparkSession, movies_path: str, ratings_path: str, tags_path: str,
               out_dir: str, history_buckets: int = HISTORY_BUCKETS) -> dict[str, DataFrame]:
    """Load the three native files and store them as tables.

    The original's five ascending indexes (Movie.mid, Rating.uid, Rating.mid,
    Tag.uid, Tag.mid) become layouts: movies clustered by mid; ratings and
    tags clustered by (uid, mid), and a second copy of each by (mid, uid) in
    `ratings_by_item` and `tags_by_item`, so that a filter on either key skips
    row groups; and the rating history in hash buckets of uid under
    `ratings_by_user`, which the stream prunes. Malformed lines are written to
    `<table>_rejects` instead of failing the load.

    Each input is parsed once, into a table of parsed and rejected lines
    below the shared folder that is removed at the end.
    """
    out = out_dir.rstrip("/")
    stored, scratch = {}, []
    sorted_by = {"movies": ["mid"], "ratings": ["uid", "mid"], "tags": ["uid", "mid"]}
    sources = {"movies": (movies_path, text.MOVIES), "ratings": (ratings_path, text.RATINGS), "tags": (tags_path, text.TAGS)}
    for name, (path, form) in sources.items():
        both = text.parse_marked(spark.read.text(path), form)
        where = scratch_path(spark, f"parsed-{name}")
        both.write.parquet(where)
        scratch.append(where)
        both = spark.read.schema(both.schema).parquet(where)
        tables.save_table(both.where("_ok").drop("value", "reason", "_ok"), f"{out}/{name}", sort_by=sorted_by[name])
        tables.save_table(both.where("not _ok").select("value", "reason"), f"{out}/{name}_rejects")
        stored[name] = tables.load_table(spark, f"{out}/{name}")
        if name != "movies":
            tables.save_table(stored[name], f"{out}/{name}_by_item", sort_by=["mid", "uid"])
    tables.save_by_key(stored["ratings"], f"{out}/ratings_by_user", "uid", history_buckets)
    tables.save_table(stats.movies_with_tags(stored["movies"], stored["tags"]),
                      f"{out}/movies_with_tags", sort_by=["mid"])
    stored["movies_with_tags"] = tables.load_table(spark, f"{out}/movies_with_tags")
    tables.remove(spark, *scratch)
    return stored


def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render the fixture tables in the native text formats, ingest them, and
    return the stored movies-with-tags table."""
    base = scratch_path(spark, "ingest")
    text.render_movies(fx.movies(spark, sf_dir)).write.text(f"{base}/in/movies")
    text.render_ratings(fx.ratings(spark, sf_dir)).write.text(f"{base}/in/ratings")
    text.render_tags(fx.tags(spark, sf_dir)).write.text(f"{base}/in/tags")
    stored = ingest_job(spark, f"{base}/in/movies", f"{base}/in/ratings", f"{base}/in/tags", f"{base}/out",
                        FIXTURE_BUCKETS)
    return stored["movies_with_tags"]


def statistics_job(spark: SparkSession, movies: DataFrame, ratings: DataFrame, genres: DataFrame,
                   out_dir: str) -> None:
    out = out_dir.rstrip("/")
    tables.save_table(stats.rate_more_movies(ratings), f"{out}/RateMoreMovies")
    tables.save_table(stats.rate_more_recently_movies(ratings), f"{out}/RateMoreRecentlyMovies")
    tables.save_table(stats.average_movies(ratings), f"{out}/AverageMovies")
    top = stats.genres_top_movies(movies, ratings, genres)
    # persisted as the original's GenresRecommendation(genres, recs): lists of at most k
    tables.save_table(nest_recs(top, "genre").withColumnRenamed("genre", "genres"), f"{out}/GenresTopMovies")


def offline_job(spark: SparkSession, ratings: DataFrame, out_dir: str, threshold: float = 0.6) -> None:
    """ALS user lists (UserRecs) and factor similarity (MovieRecs), which the
    streaming job reads."""
    out = out_dir.rstrip("/")
    model = lfm.train_als(ratings)
    # UserRecs(uid, recs): at most 20 entries per user, nested as stored originally
    tables.save_table(nest_recs(lfm.user_recs(model), "uid"), f"{out}/UserRecs", sort_by=["uid"])
    pairs = lfm.lfm_movie_recs(lfm.item_factors(model), threshold, with_raw=True)
    PairSim(pairs).save(f"{out}/MovieRecs")
    # the lists themselves, in order
    stored = tables.load_table(ratings.sparkSession, f"{out}/MovieRecs/pairs")
    tables.save_table(ranked_pairs(stored), f"{out}/MovieRecsRanked", sort_by=["mid", "rank"])


def content_job(spark: SparkSession, movies: DataFrame, out_dir: str) -> None:
    """Content similarity, saved factorised (members + profile pairs); the
    streaming job can use it in place of MovieRecs."""
    content.content_similarity(movies).save(f"{out_dir.rstrip('/')}/ContentMovieRecs")


def tuning_job(spark: SparkSession, ratings: DataFrame, out_dir: str) -> DataFrame:
    res = lfm.tune_als(ratings).withColumn("rmse", round6("rmse"))
    tables.save_table(res, f"{out_dir.rstrip('/')}/ALSTuning")
    return res
