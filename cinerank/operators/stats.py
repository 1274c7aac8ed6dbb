"""Statistics over ratings, movies and tags (popularity, monthly counts,
averages, top-k per genre, tag packing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.columns import yearmonth
from cinerank.functions.ranking import top_n


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """(mid, count): number of ratings per movie. Partial + final hash agg."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def rate_more_recently_movies(ratings: DataFrame, sort: bool = True) -> DataFrame:
    """(mid, count, yearmonth): ratings per movie and calendar month (UTC),
    newest month first, then most rated, then mid (a total order)."""
    out = (ratings.select("mid", yearmonth("ts").alias("yearmonth"))
           .groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
           .select("mid", "count", "yearmonth"))
    if sort:
        # Range-partitioned global sort: sampled bounds split hot months.
        out = out.orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid"))
    return out


def average_movies(ratings: DataFrame) -> DataFrame:
    """(mid, avg): mean score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def genre_matches(movies: DataFrame, genres: DataFrame, match: str = "substring") -> DataFrame:
    """(genre, mid, ...) for every movie whose `genres` text contains the genre.

    `substring` is the case-insensitive containment test of the original
    job (so "war" also hits "award"); `token` requires a whole `|`-field.
    A token is an equality, so it is a hash join on the split fields. A
    substring is none: there the genre list, a parameter list (tens of rows),
    is the broadcast side of a nested loop and the movie side streams past it.
    """
    g = genres.select(F.col("genre"), F.lower("genre").alias("_g"))
    m = movies.withColumn("_genres", F.lower("genres"))
    if match == "token":
        m = m.withColumn("_g", F.explode(F.array_distinct(F.split("_genres", r"\|"))))
        return m.join(g, "_g").drop("_g", "_genres")
    return m.join(F.broadcast(g), F.col("_genres").contains(F.col("_g")), "inner").drop("_g", "_genres")


def genres_top_movies(movies: DataFrame, ratings: DataFrame, genres: DataFrame, k: int = 10,
                      match: str = "substring") -> DataFrame:
    """(genre, rank, mid, score): the k best-rated movies of each genre.

    Unrated movies drop out (inner join with the averages); genres without a
    match produce no row; ties on the average are broken by mid.
    """
    avg = average_movies(ratings)
    scored = movies.select("mid", "genres").join(avg, "mid")
    hits = genre_matches(scored, genres, match)
    ranked = top_n(hits, ["genre"], [F.desc("avg"), F.asc("mid")], k)
    return ranked.select("genre", "rank", "mid", F.col("avg").alias("score"))


def movie_tags(tags: DataFrame) -> DataFrame:
    """(mid, tags): distinct tags of a movie, sorted, joined with `|`.

    collect_set runs as a partial aggregate, so duplicates of a hot movie are
    removed map-side; the set per movie is the output itself.
    """
    return tags.groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_set("tag"))).alias("tags"))


def movies_with_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Every movie with its packed tags (NULL when it has none)."""
    return movies.join(movie_tags(tags), "mid", "left")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def distinct_items(ratings: DataFrame) -> DataFrame:
    return ratings.select("mid").distinct()
