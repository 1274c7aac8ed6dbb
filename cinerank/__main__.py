"""Command line for the batch and streaming jobs.

  python -m cinerank ingest  MOVIES RATINGS TAGS OUT
  python -m cinerank stats   TABLES OUT GENRES   (TABLES = ingest OUT; GENRES = text file, one genre a line)
  python -m cinerank offline TABLES OUT
  python -m cinerank content TABLES OUT
  python -m cinerank tune    TABLES OUT
  python -m cinerank stream  MESSAGES SIM_DIR RATINGS_BY_USER OUT CHECKPOINT [REJECTS]
                             [--recents=history|stream] [--every=2 seconds] [--once]
                             (MESSAGES = a folder of text files, or kafka://HOST:PORT[,HOST:PORT]/TOPIC;
                             RATINGS_BY_USER = ingest OUT/ratings_by_user)
  python -m cinerank query   NAME SF_DIR         (any catalogue entry)

The master is left to spark-submit / the launcher. Results are also shown
on the console (first rows), as the original jobs did.
"""

from __future__ import annotations

import sys

from cinerank.session import build_session


def main(argv: list[str]) -> int:
    if not argv:
        print(__doc__)
        return 2
    cmd, args = argv[0], argv[1:]
    spark = build_session()
    from cinerank.plans import jobs
    from cinerank.sources import tables

    def load(base: str, name: str):
        return tables.load_table(spark, f"{base.rstrip('/')}/{name}")

    if cmd == "ingest":
        stored = jobs.ingest_job(spark, *args[:4])
        stored["movies_with_tags"].show(truncate=False)
    elif cmd == "stats":
        jobs.statistics_job(spark, load(args[0], "movies"), load(args[0], "ratings"), _genres(spark, args[2]), args[1])
        load(args[1], "RateMoreMovies").show(truncate=False)
    elif cmd == "offline":
        jobs.offline_job(spark, load(args[0], "ratings"), args[1])
        load(args[1], "UserRecs").show(truncate=False)
    elif cmd == "content":
        jobs.content_job(spark, load(args[0], "movies"), args[1])
    elif cmd == "tune":
        jobs.tuning_job(spark, load(args[0], "ratings"), args[1]).show(truncate=False)
    elif cmd == "stream":
        _stream(spark, args)
    elif cmd == "query":
        from cinerank.plans.catalog import queries
        queries()[args[0]](spark, args[1]).show(truncate=False)
    else:
        print(__doc__)
        return 2
    spark.stop()
    return 0


def _genres(spark, where: str):
    """The genre list of a text file."""
    from pyspark.sql import functions as F
    return spark.read.text(where).select(F.trim("value").alias("genre")).where("genre <> ''").distinct()


def messages_of(spark, where: str):
    """Streaming rating messages from a folder or a Kafka topic."""
    if where.startswith("kafka://"):
        from cinerank.streaming.recommender import kafka_messages
        servers, _, topic = where[len("kafka://"):].partition("/")
        return kafka_messages(spark, servers, topic)
    return spark.readStream.schema("value string").text(where)


def _stream(spark, args: list[str]) -> None:
    from cinerank.streaming.recommender import start_stream_recommender
    options = dict(a[2:].partition("=")[::2] for a in args if a.startswith("--"))
    source, sim, ratings, out, checkpoint, *more = [a for a in args if not a.startswith("--")]
    trigger = {"availableNow": True} if "once" in options else {"processingTime": options.get("every", "2 seconds")}
    start_stream_recommender(messages_of(spark, source), sim, ratings, out, checkpoint=checkpoint, trigger=trigger,
                             rejects_path=more[0] if more else f"{out.rstrip('/')}_rejects",
                             recents_from=options.get("recents", "history")).awaitTermination()


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
