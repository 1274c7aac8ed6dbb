"""The batch jobs chained like the original deployment: ingest -> statistics
-> content / offline similarity tables -> streaming job reading them."""

from pyspark.sql import functions as F

from cinerank.plans import jobs
from cinerank.session import scratch_path
from cinerank.sources import fixtures as fx
from cinerank.sources import tables, text
from cinerank.streaming import recommender as R
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    base = scratch_path(spark, "test-jobs")
    text.render_movies(fx.movies(spark, SF_SMALL)).write.text(f"{base}/in/movies")
    text.render_ratings(fx.ratings(spark, SF_SMALL)).write.text(f"{base}/in/ratings")
    text.render_tags(fx.tags(spark, SF_SMALL)).write.text(f"{base}/in/tags")
    stored = jobs.ingest_job(spark, f"{base}/in/movies", f"{base}/in/ratings", f"{base}/in/tags", f"{base}/tables", 8)
    assert stored["ratings"].count() == fx.ratings(spark, SF_SMALL).count()
    assert tables.load_table(spark, f"{base}/tables/ratings_rejects").count() == 0

    jobs.statistics_job(spark, stored["movies"], stored["ratings"], fx.genres(spark), f"{base}/stats")
    top = tables.load_table(spark, f"{base}/stats/GenresTopMovies")
    assert top.columns == ["genres", "recs"]
    assert top.where(F.size("recs") > 10).count() == 0 and top.count() > 0

    jobs.content_job(spark, stored["movies"], f"{base}/recs")
    jobs.offline_job(spark, stored["ratings"], f"{base}/recs")
    user_recs = tables.load_table(spark, f"{base}/recs/UserRecs")
    assert user_recs.columns == ["uid", "recs"] and user_recs.where(F.size("recs") > 20).count() == 0

    ranked = tables.load_table(spark, f"{base}/recs/MovieRecsRanked")
    assert ranked.columns == ["mid", "rank", "rec_mid", "score"]
    assert ranked.groupBy("mid").agg((F.max("rank") - F.count("rank")).alias("d")).where("d <> 0").count() == 0
    by_item = tables.load_table(spark, f"{base}/tables/ratings_by_item")
    assert by_item.count() == stored["ratings"].count()

    # stream against the content similarity written by the content job
    live = fx.live_ratings(spark, SF_SMALL)
    text.render_rating_messages(live).write.text(f"{base}/msgs")
    q = R.start_stream_recommender(spark.readStream.schema("value string").text(f"{base}/msgs"),
                                   f"{base}/recs/ContentMovieRecs", f"{base}/tables/ratings_by_user", f"{base}/out",
                                   checkpoint=f"{base}/ckpt", trigger={"availableNow": True}, history_buckets=8)
    q.awaitTermination()
    out = R.stream_recs_long(spark, f"{base}/out")
    assert out.select("uid").distinct().count() == live.select("uid").distinct().count()


def test_ingest_parses_each_line_once(spark):
    lines = spark.createDataFrame([("1,2,3.5,4",), ("x,2,3.5,4",), ("1,2",), (" 5 , 6 ,1.0, 7 ,more",), ("",)], "value string")
    for form, parse in ((text.RATINGS, text.parse_ratings), (text.TAGS, text.parse_tags), (text.MOVIES, text.parse_movies)):
        good, bad = parse(lines)
        both = text.parse_marked(lines, form)
        kept = both.where("_ok").drop("value", "reason", "_ok")
        assert kept.schema == good.schema and sorted(map(tuple, kept.collect())) == sorted(map(tuple, good.collect()))
        out = both.where("not _ok").select("value", "reason")
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, bad.collect()))
        assert both.count() == lines.count()


def test_ingest_writes_parsed_lines_from_one_scan(spark, monkeypatch):
    base = scratch_path(spark, "one-scan")
    for name, line in (("movies", "1^a^b^c^d^e^f^g^h^i"), ("ratings", "1,1,3.5,4"), ("tags", "1,1,t,4")):
        spark.createDataFrame([(line,), ("bad",)], "value string").write.text(f"{base}/{name}")
    scans = []

    def watch(spark, name):
        scans.append(name)
        return scratch_path(spark, name)

    plans = []
    of = type(spark.range(1))
    write = of.write.fget

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(jobs, "scratch_path", watch)
    monkeypatch.setattr(of, "write", property(seen))
    stored = jobs.ingest_job(spark, f"{base}/movies", f"{base}/ratings", f"{base}/tags", f"{base}/out", 4)
    parsed = [p for p in plans if " text" in p]
    assert len(scans) == len(parsed) == 3 and all(p.count("Relation [") == 1 for p in parsed)
    assert stored["movies_with_tags"].count() == 1
