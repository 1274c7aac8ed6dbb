"""Reference SQL for the exact operators, runnable by DuckDB over the driver
tables. Each text mirrors one entry of `cinerank.plans.catalog.queries()`
with identical column names and types.
"""

from __future__ import annotations

from cinerank.sources.fixtures import GENRES

def _r6(expr: str) -> str:
    """The rounding convention of `cinerank.functions.columns.round6`."""
    return f"round(({expr}) + CAST(2.3283064365386963e-10 AS DOUBLE), 6)"


_RATINGS = """ratings AS (
  SELECT o.o_custkey AS uid, l.l_partkey AS mid,
         CAST(ceil(l.l_quantity / CAST(5 AS DOUBLE)) / CAST(2 AS DOUBLE) AS DOUBLE) AS score,
         CAST(floor(epoch(l.l_shipdate)) AS BIGINT) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_MOVIES = """movies AS (
  SELECT p_partkey AS mid, p_name AS name, p_brand AS descri, CAST(p_size AS VARCHAR) AS timelong,
         '' AS issue, '' AS shoot, '' AS language,
         p_type || '|' || replace(p_name, ' ', '|') AS genres, p_brand AS actors, '' AS directors
  FROM part)"""

_TAGS = """tags AS (
  SELECT o.o_custkey AS uid, l.l_partkey AS mid, n.n_name AS tag,
         CAST(floor(epoch(l.l_shipdate)) AS BIGINT) AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

_LIVE = """live AS (
  SELECT event_id, user_id AS uid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS mid,
         CAST(least(CAST(5 AS DOUBLE), greatest(CAST(0.5 AS DOUBLE),
              ceil(value / CAST(25 AS DOUBLE)) / CAST(2 AS DOUBLE))) AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events)"""

_GENRES = "genres(genre) AS (VALUES " + ", ".join(f"('{g}')" for g in GENRES) + ")"

_AVGS = "avgs AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid)"


def _tfidf(nf: int = 50) -> str:
    return f"""words AS (
  SELECT mid, unnest(regexp_split_to_array(lower(replace(genres, '|', ' ')), '\\s')) AS w FROM movies),
tf AS (
  SELECT mid, CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % {nf} AS INTEGER) AS bucket, count(*) AS tf
  FROM words GROUP BY 1, 2),
ndocs AS (SELECT count(*) AS n FROM movies),
dfs AS (SELECT bucket, count(*) AS df FROM tf GROUP BY bucket),
w AS (
  SELECT tf.mid, tf.bucket, tf.tf,
         ln(CAST(ndocs.n + 1 AS DOUBLE) / CAST(dfs.df + 1 AS DOUBLE)) AS idf,
         tf.tf * ln(CAST(ndocs.n + 1 AS DOUBLE) / CAST(dfs.df + 1 AS DOUBLE)) AS weight
  FROM tf JOIN dfs ON tf.bucket = dfs.bucket CROSS JOIN ndocs)"""


def _content_sim(threshold: float = 0.6, nf: int = 50) -> str:
    return _tfidf(nf) + f""",
norms AS (SELECT mid, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY mid),
dots AS (
  SELECT a.mid AS mid, b.mid AS rec_mid, sum(a.weight * b.weight) AS dot
  FROM w a JOIN w b ON a.bucket = b.bucket AND a.mid <> b.mid GROUP BY 1, 2),
sim AS (
  SELECT mid, rec_mid, raw AS sim, {_r6("raw")} AS score FROM (
    SELECT d.mid, d.rec_mid, d.dot / (na.norm * nb.norm) AS raw
    FROM dots d JOIN norms na ON d.mid = na.mid JOIN norms nb ON d.rec_mid = nb.mid
    WHERE na.norm > 0 AND nb.norm > 0)
  WHERE raw > CAST({threshold} AS DOUBLE))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_CANDIDATES = """req AS (SELECT DISTINCT uid, mid FROM reqsrc),
cand AS (
  SELECT uid, mid, rank, rec_mid, score FROM (
    SELECT r.uid, r.mid, s.rec_mid, s.score,
           CAST(row_number() OVER (PARTITION BY r.uid, r.mid ORDER BY round(s.sim, 9) DESC, s.rec_mid) AS INTEGER) AS rank
    FROM req r JOIN sim s ON r.mid = s.mid
    WHERE NOT EXISTS (SELECT 1 FROM ratings x WHERE x.uid = r.uid AND x.mid = s.rec_mid))
  WHERE rank <= 20)"""

_RECENTS = """recents AS (
  SELECT uid, rank, mid, score, ts FROM (
    SELECT uid, mid, score, ts,
           CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, mid, score DESC) AS INTEGER) AS rank
    FROM ratings WHERE uid IN (SELECT uid FROM req))
  WHERE rank <= 20)"""

_SCORES = """scores AS (
  SELECT uid, mid, rec_mid,
         """ + _r6("""avg(sim * r_score) + log10(greatest(count_if(r_score > 3), 1))
               - log10(greatest(count_if(r_score <= 3), 1))""") + """ AS score
  FROM (
    SELECT c.uid, c.mid, c.rec_mid, r.score AS r_score, s.sim
    FROM cand c JOIN recents r ON c.uid = r.uid
    JOIN sim s ON s.mid = c.rec_mid AND s.rec_mid = r.mid
    WHERE s.sim >= CAST(0.7 AS DOUBLE))
  GROUP BY uid, mid, rec_mid)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["rate_more_movies"] = _with(_RATINGS) + "SELECT mid, count(mid) AS count FROM ratings GROUP BY mid"
    q["rate_more_recently_movies"] = _with(_RATINGS) + """SELECT mid, count(mid) AS count, yearmonth FROM (
  SELECT mid, CAST(year(make_timestamp(ts * 1000000)) * 100 + month(make_timestamp(ts * 1000000)) AS INTEGER) AS yearmonth
  FROM ratings) GROUP BY yearmonth, mid"""
    q["rate_more_recently_movies_sql"] = q["rate_more_recently_movies"]
    q["average_movies"] = _with(_RATINGS) + "SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid"
    q["genres_top_movies"] = _with(_RATINGS, _MOVIES, _GENRES, _AVGS) + """SELECT genre, rank, mid, score FROM (
  SELECT g.genre, m.mid, a.avg AS score,
         CAST(row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, m.mid) AS INTEGER) AS rank
  FROM movies m JOIN avgs a ON m.mid = a.mid JOIN genres g ON contains(lower(m.genres), lower(g.genre)))
WHERE rank <= 10"""
    q["genres_top_movies_token"] = q["genres_top_movies"].replace(
        "contains(lower(m.genres), lower(g.genre))",
        "list_contains(string_split(lower(m.genres), '|'), lower(g.genre))")
    assert q["genres_top_movies_token"] != q["genres_top_movies"]
    q["movie_tags"] = _with(_TAGS) + "SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid"
    q["movies_with_tags"] = _with(_MOVIES, _TAGS) + """SELECT m.*, t.tags FROM movies m LEFT JOIN (
  SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM tags GROUP BY mid) t ON m.mid = t.mid"""
    q["ingest_roundtrip"] = q["movies_with_tags"]
    q["distinct_users"] = _with(_RATINGS) + "SELECT DISTINCT uid FROM ratings"
    q["distinct_items"] = _with(_RATINGS) + "SELECT DISTINCT mid FROM ratings"
    q["recent_ratings"] = _with(_RATINGS) + """SELECT uid, rank, mid, score, ts FROM (
  SELECT uid, mid, score, ts,
         CAST(row_number() OVER (PARTITION BY uid ORDER BY ts DESC, mid, score DESC) AS INTEGER) AS rank
  FROM ratings) WHERE rank <= 20"""
    q["recent_ratings_lists"] = f"SELECT uid, rank, mid, score FROM ({q['recent_ratings']})"
    q["content_tf_idf"] = _with(_MOVIES, _tfidf()) + \
        "SELECT mid, bucket, tf, " + _r6("idf") + " AS idf, " + _r6("weight") + " AS weight FROM w"
    q["content_movie_recs"] = _with(_MOVIES, _content_sim()) + "SELECT mid, rec_mid, score FROM sim"
    # movies of one profile have the same words in any order
    q["content_profile_pairs"] = _with(_MOVIES, _content_sim(nf=2 ** 16)) + """, bags AS (
  SELECT mid, string_agg(w, ' ' ORDER BY w) AS bag FROM words GROUP BY mid),
profiles AS (SELECT bag, min(mid) AS mid, count(*) AS n FROM bags GROUP BY bag)
SELECT s.mid, s.rec_mid, a.n AS n_mid, b.n AS n_rec, s.score
FROM sim s JOIN profiles a ON a.mid = s.mid JOIN profiles b ON b.mid = s.rec_mid"""
    q["embedding_movie_recs"] = """WITH f AS (SELECT vec_id AS mid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT mid, v, sqrt(list_dot_product(v, v)) AS norm FROM f)
SELECT mid, rec_mid, """ + _r6("raw") + """ AS score FROM (
  SELECT a.mid, b.mid AS rec_mid, list_dot_product(a.v, b.v) / (a.norm * b.norm) AS raw
  FROM n a JOIN n b ON a.mid <> b.mid WHERE a.norm > 0 AND b.norm > 0)
WHERE raw >= CAST(0.3 AS DOUBLE)"""
    q["embedding_movie_recs_ranked"] = f"""SELECT mid, row_number() OVER (PARTITION BY mid ORDER BY score DESC, rec_mid) AS rank, rec_mid, score
FROM ({q["embedding_movie_recs"]})"""
    q["embedding_user_recs"] = """WITH f AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT uid, rank, mid, """ + _r6("score") + """ AS score FROM (
  SELECT u.id AS uid, i.id AS mid, list_dot_product(u.v, i.v) AS score,
         CAST(row_number() OVER (PARTITION BY u.id ORDER BY list_dot_product(u.v, i.v) DESC, i.id) AS INTEGER) AS rank
  FROM f u JOIN f i ON list_dot_product(u.v, i.v) > 0)
WHERE rank <= 20"""
    q["factor_rmse"] = _with(_RATINGS) + """, f AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
predicted AS (
  SELECT p.uid, p.mid, list_dot_product(u.v, i.v) AS prediction
  FROM (SELECT DISTINCT uid, mid FROM ratings) p JOIN f u ON u.id = p.uid JOIN f i ON i.id = p.mid)
SELECT count(*) AS n, """ + _r6("sqrt(avg((r.score - p.prediction) * (r.score - p.prediction)))") + """ AS rmse
FROM ratings r JOIN predicted p ON p.uid = r.uid AND p.mid = r.mid"""
    chain = [_RATINGS, _MOVIES, _LIVE, _content_sim()]
    q["candidate_movies"] = _with(*chain, "reqsrc AS (SELECT uid, mid FROM live)", _CANDIDATES) + \
        "SELECT uid, mid, rank, rec_mid, score FROM cand"
    q["stream_scores"] = _with(*chain, "reqsrc AS (SELECT uid, mid FROM live)", _CANDIDATES, _RECENTS, _SCORES) + \
        "SELECT uid, mid, rec_mid, score FROM scores"
    latest = """reqsrc AS (
  SELECT uid, mid FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn FROM live)
  WHERE rn = 1)"""
    q["stream_recs_batch"] = _with(*chain, latest, _CANDIDATES, _RECENTS, _SCORES) + """SELECT u.uid, r.rank, r.mid, r.score
FROM req u LEFT JOIN (
  SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, rec_mid) AS INTEGER) AS rank,
         rec_mid AS mid, score
  FROM scores) r ON u.uid = r.uid"""
    # messages carry no event id: equal timestamps are ordered by mid, score
    q["stream_recommender_available_now"] = q["stream_recs_batch"].replace(
        "ORDER BY ts DESC, event_id DESC", "ORDER BY ts DESC, mid DESC, score DESC")
    # recents from the stream's own state: the user's 20 newest live ratings
    stateful = q["stream_recommender_available_now"].replace(
        "FROM ratings WHERE uid IN (SELECT uid FROM req))", "FROM live WHERE uid IN (SELECT uid FROM req))")
    assert stateful != q["stream_recommender_available_now"]
    q["stream_recommender_stateful"] = stateful
    q["rmse_of_mean_predictor"] = _with(_RATINGS) + """, flagged AS (
  SELECT *, (('0x' || substr(md5(concat_ws('|', CAST(uid AS VARCHAR), CAST(mid AS VARCHAR), CAST(ts AS VARCHAR))), 1, 8))::BIGINT % 100) < 20 AS is_test
  FROM ratings),
pred AS (SELECT mid, avg(score) AS pred FROM flagged WHERE NOT is_test GROUP BY mid)
SELECT count(*) AS n, """ + _r6("sqrt(avg((t.score - p.pred) * (t.score - p.pred)))") + """ AS rmse
FROM flagged t JOIN pred p ON t.mid = p.mid WHERE t.is_test"""
    return q
