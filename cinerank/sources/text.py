"""Line-oriented inputs: `^`-separated movies, CSV ratings and tags, and
`UID|MID|SCORE|TIMESTAMP` rating messages, and `MID:SCORE` list elements.

Each parser reads lines with `spark.read.text` (or takes a DataFrame with a
`value` column, e.g. a stream), splits with built-in expressions and
`try_cast`s the numeric fields. A line that does not parse goes to a reject
DataFrame with a reason instead of failing the job, and fields are trimmed
like Java's `String.trim` (every character <= U+0020).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.sources.schema import MOVIE_FIELDS

# Java's String.trim removes every character <= U+0020 from both ends.
_JTRIM_CHARS = "".join(chr(i) for i in range(0x21))


def jtrim(c: Column) -> Column:
    return F.btrim(c, F.lit(_JTRIM_CHARS))


def _num(c: Column, typ: str) -> Column:
    return c.try_cast(typ)


def _fields(lines: DataFrame, sep_regex: str, specs: list[tuple[str, str, bool]], keep: tuple[str, ...] = ()) -> DataFrame:
    """specs: (name, type, trim) per leading field. Every line with its fields
    and `_reason`, null where it parses."""
    parts = F.split(F.col("value"), sep_regex)
    cols, checks = [], []
    for i, (name, typ, trim) in enumerate(specs):
        raw = F.try_element_at(parts, F.lit(i + 1))
        raw = jtrim(raw) if trim else raw
        val = raw if typ == "string" else _num(jtrim(raw), typ)
        cols.append(val.alias(name))
        if typ != "string":
            checks.append(F.when(val.isNull(), F.lit(f"bad {name}")))
    n = len(specs)
    reason = F.coalesce(F.when(F.size(parts) < n, F.lit(f"expected {n} fields")), *checks)
    return lines.select(*keep, F.col("value"), reason.alias("_reason"), *cols)


def _split_parse(lines: DataFrame, sep_regex: str, specs: list[tuple[str, str, bool]],
                 keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Returns (good, rejects), both with the columns `keep` of `lines` before
    their own."""
    parsed = _fields(lines, sep_regex, specs, keep)
    good = parsed.where(F.col("_reason").isNull()).drop("_reason", "value")
    bad = parsed.where(F.col("_reason").isNotNull()).select(*keep, "value", F.col("_reason").alias("reason"))
    return good, bad


# separator and leading fields of a line
MOVIES = (r"\^", [("mid", "bigint", True)] + [(f, "string", True) for f in MOVIE_FIELDS[1:]])
RATINGS = (",", [("uid", "bigint", True), ("mid", "bigint", True), ("score", "double", True), ("ts", "bigint", True)])
TAGS = (",", [("uid", "bigint", True), ("mid", "bigint", True), ("tag", "string", True), ("ts", "bigint", True)])


def parse_marked(lines: DataFrame, form: tuple[str, list[tuple[str, str, bool]]]) -> DataFrame:
    """Good lines and rejects in one pass: the fields, then `value` and
    `reason`, null where `_ok`."""
    parsed = _fields(lines, *form)
    return parsed.select(*[name for name, _, _ in form[1]], F.when(F.col("_reason").isNotNull(), F.col("value")).alias("value"),
                         F.col("_reason").alias("reason"), F.col("_reason").isNull().alias("_ok"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_movies(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split_parse(lines, *MOVIES)


def parse_ratings(lines: DataFrame, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    return _split_parse(lines, sep, RATINGS[1])


def parse_tags(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _split_parse(lines, *TAGS)


def parse_rating_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`UID|MID|SCORE|TIMESTAMP` in column `value` (stream or batch)."""
    return parse_ratings(messages, r"\|")


def parse_recents(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest-rating lists (uid, ratings): `MID:SCORE` elements, newest first.

    Returns (uid, rank, mid, score), rank being the 1-based place in the list
    as it was stored, and the rejects (uid, rank, value, reason). A null or
    empty list has no rows; a null element is rejected and keeps its place.
    """
    each = lists.select("uid", F.posexplode("ratings").alias("_pos", "value"))
    each = each.select("uid", (F.col("_pos") + 1).cast("int").alias("rank"), F.coalesce("value", F.lit("")).alias("value"))
    return _split_parse(each, ":", [("mid", "bigint", True), ("score", "double", True)], keep=("uid", "rank"))


def load_movies(spark: SparkSession, path: str, with_rejects: bool = False):
    good, bad = parse_movies(_lines(spark, path))
    return (good, bad) if with_rejects else good


def load_ratings(spark: SparkSession, path: str, with_rejects: bool = False):
    good, bad = parse_ratings(_lines(spark, path))
    return (good, bad) if with_rejects else good


def load_tags(spark: SparkSession, path: str, with_rejects: bool = False):
    good, bad = parse_tags(_lines(spark, path))
    return (good, bad) if with_rejects else good


# Renderers: the inverse of the parsers, used to produce native-format
# inputs from tables (ingest round trip, stream fixtures).

def render_movies(movies: DataFrame) -> DataFrame:
    return movies.select(F.concat_ws("^", *[F.col(f).cast("string") for f in MOVIE_FIELDS]).alias("value"))


def render_ratings(ratings: DataFrame, sep: str = ",") -> DataFrame:
    return ratings.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in ("uid", "mid", "score", "ts")]).alias("value"))


def render_tags(tags: DataFrame) -> DataFrame:
    return tags.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ("uid", "mid", "tag", "ts")]).alias("value"))


def render_recents(recents: DataFrame) -> DataFrame:
    """(uid, rank, mid, score) -> (uid, ratings): a user's bounded list."""
    element = F.struct("rank", F.concat_ws(":", F.col("mid").cast("string"), F.col("score").cast("string")).alias("value"))
    lists = recents.groupBy("uid").agg(F.sort_array(F.collect_list(element)).alias("_l"))
    return lists.select("uid", F.transform("_l", lambda e: e["value"]).alias("ratings"))


def render_rating_messages(ratings: DataFrame) -> DataFrame:
    return render_ratings(ratings, "|")
