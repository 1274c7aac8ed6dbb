"""Fixed schemas of the domain tables (declared, never inferred)."""

from pyspark.sql import types as T

MOVIE_FIELDS = ["mid", "name", "descri", "timelong", "issue", "shoot",
                "language", "genres", "actors", "directors"]

MOVIE = T.StructType(
    [T.StructField("mid", T.LongType())]
    + [T.StructField(f, T.StringType()) for f in MOVIE_FIELDS[1:]]
)

RATING = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

TAG = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("mid", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.LongType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

RECS = T.ArrayType(RECOMMENDATION)

# Long form of a similarity matrix: one row per ordered pair.
SIM_PAIRS = T.StructType([
    T.StructField("mid", T.LongType()),
    T.StructField("rec_mid", T.LongType()),
    T.StructField("score", T.DoubleType()),
])
