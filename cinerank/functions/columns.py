"""Scalar column expressions.

All are built-in Spark expressions so they stay inside whole-stage codegen
(or, for the array math, inside the JVM); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DECIMALS = 6
# Added before rounding: 2**-32, exact in binary. Averages of products of
# 6-place similarities and half-step ratings land exactly on decimal ties;
# the nudge rounds such ties up no matter in which order a sum was added.
ROUND_NUDGE = 2.0 ** -32


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c) -> Column:
    """Round a non-exact double before it is filtered, ranked or compared."""
    return F.round(_c(c) + F.lit(ROUND_NUDGE), DECIMALS)


def yearmonth(ts) -> Column:
    """Epoch seconds -> integer yyyyMM, in UTC, independent of the session zone.

    The epoch-day is computed arithmetically, so no time-zone conversion and
    no date formatting happens per row.
    """
    day = F.date_from_unix_date(F.floor(_c(ts) / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def dot(a, b) -> Column:
    """Dot product of two array<double> columns."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda s, v: s + v)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda s, v: s + v * v))


def cosine(a, b) -> Column:
    """dot / (|a| |b|); NULL instead of NaN or an ANSI error for a zero norm."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def log10_at_least_one(n) -> Column:
    """log10(max(n, 1)): a missing or zero count contributes 0."""
    return F.log10(F.greatest(F.coalesce(_c(n), F.lit(0)), F.lit(1)).cast("double"))


def register_sql_functions(spark: SparkSession) -> None:
    """SQL aliases, so `SELECT changeDate(ts)` works like a registered UDF
    but is inlined as built-in expressions."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x BIGINT) RETURNS INT "
        "RETURN CAST(year(date_from_unix_date(CAST(floor(x / 86400) AS INT))) * 100 "
        "+ month(date_from_unix_date(CAST(floor(x / 86400) AS INT))) AS INT)"
    )
