"""Column-expression helpers (N5-N7): all JVM-side, no UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.schemas import STREET_CIRCUIT_KEYWORDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_of(df: DataFrame, name: str) -> Column:
    """Duration column -> double seconds, null stays null.

    Accepts an ANSI day-time interval, a bigint of nanoseconds or a
    double already in seconds; NaN becomes null.  In a string column, whole
    numbers are nanoseconds, numbers with a point or exponent are seconds,
    and other text is an interval (``INTERVAL '0 00:01:30.5' DAY TO SECOND``
    or ``0 days 00:01:30.5``); text that is none of these becomes null.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DayTimeIntervalType):
        out = c.cast("interval second").cast("decimal(20,6)").cast("double")
    elif isinstance(dtype, (T.LongType, T.IntegerType)):
        out = c.cast("double") / F.lit(1e9)
    elif isinstance(dtype, T.StringType):
        text = F.trim(c)
        interval = F.regexp_replace(text, " days? ", " ").try_cast("interval day to second")
        out = (F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("double") / F.lit(1e9))
               .when(text.try_cast("double").isNotNull(), text.try_cast("double"))
               .otherwise(interval.cast("interval second").cast("decimal(20,6)").cast("double")))
    else:
        out = c.cast("double")
    return nan_to_null(out)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def is_true(c) -> Column:
    """pandas ``fillna(False)`` on a nullable boolean."""
    return F.coalesce(_col(c), F.lit(False))


def eq_or_false(c, value) -> Column:
    """pandas ``==`` on a column that may be null: null compares False."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def is_street_circuit(event_name) -> Column:
    """Case-insensitive substring match against the street keywords.

    Unknown (null) names are not street circuits.
    """
    low = F.lower(_col(event_name))
    hits = [low.contains(k.lower()) for k in STREET_CIRCUIT_KEYWORDS]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def one_hot(c, levels, prefix: str) -> list[Column]:
    """Fixed-width one-hot as doubles; unknown / null -> all zeros."""
    c = _col(c)
    return [F.coalesce(c == F.lit(v), F.lit(False)).cast("double").alias(f"{prefix}_{v}")
            for v in levels]
