"""Normalised inputs derived from the generated tables (FIXTURES §3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.operators.normalize import normalize_laps, normalize_results, normalize_telemetry
from lapline.sources import adapters as A
from lapline.sources.readers import attach_schedule


def laps(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_laps(A.raw_laps_from_events(A.read_table(spark, sf, "events")))


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    raw = A.raw_telemetry_from_events(A.read_table(spark, sf, "events"))
    return normalize_telemetry(raw, keep=["driver"])


def results(spark: SparkSession, sf: str) -> DataFrame:
    raw = A.raw_results_from_orders(A.read_table(spark, sf, "orders"),
                                    A.read_table(spark, sf, "customer"))
    return normalize_results(raw, keep=["season", "round_number", "entry_id"])


def season_results(spark: SparkSession, sf: str, rounds=None) -> DataFrame:
    return attach_schedule(results(spark, sf), A.schedule(spark), rounds)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    return A.scored_lineitems(A.read_table(spark, sf, "lineitem"))


def pace_laps(spark: SparkSession, sf: str) -> DataFrame:
    return A.pace_laps_from_lineitem(A.read_table(spark, sf, "lineitem"))


def finish(df: DataFrame, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """Round float columns so engine-specific summation order cannot flip
    the last bits of a compared value.

    ``nudge`` shifts values by a tiny constant before rounding, for
    outputs whose exact values often sit on a rounding tie (averages of
    short decimals): a 1-ulp difference then cannot decide the tie.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.col(f.name).cast("double")
            if nudge:
                x = x + F.lit(nudge)
            cols.append(F.round(x, digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
