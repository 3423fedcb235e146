"""Lap and result quality filters (Q1-Q4) as pushed-down predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.functions import is_true
from lapline.schemas import DID_NOT_START, GREEN_TRACK_STATUS


def accurate_predicate() -> Column:
    return (is_true("is_accurate") & ~is_true("deleted")
            & F.col("lap_time_s").isNotNull())


def green_predicate() -> Column:
    # exact match: "12" (green then yellow) is not a clean lap
    return accurate_predicate() & F.coalesce(
        F.col("track_status") == F.lit(GREEN_TRACK_STATUS), F.lit(False))


def filter_accurate_laps(laps: DataFrame) -> DataFrame:
    """Q1: accurate, not deleted, timed."""
    return laps.where(accurate_predicate())


def select_green_flag_laps(laps: DataFrame) -> DataFrame:
    """Q2: Q1 and track status exactly '1'."""
    return laps.where(green_predicate())


def select_race_starters(results: DataFrame) -> DataFrame:
    """Q3: drop 'Did not start'; a null status is kept."""
    return results.where(~F.col("status").eqNullSafe(F.lit(DID_NOT_START)))


def select_rounds(df: DataFrame, rounds: Iterable[int] | None,
                  column: str = "round_number") -> DataFrame:
    """Q4: round filter; on a dataset partitioned by round it prunes files."""
    if rounds is None:
        return df
    return df.where(F.col(column).isin(list(rounds)))
