"""Telemetry -> lap tagging (J1), clean-lap filter (J2), lap summary (A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.operators.asof import DEFAULT_ROWS_PER_BUCKET, asof_forward
from lapline.operators.quality import green_predicate, select_green_flag_laps


def tag_telemetry_with_lap(
    telemetry: DataFrame,
    laps: DataFrame,
    session_keys: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """Each sample gets the first lap of its driver ending at or after it.

    A lap row carries only its end time (``session_time_s``); samples past
    the last lap end get null ``lap_number`` / ``compound``.
    """
    keys = [*session_keys, "driver"]
    right = laps.select(*keys, "session_time_s", "lap_number", "compound")
    return asof_forward(telemetry, right, on="session_time_s", by=keys,
                        carry=("lap_number", "compound"), tie=("lap_number",),
                        rows_per_bucket=rows_per_bucket)


def filter_to_clean_laps(tagged: DataFrame, laps: DataFrame,
                         session_keys: Sequence[str] = ()) -> DataFrame:
    """Keep samples whose (already assigned) lap is a green-flag lap.

    Runs after J1: filtering laps first would hand a removed lap's samples
    to the next lap.  A semi join on the lap keys; the key side is small
    relative to the samples and AQE broadcasts it when its measured size
    is under the broadcast threshold.
    """
    keys = [*session_keys, "driver", "lap_number"]
    clean = select_green_flag_laps(laps).select(*keys)
    return tagged.join(clean, keys, "left_semi")


def summarize_lap_telemetry(tagged: DataFrame, session_keys: Sequence[str] = (),
                            unique_laps: bool = False) -> DataFrame:
    """A1: one row per (driver, lap) with six driving statistics.

    Samples without a lap (or driver) are dropped, as a pandas groupby
    drops null keys.  ``compound`` is constant inside a lap after J1, so
    the deterministic ``min`` stands for "first".  With ``unique_laps`` the
    caller states that a (driver, lap) has one compound: it then joins the
    grouping keys, which keeps a hash aggregation (a string ``min`` sorts).
    """
    keys = [*session_keys, "driver", "lap_number"]
    compound = [] if unique_laps else [F.min("compound").alias("compound")]
    return (
        tagged.where(F.col("driver").isNotNull() & F.col("lap_number").isNotNull())
        .groupBy(*keys, *(["compound"] if unique_laps else []))
        .agg(
            *compound,
            F.avg("speed_kmh").alias("mean_speed_kmh"),
            F.max("speed_kmh").alias("max_speed_kmh"),
            F.avg("throttle_pct").alias("mean_throttle_pct"),
            F.avg(F.col("brake").cast("double")).alias("brake_fraction"),
            F.avg("rpm").alias("mean_rpm"),
            F.avg("gear").alias("mean_gear"),
        )
    )


def clean_lap_summary(
    telemetry: DataFrame,
    laps: DataFrame,
    session_keys: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """J1 -> J2 -> A1 fused: the green flag rides along with the as-of match.

    Equal to ``summarize(filter_to_clean_laps(tag(...)))`` when lap keys
    are unique, but needs no semi join: the clean flag is carried by the
    as-of window and applied as a plain filter before the aggregation.
    """
    keys = [*session_keys, "driver"]
    right = laps.select(*keys, "session_time_s", "lap_number", "compound",
                        green_predicate().alias("__clean"))
    tagged = asof_forward(telemetry, right, on="session_time_s", by=keys,
                          carry=("lap_number", "compound", "__clean"),
                          tie=("lap_number",), rows_per_bucket=rows_per_bucket)
    return summarize_lap_telemetry(tagged.where(F.col("__clean")), session_keys, unique_laps=True)
