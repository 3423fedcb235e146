"""Normalisation of the raw lap, result and telemetry tables.

Each is a single ``select``: no row is filtered, extra input columns are
dropped, session key columns present in the input are carried along.
They are stateless, so they also run on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.functions import nan_to_null, seconds_of
from lapline.schemas import (
    FINISHED_STATUSES,
    ON_TRACK,
    POSITION_SCALE_TO_METERS,
    RAW_LAPS_COLUMNS,
    RAW_RESULTS_COLUMNS,
    RAW_TELEMETRY_COLUMNS,
    THROTTLE_ERROR_VALUE,
    require_columns,
)


def _carry(raw: DataFrame, keep: Sequence[str]) -> list:
    return [F.col(c) for c in keep if c in raw.columns]


def _num(c: str):
    return nan_to_null(F.col(c).cast("double"))


def is_dnf(status) -> F.Column:
    """Allow-list, so an unknown or null status counts as DNF."""
    s = F.col(status) if isinstance(status, str) else status
    return ~F.coalesce(s.isin(*FINISHED_STATUSES), F.lit(False))


def normalize_laps(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """19 raw lap columns -> 19 snake_case columns, durations in seconds."""
    require_columns(raw, RAW_LAPS_COLUMNS, "raw laps")
    return raw.select(
        *_carry(raw, keep),
        F.col("Driver").cast("string").alias("driver"),
        F.col("DriverNumber").cast("string").alias("driver_number"),
        F.col("Team").cast("string").alias("team"),
        _num("LapNumber").alias("lap_number"),
        seconds_of(raw, "Time").alias("session_time_s"),
        seconds_of(raw, "LapTime").alias("lap_time_s"),
        seconds_of(raw, "Sector1Time").alias("sector1_s"),
        seconds_of(raw, "Sector2Time").alias("sector2_s"),
        seconds_of(raw, "Sector3Time").alias("sector3_s"),
        _num("Stint").alias("stint"),
        F.lower(F.col("Compound")).alias("compound"),
        _num("TyreLife").alias("tyre_life"),
        F.col("FreshTyre").cast("boolean").alias("fresh_tyre"),
        F.col("TrackStatus").cast("string").alias("track_status"),
        _num("Position").alias("position"),
        F.col("IsAccurate").cast("boolean").alias("is_accurate"),
        F.col("Deleted").cast("boolean").alias("deleted"),
        F.col("PitInTime").isNotNull().alias("is_pit_in_lap"),
        F.col("PitOutTime").isNotNull().alias("is_pit_out_lap"),
    )


def normalize_results(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Classification table; adds positions_gained and dnf."""
    require_columns(raw, RAW_RESULTS_COLUMNS, "raw results")
    return raw.select(
        *_carry(raw, keep),
        F.col("Abbreviation").alias("driver"),
        F.col("DriverNumber").cast("string").alias("driver_number"),
        F.col("FullName").alias("driver_name"),
        F.col("TeamName").alias("team"),
        F.col("CountryCode").alias("country_code"),
        _num("Position").alias("position"),
        F.col("ClassifiedPosition").cast("string").alias("classified_position"),
        _num("GridPosition").alias("grid_position"),
        (_num("GridPosition") - _num("Position")).alias("positions_gained"),
        seconds_of(raw, "Q1").alias("q1_s"),
        seconds_of(raw, "Q2").alias("q2_s"),
        seconds_of(raw, "Q3").alias("q3_s"),
        seconds_of(raw, "Time").alias("race_time_s"),
        F.col("Status").alias("status"),
        _num("Points").alias("points"),
        _num("Laps").alias("laps_completed"),
        is_dnf("Status").alias("dnf"),
    )


def normalize_telemetry(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Samples; throttle 104 is an error code, X/Y/Z to metres.

    Brake: null counts as not braking (the upstream cast of a float NaN to
    True is not reproduced).
    """
    require_columns(raw, RAW_TELEMETRY_COLUMNS, "raw telemetry")
    throttle = _num("Throttle")
    invalid = F.coalesce(throttle == F.lit(float(THROTTLE_ERROR_VALUE)), F.lit(False))
    return raw.select(
        *_carry(raw, keep),
        F.col("Date").alias("timestamp"),
        seconds_of(raw, "Time").alias("time_s"),
        seconds_of(raw, "SessionTime").alias("session_time_s"),
        _num("Speed").alias("speed_kmh"),
        _num("RPM").alias("rpm"),
        F.col("nGear").cast("int").alias("gear"),
        invalid.alias("throttle_invalid"),
        F.when(~invalid, throttle).alias("throttle_pct"),
        F.coalesce(F.col("Brake").cast("boolean"), F.lit(False)).alias("brake"),
        F.col("DRS").cast("int").alias("drs"),
        F.col("Source").cast("string").alias("source"),
        (_num("X") * POSITION_SCALE_TO_METERS).alias("x_m"),
        (_num("Y") * POSITION_SCALE_TO_METERS).alias("y_m"),
        (_num("Z") * POSITION_SCALE_TO_METERS).alias("z_m"),
        F.coalesce(F.col("Status") == F.lit(ON_TRACK), F.lit(False)).alias("on_track"),
    )
