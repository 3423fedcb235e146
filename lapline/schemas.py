"""Schemas of the raw and normalised tables, fixed levels and the
required-column check (D1-D8, N0)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the upstream timing-data conventions for the
# results to match (column names of the raw tables, status words, compound
# levels, throttle error code, position unit, street-circuit keywords).
# ---------------------------------------------------------------------------
RAW_LAPS_COLUMNS = (
    "Time", "Driver", "DriverNumber", "Team", "LapNumber", "LapTime",
    "Sector1Time", "Sector2Time", "Sector3Time", "Stint", "Compound",
    "TyreLife", "FreshTyre", "TrackStatus", "Position", "IsAccurate",
    "Deleted", "PitInTime", "PitOutTime",
)
RAW_RESULTS_COLUMNS = (
    "DriverNumber", "Abbreviation", "FullName", "TeamName", "CountryCode",
    "Position", "ClassifiedPosition", "GridPosition", "Q1", "Q2", "Q3",
    "Time", "Status", "Points", "Laps",
)
RAW_TELEMETRY_COLUMNS = (
    "Date", "Time", "SessionTime", "Speed", "RPM", "nGear", "Throttle",
    "Brake", "DRS", "Source", "X", "Y", "Z", "Status",
)
FINISHED_STATUSES = ("Finished", "Lapped")
DID_NOT_START = "Did not start"
RETIRED = "Retired"
COMPOUND_LEVELS = ("soft", "medium", "hard")
THROTTLE_ERROR_VALUE = 104
POSITION_SCALE_TO_METERS = 0.1
GREEN_TRACK_STATUS = "1"
ON_TRACK = "OnTrack"
STREET_CIRCUIT_KEYWORDS = (
    "Monaco", "Azerbaijan", "Singapore", "Las Vegas", "Miami", "Saudi Arabian",
)
# ---------------------------------------------------------------------------

STYLE_COLUMNS = (
    "mean_speed_kmh", "max_speed_kmh", "mean_throttle_pct",
    "brake_fraction", "mean_rpm", "mean_gear",
)
PACE_FEATURES = ("tyre_life", "lap_number", "compound_soft",
                 "compound_medium", "compound_hard")
SESSION_KEYS = ("season", "round_number", "session_type")

_I = T.DayTimeIntervalType(T.DayTimeIntervalType.DAY, T.DayTimeIntervalType.SECOND)


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_LAPS = _struct([
    ("Time", _I), ("Driver", T.StringType()), ("DriverNumber", T.StringType()),
    ("Team", T.StringType()), ("LapNumber", T.DoubleType()), ("LapTime", _I),
    ("Sector1Time", _I), ("Sector2Time", _I), ("Sector3Time", _I),
    ("Stint", T.DoubleType()), ("Compound", T.StringType()),
    ("TyreLife", T.DoubleType()), ("FreshTyre", T.BooleanType()),
    ("TrackStatus", T.StringType()), ("Position", T.DoubleType()),
    ("IsAccurate", T.BooleanType()), ("Deleted", T.BooleanType()),
    ("PitInTime", _I), ("PitOutTime", _I),
])

LAPS = _struct([
    ("driver", T.StringType()), ("driver_number", T.StringType()),
    ("team", T.StringType()), ("lap_number", T.DoubleType()),
    ("session_time_s", T.DoubleType()), ("lap_time_s", T.DoubleType()),
    ("sector1_s", T.DoubleType()), ("sector2_s", T.DoubleType()),
    ("sector3_s", T.DoubleType()), ("stint", T.DoubleType()),
    ("compound", T.StringType()), ("tyre_life", T.DoubleType()),
    ("fresh_tyre", T.BooleanType()), ("track_status", T.StringType()),
    ("position", T.DoubleType()), ("is_accurate", T.BooleanType()),
    ("deleted", T.BooleanType()), ("is_pit_in_lap", T.BooleanType()),
    ("is_pit_out_lap", T.BooleanType()),
])

RAW_RESULTS = _struct([
    ("DriverNumber", T.StringType()), ("Abbreviation", T.StringType()),
    ("FullName", T.StringType()), ("TeamName", T.StringType()),
    ("CountryCode", T.StringType()), ("Position", T.DoubleType()),
    ("ClassifiedPosition", T.StringType()), ("GridPosition", T.DoubleType()),
    ("Q1", _I), ("Q2", _I), ("Q3", _I), ("Time", _I),
    ("Status", T.StringType()), ("Points", T.DoubleType()),
    ("Laps", T.DoubleType()),
])

RESULTS = _struct([
    ("driver", T.StringType()), ("driver_number", T.StringType()),
    ("driver_name", T.StringType()), ("team", T.StringType()),
    ("country_code", T.StringType()), ("position", T.DoubleType()),
    ("classified_position", T.StringType()), ("grid_position", T.DoubleType()),
    ("positions_gained", T.DoubleType()), ("q1_s", T.DoubleType()),
    ("q2_s", T.DoubleType()), ("q3_s", T.DoubleType()),
    ("race_time_s", T.DoubleType()), ("status", T.StringType()),
    ("points", T.DoubleType()), ("laps_completed", T.DoubleType()),
    ("dnf", T.BooleanType()),
])

RAW_TELEMETRY = _struct([
    ("Date", T.TimestampNTZType()), ("Time", _I), ("SessionTime", _I),
    ("Speed", T.DoubleType()), ("RPM", T.DoubleType()),
    ("nGear", T.IntegerType()), ("Throttle", T.DoubleType()),
    ("Brake", T.BooleanType()), ("DRS", T.IntegerType()),
    ("Source", T.StringType()), ("X", T.DoubleType()), ("Y", T.DoubleType()),
    ("Z", T.DoubleType()), ("Status", T.StringType()),
])

TELEMETRY = _struct([
    ("timestamp", T.TimestampNTZType()), ("time_s", T.DoubleType()),
    ("session_time_s", T.DoubleType()), ("speed_kmh", T.DoubleType()),
    ("rpm", T.DoubleType()), ("gear", T.IntegerType()),
    ("throttle_invalid", T.BooleanType()), ("throttle_pct", T.DoubleType()),
    ("brake", T.BooleanType()), ("drs", T.IntegerType()),
    ("source", T.StringType()), ("x_m", T.DoubleType()),
    ("y_m", T.DoubleType()), ("z_m", T.DoubleType()),
    ("on_track", T.BooleanType()),
])


class MissingColumnsError(ValueError):
    """Raised when an input DataFrame lacks required columns.

    The message names every missing column at once.
    """


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Driver-side check on ``df.columns`` (no Spark job)."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise MissingColumnsError(f"missing columns in {what}: {missing}")
