import datetime as dt

import pytest
from pyspark.sql import Row

from lapline.operators.normalize import normalize_laps, normalize_results, normalize_telemetry
from lapline.operators.quality import (
    filter_accurate_laps,
    select_green_flag_laps,
    select_race_starters,
)
from lapline.schemas import RAW_LAPS, RAW_RESULTS, RAW_TELEMETRY, MissingColumnsError

S = dt.timedelta


def raw_lap(**over):
    base = dict(Time=S(seconds=5400.5), Driver="VER", DriverNumber="1", Team="Red Bull Racing",
                LapNumber=1.0, LapTime=S(seconds=95.123), Sector1Time=S(seconds=30.1),
                Sector2Time=S(seconds=35.0), Sector3Time=S(seconds=30.023), Stint=1.0,
                Compound="SOFT", TyreLife=3.0, FreshTyre=True, TrackStatus="1", Position=1.0,
                IsAccurate=True, Deleted=False, PitInTime=None, PitOutTime=None)
    base.update(over)
    return tuple(base[f.name] for f in RAW_LAPS.fields)


def test_normalize_laps_seconds_and_flags(spark):
    raw = spark.createDataFrame([raw_lap(), raw_lap(LapNumber=2.0, LapTime=None,
                                                    PitInTime=S(seconds=5500), Compound="HARD",
                                                    Deleted=None)], RAW_LAPS)
    rows = sorted(normalize_laps(raw).collect(), key=lambda r: r.lap_number)
    assert len(rows) == 2
    assert rows[0].lap_time_s == pytest.approx(95.123)
    assert rows[0].session_time_s == pytest.approx(5400.5)
    assert rows[0].compound == "soft" and rows[1].compound == "hard"
    assert rows[1].lap_time_s is None
    assert rows[1].is_pit_in_lap and not rows[0].is_pit_in_lap
    assert rows[1].deleted is None
    assert len(normalize_laps(raw).columns) == 19


def test_missing_columns_listed(spark):
    raw = spark.createDataFrame([raw_lap()], RAW_LAPS).drop("LapTime", "Compound")
    with pytest.raises(MissingColumnsError) as e:
        normalize_laps(raw)
    assert "LapTime" in str(e.value) and "Compound" in str(e.value)
    assert isinstance(e.value, ValueError)


def test_accurate_and_green_filters(spark):
    raw = spark.createDataFrame([
        raw_lap(LapNumber=1.0),
        raw_lap(LapNumber=2.0, IsAccurate=False),
        raw_lap(LapNumber=3.0, Deleted=True),
        raw_lap(LapNumber=4.0, LapTime=None),
        raw_lap(LapNumber=5.0, TrackStatus="12"),
        raw_lap(LapNumber=6.0, Deleted=None),
        raw_lap(LapNumber=7.0, IsAccurate=None),
    ], RAW_LAPS)
    laps = normalize_laps(raw)
    acc = sorted(r.lap_number for r in filter_accurate_laps(laps).collect())
    green = sorted(r.lap_number for r in select_green_flag_laps(laps).collect())
    assert acc == [1.0, 5.0, 6.0]
    assert green == [1.0, 6.0]


def raw_result(status, pos=1.0):
    return ("1", "VER", "Max", "RB", "NED", pos, "1", 2.0, S(seconds=80), None, None,
            S(seconds=5400), status, 25.0, 57.0)


def test_results_dnf_allow_list(spark):
    statuses = ["Finished", "Lapped", "Retired", "Did not start", "Disqualified", "+1 Lap", None]
    raw = spark.createDataFrame([raw_result(s) for s in statuses], RAW_RESULTS)
    out = {r.status: r.dnf for r in normalize_results(raw).collect()}
    assert out == {"Finished": False, "Lapped": False, "Retired": True, "Did not start": True,
                   "Disqualified": True, "+1 Lap": True, None: True}


def test_positions_gained_and_starters(spark):
    raw = spark.createDataFrame([raw_result("Finished", 1.0), raw_result("Retired", None),
                                 raw_result("Did not start", None), raw_result(None, None)],
                                RAW_RESULTS)
    res = normalize_results(raw)
    gained = sorted((r.positions_gained is None, r.positions_gained) for r in res.collect())
    assert gained[0] == (False, 1.0)
    kept = [r.status for r in select_race_starters(res).collect()]
    assert "Did not start" not in kept and None in kept and len(kept) == 3


def test_normalize_telemetry(spark):
    t0 = dt.datetime(2024, 3, 2, 15, 0, 0)
    rows = [
        (t0, S(seconds=1), S(seconds=100), 300.0, 11000.0, 8, 100.0, False, 12, "car", 10.0, 20.0, 30.0, "OnTrack"),
        (t0, S(seconds=2), S(seconds=101), 250.0, 10000.0, 7, 104.0, True, 0, "pos", 0.0, 0.0, 0.0, "OffTrack"),
        (t0, S(seconds=3), S(seconds=102), 200.0, 9000.0, 6, None, None, 0, "car", 1.0, 1.0, 1.0, None),
    ]
    out = normalize_telemetry(spark.createDataFrame(rows, RAW_TELEMETRY)).collect()
    assert [r.throttle_invalid for r in out] == [False, True, False]
    assert [r.throttle_pct for r in out] == [100.0, None, None]
    assert out[0].x_m == pytest.approx(1.0) and out[0].z_m == pytest.approx(3.0)
    assert [r.on_track for r in out] == [True, False, False]
    assert [r.brake for r in out] == [False, True, False]
    assert out[1].session_time_s == pytest.approx(101.0)


def test_street_circuit(spark):
    from lapline.functions import is_street_circuit

    names = ["Monaco Grand Prix", "Azerbaijan Grand Prix", "Singapore Grand Prix",
             "Las Vegas Grand Prix", "Miami Grand Prix", "Saudi Arabian Grand Prix",
             "MONACO grand prix", "British Grand Prix", "Bahrain Grand Prix",
             "Italian Grand Prix", "Japanese Grand Prix", None]
    df = spark.createDataFrame([Row(n=n) for n in names], "n string")
    flags = [r.f for r in df.select(is_street_circuit("n").alias("f")).collect()]
    assert flags == [True] * 7 + [False] * 5
