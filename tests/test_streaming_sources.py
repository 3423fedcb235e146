import tempfile

import pytest
from pyspark.sql import functions as F

from lapline.operators.telemetry import clean_lap_summary
from lapline.plans import inputs as I
from lapline.sources import adapters as A
from lapline.functions import seconds_of
from lapline.schemas import LAPS
from lapline.sources.readers import (
    concat_frames,
    read_driver_telemetry,
    read_season_results,
    read_session_laps,
    read_session_telemetry,
    write_dataset,
)
from lapline.streaming import read_telemetry_stream, stream_lap_summary

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = ["driver", "lap_number", "compound", "mean_speed_kmh", "max_speed_kmh",
            "mean_throttle_pct", "brake_fraction", "mean_rpm", "mean_gear"]
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


def _far_sample(raw, day):
    """One sample of a driver without laps, far ahead: it moves the watermark."""
    return (raw.limit(1).withColumn("driver", F.lit("none"))
            .withColumn("Date", F.expr(f"TIMESTAMP_NTZ'{day} 00:00:00'")))


def _run(summary, name, path, parts):
    q = summary.writeStream.outputMode("append").format("memory").queryName(name).start()
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        q.processAllAvailable()
    q.stop()


def test_stream_equals_batch(spark):
    raw_tel = A.raw_telemetry_from_events(A.read_table(spark, SF, "events"))
    path = tempfile.mkdtemp(prefix="lapline-stream-")
    laps = I.laps(spark, SF).cache()
    raw_tel.limit(0).write.mode("overwrite").parquet(path)
    summary = stream_lap_summary(read_telemetry_stream(spark, path), laps)
    _run(summary, "lap_summary_stream", path, [raw_tel, _far_sample(raw_tel, "2030-01-01")])
    got = spark.table("lap_summary_stream")
    batch = clean_lap_summary(I.telemetry(spark, SF), laps)
    assert _rows(got) == _rows(batch) != []


def test_stream_drivers_out_of_phase_and_late_sample(spark):
    raw = A.raw_telemetry_from_events(A.read_table(spark, SF, "events"))

    def sample(driver, second, speed):
        t = f"INTERVAL '{second}' SECOND"
        return (raw.limit(1).withColumn("driver", F.lit(driver)).withColumn("Speed", F.lit(float(speed)))
                .withColumn("Date", F.expr(f"TIMESTAMP_NTZ'2025-03-01 12:00:00' + {t}"))
                .withColumn("SessionTime", F.expr(f"cast({t} as interval day to second)")))

    laps = spark.createDataFrame(
        [("A", 1.0, 100.0, "soft", True, False, 90.0, "1"), ("B", 1.0, 5000.0, "hard", True, False, 90.0, "1")],
        "driver string, lap_number double, session_time_s double, compound string, "
        "is_accurate boolean, deleted boolean, lap_time_s double, track_status string")
    path = tempfile.mkdtemp(prefix="lapline-stream-")
    raw.limit(0).write.mode("overwrite").parquet(path)
    summary = stream_lap_summary(read_telemetry_stream(spark, path), laps, watermark="10 seconds")
    # B's lap ends late, which must not close or drop A's; 60 s is late once 2000 s is seen
    _run(summary, "lap_summary_phases", path, [
        sample("B", 20, 100).unionByName(sample("A", 10, 200)), sample("A", 90, 220),
        sample("B", 2000, 300), sample("A", 60, 999), sample("B", 2010, 200), sample("B", 9000, 1)])
    got = {r.driver: r.mean_speed_kmh for r in spark.table("lap_summary_phases").collect()}
    assert got == {"A": 210.0, "B": 200.0}


def test_partitioned_dataset_roundtrip_and_pruning(spark):
    raw = A.raw_laps_from_events(A.read_table(spark, SF, "events"))
    raw = (raw.withColumn("season", F.lit(2024)).withColumn("round_number", F.lit(1) + F.col("Position").cast("int") % 3)
           .withColumn("session_type", F.lit("R")))
    path = tempfile.mkdtemp(prefix="lapline-ds-")
    write_dataset(raw, path)
    laps = read_session_laps(spark, path, season=2024, round_number=2, session_type="R")
    expect = raw.where(F.col("round_number") == 2).count()
    assert laps.count() == expect and "lap_time_s" in laps.columns
    plan = laps._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "round_number" in plan


def _with_session(raw):
    return (raw.withColumn("season", F.lit(2024)).withColumn("round_number", F.lit(3))
            .withColumn("session_type", F.lit("R")))


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_round_trip_of_laps(spark, fmt):
    # Sector2Time is null in every row, which JSON leaves out of its files
    raw = _with_session(A.raw_laps_from_events(A.read_table(spark, SF, "events")))
    path = tempfile.mkdtemp(prefix="lapline-ds-")
    write_dataset(raw, path, fmt=fmt, rows_per_file=50)
    got = read_session_laps(spark, path, season=2024, round_number=3, fmt=fmt)
    want = I.laps(spark, SF)
    assert "season" in got.columns
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip_of_driver_samples(spark, fmt):
    raw = _with_session(A.raw_telemetry_from_events(A.read_table(spark, SF, "events")))
    path = tempfile.mkdtemp(prefix="lapline-ds-")
    write_dataset(raw, path, fmt=fmt)
    driver = raw.select("driver").first()[0]
    got = read_driver_telemetry(spark, path, driver, fmt=fmt)
    want = I.telemetry(spark, SF).where(F.col("driver") == driver)
    assert want.count() > 0
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    laps = I.laps(spark, SF).where(F.col("driver") == driver)
    session = read_session_telemetry(spark, path, laps, season=2024, fmt=fmt)
    assert session.count() == (want.count() if laps.count() else 0)


def test_duration_forms_in_text(spark):
    rows = [("90500000000",), ("90.5",), ("INTERVAL '0 00:01:30.5' DAY TO SECOND",),
            ("0 days 00:01:30.500000",), ("nonsense",), (None,), ("NaN",)]
    df = spark.createDataFrame(rows, "d string")
    got = [r[0] for r in df.select(seconds_of(df, "d")).collect()]
    assert got == [90.5, 90.5, 90.5, 90.5, None, None, None]


def test_season_results_leave_testing_events_out(spark):
    raw = A.raw_results_from_orders(A.read_table(spark, SF, "orders"), A.read_table(spark, SF, "customer"))
    path = tempfile.mkdtemp(prefix="lapline-ds-")
    write_dataset(raw.withColumn("session_type", F.lit("R")), path)
    sched = spark.createDataFrame([(1, "Test", True), (2, "Bahrain Grand Prix", False), (3, "Other", None)],
                                  "round_number int, event_name string, is_testing boolean")
    got = read_season_results(spark, path, 1995, sched)
    n = raw.where("season = 1995 AND round_number IN (2, 3)").count()
    assert got.count() == n > 0
    assert {r[0] for r in got.select("event_name").distinct().collect()} <= {"Bahrain Grand Prix", "Other"}
    assert read_season_results(spark, path, 1995, sched, rounds=[2]).select("round_number").distinct().count() == 1


def test_results_meet_the_calendar_in_place(spark, tmp_path):
    """No month's results go to one task to be sorted."""
    spark.createDataFrame([(i, i % 3) for i in range(60)], "o_orderkey long, o_custkey long").selectExpr(
        "*", "'F' as o_orderstatus", "1.5D as o_totalprice",
        "timestamp_ntz'2024-01-15 00:00:00' + make_ym_interval(0, cast(o_orderkey % 12 as int)) as o_orderdate",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(i, f"c{i}", i) for i in range(3)], "c_custkey long, c_name string, c_nationkey int") \
        .write.parquet(str(tmp_path / "customer.parquet"))
    df = I.season_results(spark, str(tmp_path)).groupBy("event_name").count()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # these results are large
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(round_number" not in plan
    assert {r["event_name"]: r["count"] for r in df.collect()} == {name: 5 for name in A.EVENT_NAMES}


def test_concat_of_nothing(spark):
    assert concat_frames([], LAPS, spark).columns == [f.name for f in LAPS]
    with pytest.raises(ValueError):
        concat_frames([])


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_writing_a_session_leaves_the_others(spark, tmp_path, fmt):
    def rows(number, n):
        return spark.range(n).select(F.lit(2024).alias("season"), F.lit(number).alias("round_number"), F.lit("R").alias("session_type"), "id")

    def sizes():
        return {r["round_number"]: r["count"] for r in spark.read.format(fmt).load(path).groupBy("round_number").count().collect()}

    path, keys = str(tmp_path / "laps"), ["season", "round_number", "session_type"]
    write_dataset(rows(1, 10).unionByName(rows(2, 20)), path, keys, fmt)
    write_dataset(rows(2, 5), path, keys, fmt)
    assert sizes() == {1: 10, 2: 5}
    write_dataset(rows(3, 7), path, keys, fmt)
    assert sizes() == {1: 10, 2: 5, 3: 7}
    write_dataset(rows(3, 4), path, keys, fmt, mode="append")
    write_dataset(rows(2, 6), path, keys, fmt, whole=True)
    assert sizes() == {2: 6}
