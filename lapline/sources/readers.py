"""Readers and writers for partitioned lap / result / telemetry datasets
(S1-S7).

A Spark user keeps many sessions in one dataset partitioned by
``season / round_number / session_type``; the fetch arguments of a
per-session loader become partition filters, so only the matching
directories are listed and read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapline.operators.normalize import normalize_laps, normalize_results, normalize_telemetry
from lapline.schemas import RAW_LAPS, RAW_RESULTS, RAW_TELEMETRY, SESSION_KEYS

PARTITION_COLUMNS = SESSION_KEYS
DRIVER_COLUMNS = ("driver", "driver_number")


# JSON values that are read as text: durations (see ``functions.columns.seconds_of``
# for the accepted forms) and times, whose fractions vary in length
TEXT_TYPES = (T.DayTimeIntervalType, T.TimestampNTZType)
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _text_types(schema: T.StructType, kinds=TEXT_TYPES) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, kinds)
                                       else f.dataType) for f in schema])


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
          extra: Sequence[str] = ()) -> DataFrame:
    """Raw table of ``schema`` plus string columns ``extra`` and the
    partition columns.

    Parquet carries its own types.  JSON is read with the schema, so a
    column that is null in every row is still there.  CSV is read by header
    name as text and cast, so column order does not matter and a column
    missing from the header is reported by ``require_columns``.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        fields = list(_text_types(schema)) + [T.StructField(c, T.StringType()) for c in extra]
        df = spark.read.schema(T.StructType(fields)).json(path)
        times = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    df = spark.read.option("header", "true").csv(path)
    types = {f.name: f.dataType for f in _text_types(schema, T.DayTimeIntervalType)}
    # "7.0" is an integer of a table that once went through a float column
    return df.select(*[(F.col(c).cast("double") if isinstance(types.get(c), T.IntegerType) else F.col(c))
                       .cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def _session_filter(df: DataFrame, season=None, round_number=None, session_type=None,
                    rounds: Iterable[int] | None = None) -> DataFrame:
    if season is not None:
        df = df.where(F.col("season") == F.lit(season))
    if round_number is not None:
        df = df.where(F.col("round_number") == F.lit(round_number))
    if rounds is not None:
        df = df.where(F.col("round_number").isin(list(rounds)))
    if session_type is not None:
        df = df.where(F.col("session_type") == F.lit(session_type))
    return df


def _keys(df: DataFrame) -> list[str]:
    return [c for c in PARTITION_COLUMNS if c in df.columns]


def read_session_laps(spark, path, season=None, round_number=None, session_type="R",
                      fmt="parquet", raw=True) -> DataFrame:
    """Normalised laps of the selected session(s)."""
    df = _session_filter(_read(spark, path, fmt, RAW_LAPS), season, round_number, session_type)
    return normalize_laps(df, keep=_keys(df)) if raw else df


def read_session_results(spark, path, season=None, round_number=None, session_type="R",
                         fmt="parquet", raw=True) -> DataFrame:
    """Normalised classification of the selected session(s)."""
    df = _session_filter(_read(spark, path, fmt, RAW_RESULTS), season, round_number, session_type)
    return normalize_results(df, keep=_keys(df)) if raw else df


def read_driver_telemetry(spark, path, driver: str, season=None, round_number=None,
                          session_type="R", fmt="parquet", raw=True) -> DataFrame:
    """S3: one driver's samples; matches the code or the car number.

    With the dataset partitioned or sorted by driver the equality reaches
    the scan (partition pruning or Parquet row-group skipping).
    """
    df = _session_filter(_read(spark, path, fmt, RAW_TELEMETRY, DRIVER_COLUMNS), season, round_number, session_type)
    df = select_driver(df, driver)
    keep = _keys(df) + [c for c in DRIVER_COLUMNS if c in df.columns]
    return normalize_telemetry(df, keep=keep) if raw else df


def select_driver(df: DataFrame, driver: str) -> DataFrame:
    """Rows of one driver, named by code or by car number."""
    cond = F.col("driver") == F.lit(driver)
    if "driver_number" in df.columns:
        cond = cond | (F.col("driver_number") == F.lit(driver))
    return df.where(cond)


def read_season_results(spark, path, season: int, schedule: DataFrame,
                        rounds: Iterable[int] | None = None, fmt="parquet",
                        session_type: str | None = "R") -> DataFrame:
    """Every non-testing round of a season, tagged with the event name.

    ``rounds`` prunes partitions.
    """
    df = _session_filter(_read(spark, path, fmt, RAW_RESULTS), season, None, session_type, rounds)
    res = normalize_results(df, keep=_keys(df))
    if "season" in schedule.columns:
        schedule = schedule.where(F.col("season") == F.lit(season))
    return attach_schedule(res, schedule.drop("season"), rounds)


def attach_schedule(results: DataFrame, schedule: DataFrame,
                    rounds: Iterable[int] | None = None) -> DataFrame:
    """Round filter (Q4) + testing-event exclusion + event name.

    The schedule comes from the caller, so Spark chooses the join by its
    measured size; a calendar is broadcast and adds no shuffle.
    """
    if rounds is not None:
        results = results.where(F.col("round_number").isin(list(rounds)))
        schedule = schedule.where(F.col("round_number").isin(list(rounds)))
    sched = schedule.where(~F.coalesce(F.col("is_testing"), F.lit(False)))
    keys = ["round_number"] + (["season"] if "season" in sched.columns else [])
    sched = sched.select(*keys, "event_name")
    return results.join(sched, keys, "inner")


def read_session_telemetry(spark, telemetry_path, laps: DataFrame, season=None,
                           round_number=None, session_type="R", fmt="parquet") -> DataFrame:
    """Samples of every driver that has laps in the session.

    The driver comes from the data (or partition) column; a semi join on
    the distinct lap drivers replaces the per-driver loader loop.
    """
    df = _session_filter(_read(spark, telemetry_path, fmt, RAW_TELEMETRY, DRIVER_COLUMNS),
                         season, round_number, session_type)
    keys = _keys(df)
    return select_session_drivers(normalize_telemetry(df, keep=keys + ["driver"]), laps, keys)


def lap_drivers(laps: DataFrame, session_keys: Sequence[str] = ()) -> DataFrame:
    """The distinct drivers that have laps (a null driver is none)."""
    return laps.where(F.col("driver").isNotNull()).select(*session_keys, "driver").distinct()


def select_session_drivers(telemetry: DataFrame, laps: DataFrame,
                           session_keys: Sequence[str] = ()) -> DataFrame:
    """Samples of the drivers that have laps (in the same session)."""
    keys = [k for k in session_keys if k in laps.columns]
    return telemetry.join(lap_drivers(laps, keys), [*keys, "driver"], "left_semi")


def concat_frames(frames: Sequence[DataFrame], schema: T.StructType | None = None,
                  spark: SparkSession | None = None) -> DataFrame:
    """UNION ALL by column name; empty input gives an empty typed frame."""
    if not frames:
        if schema is None or spark is None:
            raise ValueError("empty concat needs a schema and a session")
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet", mode: str = "overwrite",
                  rows_per_file: int = 10_000_000, whole: bool = False) -> None:
    """Write a normalised table partitioned by its session keys.

    Overwriting replaces the sessions that ``df`` holds and leaves all others;
    with ``whole``, or without partition columns, the dataset is replaced.
    Rows are rebalanced on the partition columns: small sessions share a
    task and have one file, a large one is split by its measured size, and
    no file has more than ``rows_per_file`` rows.
    """
    parts = list(partition_by) if partition_by is not None else _keys(df)
    w = (df.hint("rebalance", *parts) if parts else df).write.mode(mode).format(fmt)
    w = w.option("maxRecordsPerFile", rows_per_file)
    if fmt in ("csv", "json"):
        # the default keeps milliseconds only
        w = w.option("header", "true").option("timestampNTZFormat", MICROSECONDS)
    if parts:
        w = w.partitionBy(*parts).option("partitionOverwriteMode", "static" if whole else "dynamic")
    w.save(path)
