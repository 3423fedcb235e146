"""Streaming per-lap telemetry summary (extension of J1 + J2 + A1).

Telemetry arrives as a stream; laps are a static table.  Each lap row
becomes a closed interval ``(previous lap end, lap end]`` of its driver,
listed under every time cell that it touches, so tagging a sample is a
stream-static equi-join on (driver, cell) with a range condition (no state
for the join, and a sample meets only the laps of its own cell).

The watermark is on the sample's own ``timestamp``.  A lap's running sums
are kept as state until the watermark has passed the lap's end; then the
lap is final and is emitted once (append mode).  Another driver's lap ends
do not matter, and samples older than the watermark are dropped as late.

On a finite input whose watermark passes every lap end, the result equals
the batch ``clean_lap_summary``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lapline.operators.normalize import normalize_telemetry
from lapline.operators.quality import green_predicate
from lapline.operators.sequence import number_within_key
from lapline.schemas import RAW_TELEMETRY

CELL_SECONDS = 3600.0
AVERAGED = ("speed_kmh", "throttle_pct", "brake", "rpm", "gear")
STATE = "end_ms long, max_speed double, " + ", ".join(f"s{i} double, n{i} long" for i in range(len(AVERAGED)))
SUMMARY = ("mean_speed_kmh double, max_speed_kmh double, mean_throttle_pct double, "
           "brake_fraction double, mean_rpm double, mean_gear double")


def lap_intervals(laps: DataFrame, session_keys: Sequence[str] = ()) -> DataFrame:
    """Static lap table -> (keys, driver, lap_number, compound, clean, start_s,
    end_s).  Equal end times: the lower lap number keeps the interval, the
    next one gets an empty one, as the as-of tie rule does."""
    keys = [*session_keys, "driver"]
    valid = (laps.where(F.col("driver").isNotNull() & F.col("session_time_s").isNotNull())
             .select(*keys, "lap_number", "compound", "session_time_s",
                     green_predicate().alias("clean")))
    # previous lap end per driver, bucketed so a hot driver is not one task
    seq = number_within_key(valid, keys, F.col("session_time_s"), ["session_time_s", "lap_number"],
                            "session_time_s", number="__n", previous="start_s")
    return seq.select(*keys, "lap_number", "compound", "clean", "start_s", F.col("session_time_s").alias("end_s"))


def _cell(t, cell_s: float):
    """Time cell of a session time; times before the start count to cell 0."""
    return F.greatest(F.lit(0), F.floor(t / F.lit(cell_s))).cast("long")


def read_telemetry_stream(spark, path: str, fmt: str = "parquet", extra_columns=("driver",)):
    """Raw telemetry files as a stream (schema fixed up front), normalised."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in extra_columns]
                          + list(RAW_TELEMETRY.fields))
    raw = spark.readStream.format(fmt).schema(schema).load(path)
    return normalize_telemetry(raw, keep=list(extra_columns))


def _lap_folder(columns: Sequence[str]):
    """State update of one lap; ``columns`` name the emitted row."""
    def fold_lap(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Add the samples of one lap to its sums; emit them once the lap has ended."""
        if state.hasTimedOut:
            _, top, *sums = state.get
            state.remove()
            mean = [s / n if n else None for s, n in zip(sums[::2], sums[1::2])]
            yield pd.DataFrame([[*key, mean[0], top, *mean[1:]]], columns=columns)
            return
        end, top, *sums = state.get if state.exists else (0, None, *([0.0, 0] * len(AVERAGED)))
        for pdf in batches:
            end = max(end, int(pdf["__end_ms"].max()))
            for i, c in enumerate(AVERAGED):
                known = pdf[c].dropna().astype("float64")
                sums[2 * i] += float(known.sum())
                sums[2 * i + 1] += int(known.size)
            speed = pdf["speed_kmh"].max()
            if pd.notna(speed):
                top = float(speed) if top is None else max(top, float(speed))
        state.update((end, top, *sums))
        state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs()) + 1)

    return fold_lap


def stream_lap_summary(samples: DataFrame, laps: DataFrame, session_keys: Sequence[str] = (),
                       watermark: str = "10 minutes", clean_only: bool = True,
                       cell_s: float = CELL_SECONDS) -> DataFrame:
    """One row per finished lap, for append mode."""
    keys = [*session_keys, "driver"]
    iv = lap_intervals(laps, session_keys)
    if clean_only:
        iv = iv.where(F.col("clean"))
    iv = iv.withColumn("__cell", F.explode(F.sequence(
        _cell(F.coalesce(F.col("start_s"), F.least(F.lit(0.0), F.col("end_s"))), cell_s),
        _cell(F.col("end_s"), cell_s))))
    s = (samples.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
         .withWatermark("timestamp", watermark)
         .withColumn("__cell", _cell(F.col("session_time_s"), cell_s)))
    t, end = F.col("s.session_time_s"), F.col("l.end_s")
    j = s.alias("s").join(
        iv.alias("l"),
        [F.col(f"s.{k}") == F.col(f"l.{k}") for k in [*keys, "__cell"]]
        + [(F.col("l.start_s").isNull() | (t > F.col("l.start_s"))) & (t <= end)], "inner")
    # the lap's end on the clock of its samples, rounded up to a millisecond
    end_ms = F.ceil(F.unix_micros("s.timestamp") / 1000 + (end - t) * 1000).cast("long")
    j = j.select(*[F.col(f"s.{k}").alias(k) for k in keys], "l.lap_number", "l.compound", "s.timestamp",
                 end_ms.alias("__end_ms"), *[F.col(f"s.{c}").cast("double").alias(c) for c in AVERAGED])
    lap = [*keys, "lap_number", "compound"]
    out = T.StructType([j.schema[c] for c in lap] + list(T.StructType.fromDDL(SUMMARY)))
    return j.groupBy(*lap).applyInPandasWithState(
        _lap_folder(out.names), out, T.StructType.fromDDL(STATE), "append", GroupStateTimeout.EventTimeTimeout)
