from lapline.sources.readers import (
    concat_frames,
    read_driver_telemetry,
    read_season_results,
    read_session_laps,
    read_session_results,
    read_session_telemetry,
    write_dataset,
)

__all__ = ["concat_frames", "read_driver_telemetry", "read_season_results",
           "read_session_laps", "read_session_results", "read_session_telemetry",
           "write_dataset"]
