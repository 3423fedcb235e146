from lapline.streaming.lap_summary import lap_intervals, read_telemetry_stream, stream_lap_summary

__all__ = ["lap_intervals", "read_telemetry_stream", "stream_lap_summary"]
