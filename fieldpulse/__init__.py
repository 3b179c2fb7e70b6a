"""fieldpulse: sensor-telemetry analytics on Spark DataFrames and Structured Streaming.

Layout
  sources/    raw topics, fixtures derived from the driver's tables, history table
  functions/  Column builders (parsing, lenient decoders, keys, clocks)
  operators/  DataFrame -> DataFrame operators (parse, joins, as-of, summaries, streaks, metrics)
  plans/      batch flows that chain operators, and the serving queries
  streaming/  the same operators as Structured Streaming queries
"""

from fieldpulse.session import build_session, checkpoint_dir, ensure_utc

__all__ = ["build_session", "checkpoint_dir", "ensure_utc"]
