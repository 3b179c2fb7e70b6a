"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the fixtures, which are Spark projections of
``events``) in full, so its work grows with the data. Wall-clock stamps use the
deterministic fixture clock so an oracle can reproduce them. As in the reference's chain of
jobs, queries downstream of the enrichment read the enriched rows from a table written once
per session (``flow.enriched_table``); ``asof_enriched`` / ``enriched_from_raw`` compute
the whole chain.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.functions import keys as K
from fieldpulse.functions import lenient as LN
from fieldpulse.functions.clock import processing_ms
from fieldpulse.functions.parsing import decode_utf8, event_time, split_fields
from fieldpulse.operators import latest as LT
from fieldpulse.operators import measurement as MM
from fieldpulse.operators import metrics as MT
from fieldpulse.operators import normalize as NM
from fieldpulse.operators import streak as SK
from fieldpulse.operators import summary as SM
from fieldpulse.plans import flow
from fieldpulse.plans import serving as SV
from fieldpulse.sources import fixtures as FX
from fieldpulse.sources.history import scan_history, write_history
from fieldpulse.sources.topics import route_by_topic
from fieldpulse.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = FX.raw_messages(spark, sf_dir)
    return raw.select(decode_utf8(F.col("value")).alias("payload"), "topic", "timestamp")


def q_route_by_topic(spark, sf_dir):
    routed = route_by_topic(FX.raw_messages(spark, sf_dir))
    return routed.select(decode_utf8(F.col("value")).alias("payload"), "topic", "env", "tenant",
                         "topic_device", "kind")


def _parse_query(kind: str) -> Query:
    def q(spark, sf_dir):
        return flow.typed_from_raw(spark, sf_dir, kind).drop("event_ts")
    q.__name__ = f"q_parse_{kind}"
    return q


def q_parse_errors(spark, sf_dir):
    return flow.errors_from_raw(spark, sf_dir)


def q_event_time(spark, sf_dir):
    t = _raw_text(spark, sf_dir).withColumn("_p", split_fields(F.col("payload")))
    text = F.try_element_at("_p", F.lit(2))
    return t.select("payload", text.alias("event_time_text"), event_time(text).alias("event_ts"))


def q_join_measurement(spark, sf_dir):
    return flow.measurement(spark, sf_dir)


def q_asof_enriched(spark, sf_dir):
    return flow.enriched(spark, sf_dir)


def q_enriched_from_raw(spark, sf_dir):
    return flow.enriched_from_raw(spark, sf_dir)


def q_streak_from_raw(spark, sf_dir):
    return SK.low_humidity_streak(flow.enriched_from_raw(spark, sf_dir))


def q_hop_window(spark, sf_dir):
    e = flow.enriched_table(spark, sf_dir)
    w = F.window("measurement_event_ts", "600 seconds", "10 seconds")
    return e.select("device_id", "humidity_seq", "measurement_event_ts",
                    w.start.alias("window_start"), w.end.alias("window_end"))


def q_recent_summary(spark, sf_dir):
    return SM.recent_summary(flow.enriched_table(spark, sf_dir))


def q_recent_summary_latest(spark, sf_dir):
    # only each tenant's newest closed window is computed (equal to picking it from all windows)
    return SM.latest_closed_summary(flow.enriched_table(spark, sf_dir))


def q_recent_summary_view(spark, sf_dir):
    return SV.summary_response(SM.latest_closed_summary(flow.enriched_table(spark, sf_dir)))


def q_streak_agg(spark, sf_dir):
    return SK.streak_agg(flow.enriched_table(spark, sf_dir)).drop("latest")


def q_low_humidity_streak(spark, sf_dir):
    return SK.low_humidity_streak(flow.enriched_table(spark, sf_dir))


def q_drought_summary(spark, sf_dir):
    return SK.drought_summary(SK.low_humidity_streak(flow.enriched_table(spark, sf_dir)))


def q_drought_level(spark, sf_dir):
    return SK.drought_level(SK.drought_summary(SK.low_humidity_streak(flow.enriched_table(spark, sf_dir))))


def q_drought_streaks(spark, sf_dir):
    return SV.drought_streaks(SK.low_humidity_streak(flow.enriched_table(spark, sf_dir)))


def q_latest_per_device(spark, sf_dir):
    return LT.latest_per_device(flow.enriched_table(spark, sf_dir))


def _metrics_query(bucket: str) -> Query:
    def q(spark, sf_dir):
        return MT.metrics_by_bucket(flow.enriched_table(spark, sf_dir), bucket, ("env", "tenant", "device_id"))
    q.__name__ = f"q_metrics_{bucket.lower()}"
    return q


def _state_view(spark, sf_dir):
    return LT.latest_state_view(flow.enriched_table(spark, sf_dir))


def q_devices(spark, sf_dir):
    return SV.devices(_state_view(spark, sf_dir))


def q_recent_snapshots(spark, sf_dir):
    return SV.recent_snapshots(_state_view(spark, sf_dir))


def q_map_points(spark, sf_dir):
    return SV.map_points(_state_view(spark, sf_dir))


def q_view_ttl(spark, sf_dir):
    """Alive keys at the moment of the last write: the newest keys live, the rest have expired."""
    v = _state_view(spark, sf_dir)
    alive = LT.view_ttl(v, v.agg(F.max("written_at")).scalar())
    return alive.select("redis_key", "written_at", (F.col("written_at") + F.expr("INTERVAL 600 SECONDS")).alias("expires_at"))


def _one_device(spark, sf_dir):
    """First device of the first tenant, and the first and middle second of its time range."""
    e = flow.enriched_table(spark, sf_dir)
    tenant = e.agg(F.min("tenant")).first()[0]
    r = e.filter(F.col("tenant") == tenant).agg(F.min("device_id"), F.unix_seconds(F.min("measurement_event_ts")),
                                               F.unix_seconds(F.max("measurement_event_ts"))).first()
    return e, tenant, r[0], r[1], (r[1] + r[2]) // 2


def q_device_metrics(spark, sf_dir):
    e, tenant, device, lo, hi = _one_device(spark, sf_dir)
    return SV.device_metrics(e, "prod", tenant, device, "DAY", lo, hi)


def q_device_metrics_lookback(spark, sf_dir):
    """Without a range: the day before the end of the data."""
    e, tenant, device, _, _ = _one_device(spark, sf_dir)
    return SV.device_metrics(e, "prod", tenant, device, "HOUR", as_of=e.agg(F.max("measurement_event_ts")).scalar())


@FX.memo_plan
def _history_path(spark, sf_dir):
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/history-{uuid.uuid4().hex[:12]}"
    write_history(flow.enriched_table(spark, sf_dir), path, FX.fixture_history_clock())
    return path


def q_history_scan(spark, sf_dir):
    """The history table is written, then one device's range is read from it."""
    _, tenant, device, lo, hi = _one_device(spark, sf_dir)
    return scan_history(spark, _history_path(spark, sf_dir), "prod", tenant, device,
                        F.timestamp_seconds(F.lit(lo)), F.timestamp_seconds(F.lit(hi)))


def q_history_metrics(spark, sf_dir):
    _, tenant, device, lo, hi = _one_device(spark, sf_dir)
    return SV.device_metrics_from_history(spark, _history_path(spark, sf_dir), "prod", tenant, device, "HOUR", lo, hi)


def q_device(spark, sf_dir):
    _, tenant, device, _, _ = _one_device(spark, sf_dir)
    return SV.device(_state_view(spark, sf_dir), "prod", tenant, device)


def q_recent_summary_for(spark, sf_dir):
    """A tenant with a summary and one without."""
    latest = SM.latest_closed_summary(flow.enriched_table(spark, sf_dir))
    return SV.recent_summary_for(spark, latest, "prod", "tenant-1").unionByName(SV.recent_summary_for(spark, latest, "prod", "nobody"))


def q_recent_summary_from_history(spark, sf_dir):
    """The same from the history table, of which only the newest dates are read."""
    path = _history_path(spark, sf_dir)
    return SV.recent_summary_from_history(spark, path, "prod", "tenant-2").unionByName(SV.recent_summary_from_history(spark, path, "prod", "nobody"))


def q_drought_summary_for(spark, sf_dir):
    streaks = SK.low_humidity_streak(flow.enriched_table(spark, sf_dir))
    return SV.drought_summary_for(spark, streaks, "prod", "tenant-2").unionByName(SV.drought_summary_for(spark, streaks, "prod", "nobody"))


def q_match_key_pattern(spark, sf_dir):
    """Keys of ``tenant-1``; ``tenant_1`` is another tenant, which has none."""
    v = _state_view(spark, sf_dir)
    parts = [SV.keys_like(v, K.state_key_pattern("prod", t)).select("redis_key", F.lit(t).alias("asked")) for t in ("tenant-1", "tenant_1")]
    return parts[0].unionByName(parts[1])


def q_rekey_by_device(spark, sf_dir):
    return NM.rekey_by_device(flow.typed_from_raw(spark, sf_dir, "humidity"), 8).select("key", "deviceId", "seq")


def q_stamp_seconds(spark, sf_dir):
    """J1 with the reference's whole-second processing stamp."""
    t = flow.typed_inputs(spark, sf_dir)
    return MM.join_measurement(t["humidity"], t["temperature"],
                               processing_ms=lambda: processing_ms(True, FX.fixture_measurement_clock()))


def q_latency_by_run(spark, sf_dir):
    """Two runs, devices named by prefix, appended to one results table and read back."""
    h = flow.history(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/latency-{uuid.uuid4().hex[:12]}"
    for prefix in ("device-0000", "device-0001"):
        MT.append_results(SV.latency_by_run(h, prefix), path)
    return spark.read.parquet(path)


def q_history_rows(spark, sf_dir):
    return flow.history(spark, sf_dir)


def q_latency_stats(spark, sf_dir):
    return MT.latency_stats(flow.history(spark, sf_dir), ("env", "tenant"))


def q_latency_runs(spark, sf_dir):
    return SV.latency_runs(flow.history(spark, sf_dir), r"^(device-[0-9]{4})")


def q_lenient_decoders(spark, sf_dir):
    t = _raw_text(spark, sf_dir).withColumn("_p", split_fields(F.col("payload")))
    f = lambda i: F.try_element_at("_p", F.lit(i + 1))
    last = F.element_at("_p", -1)
    return t.select(
        "payload",
        LN.lenient_int(f(2)).alias("int_or_zero"),
        LN.lenient_int_or_null(f(2)).alias("int_or_null"),
        LN.lenient_long_or_null(f(3)).alias("long_or_null"),
        LN.lenient_double_or_null(f(2)).alias("double_or_null"),
        LN.lenient_bool_or_null(last).alias("bool_or_null"),
        LN.lenient_ts_millis(f(1)).alias("ts_from_time"),
        LN.lenient_ts_millis(f(3)).alias("ts_from_number"))


def q_device_from_key(spark, sf_dir):
    e = flow.enriched_table(spark, sf_dir)
    st = SK.low_humidity_streak(e).select(F.col("redis_key").alias("key"))
    keys = (e.select(F.col("redis_key").alias("key")).distinct()
            .unionByName(st)
            .unionByName(FX.raw_messages(spark, sf_dir).select(F.col("topic").alias("key")).distinct()))
    return keys.select("key", K.device_from_state_key(F.col("key")).alias("state_device"),
                       K.device_from_streak_key(F.col("key")).alias("streak_device"))


def q_stream_parse_errors(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_normalizer
    return replay_normalizer(spark, sf_dir)


def q_stream_measurement(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_measurement
    return replay_measurement(spark, sf_dir)


def q_stream_asof(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_asof
    return replay_asof(spark, sf_dir)


def q_stream_chain_replay(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_chain_twice
    return replay_chain_twice(spark, sf_dir).drop("event_ts")


def q_stream_latest_state(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_latest_state
    return replay_latest_state(spark, sf_dir)


def q_stream_summary(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_summary
    return replay_summary(spark, sf_dir)


def q_stream_summary_late(spark, sf_dir):
    """Slices out of order: windows hold what had arrived when the watermark closed them."""
    from fieldpulse.streaming.replay import replay_summary_late
    return replay_summary_late(spark, sf_dir)


def q_late_drop(spark, sf_dir):
    """The readings that came when all their windows were closed."""
    from fieldpulse.streaming.replay import replay_late_drop
    return replay_late_drop(spark, sf_dir).select("env", "tenant", "device_id", "humidity_seq", "measurement_event_ts", "batch_id")


def q_stream_streak(spark, sf_dir):
    from fieldpulse.streaming.replay import replay_streak
    return replay_streak(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "route_by_topic": q_route_by_topic,
    "parse_humidity": _parse_query("humidity"),
    "parse_temperature": _parse_query("temperature"),
    "parse_location": _parse_query("location"),
    "parse_state": _parse_query("state"),
    "parse_errors": q_parse_errors,
    "event_time": q_event_time,
    "join_measurement": q_join_measurement,
    "asof_enriched": q_asof_enriched,
    "enriched_from_raw": q_enriched_from_raw,
    "streak_from_raw": q_streak_from_raw,
    "hop_window": q_hop_window,
    "recent_summary": q_recent_summary,
    "recent_summary_latest": q_recent_summary_latest,
    "recent_summary_view": q_recent_summary_view,
    "streak_agg": q_streak_agg,
    "low_humidity_streak": q_low_humidity_streak,
    "drought_summary": q_drought_summary,
    "drought_level": q_drought_level,
    "drought_streaks": q_drought_streaks,
    "latest_per_device": q_latest_per_device,
    "metrics_hour": _metrics_query("HOUR"),
    "metrics_day": _metrics_query("DAY"),
    "metrics_week": _metrics_query("WEEK"),
    "devices": q_devices,
    "recent_snapshots": q_recent_snapshots,
    "map_points": q_map_points,
    "view_ttl": q_view_ttl,
    "history_rows": q_history_rows,
    "latency_stats": q_latency_stats,
    "latency_runs": q_latency_runs,
    "lenient_decoders": q_lenient_decoders,
    "device_from_key": q_device_from_key,
    "device_metrics": q_device_metrics,
    "device_metrics_lookback": q_device_metrics_lookback,
    "history_scan": q_history_scan,
    "history_metrics": q_history_metrics,
    "device": q_device,
    "recent_summary_for": q_recent_summary_for,
    "recent_summary_from_history": q_recent_summary_from_history,
    "drought_summary_for": q_drought_summary_for,
    "match_key_pattern": q_match_key_pattern,
    "rekey_by_device": q_rekey_by_device,
    "stamp_seconds": q_stamp_seconds,
    "latency_by_run": q_latency_by_run,
    "stream_chain_replay": q_stream_chain_replay,
    "stream_latest_state": q_stream_latest_state,
    "stream_parse_errors": q_stream_parse_errors,
    "stream_measurement": q_stream_measurement,
    "stream_asof": q_stream_asof,
    "stream_summary": q_stream_summary,
    "stream_summary_late": q_stream_summary_late,
    "late_drop": q_late_drop,
    "stream_streak": q_stream_streak,
}
