"""Serving queries: what the reference's REST endpoints and web page answer, as DataFrames.

Every function takes the view it reads (latest-state view, latest-summary view, streak
view, history/enriched rows) plus request parameters. ``env``/``tenant`` = None means every
tenant (the fleet-wide batch form); given values become plain equality filters, which reach
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.constants import WINDOW_SECONDS
from fieldpulse.functions.clock import greatest_nonneg, range_back
from fieldpulse.operators.metrics import filter_device_range, latency_stats, metrics_by_bucket
from fieldpulse.operators.streak import drought_level, drought_summary
from fieldpulse.operators.summary import newest_window, one_window
from fieldpulse.schemas import RECENT_SUMMARY
from fieldpulse.sources.history import last_reading, scan_history


def _tenant_filter(df: DataFrame, env: str | None, tenant: str | None, tenant_col: str = "tenant") -> DataFrame:
    if env is not None:
        df = df.filter(F.col("env") == env)
    if tenant is not None:
        df = df.filter(F.col(tenant_col) == tenant)
    return df


def devices(state_view: DataFrame, env: str | None = None, tenant: str | None = None) -> DataFrame:
    """All device states of a tenant (13 fields of the device-state response)."""
    v = _tenant_filter(state_view, env, tenant)
    return v.select(
        F.col("device_id").alias("deviceId"), "env", F.col("tenant").alias("tenantId"),
        "lat", "lon", F.col("humidity").alias("h"), F.col("temperature").alias("t"),
        F.unix_millis("measurement_event_ts").alias("tsHt"),
        "rssi", "snr", F.col("battery").alias("bat"), "online",
        F.col("state_ingested_at").alias("tsState"))


def device(state_view: DataFrame, env: str, tenant: str, device_id: str) -> DataFrame:
    """0 or 1 row (the reference answers 404 when there is none)."""
    return devices(state_view, env, tenant).filter(F.col("deviceId") == device_id)


def recent_snapshots(state_view: DataFrame, env: str | None = None, tenant: str | None = None) -> DataFrame:
    """device, lastSeenTs = max(0, measurement time, state ingest, enrich time), readings."""
    v = _tenant_filter(state_view, env, tenant)
    return v.select(
        F.col("device_id").alias("deviceId"),
        greatest_nonneg(F.unix_millis("measurement_event_ts"), F.col("state_ingested_at"),
                        F.col("enriched_processing_ts_ms")).alias("lastSeenTs"),
        F.col("temperature").alias("t"), F.col("humidity").alias("h"), "online", "rssi", "snr",
        F.col("battery").alias("bat"))


def map_points(state_view: DataFrame, env: str | None = None, tenant: str | None = None) -> DataFrame:
    """Devices with a position; the marker is offline when ``online`` is false or null."""
    v = _tenant_filter(state_view, env, tenant).dropna(subset=["lat", "lon"])
    return v.select(
        F.col("device_id").alias("deviceId"), "lat", "lon",
        F.when(F.coalesce(F.col("online"), F.lit(False)), F.lit("online")).otherwise(F.lit("offline"))
        .alias("marker"))


def summary_response(latest_summary: DataFrame, env: str | None = None, tenant: str | None = None) -> DataFrame:
    """Fields of the recent-summary response, from the latest-summary view."""
    v = _tenant_filter(latest_summary, env, tenant, tenant_col="tenantId")
    return v.select(
        "env", "tenantId", F.lit(WINDOW_SECONDS).cast("int").alias("windowSeconds"),
        F.col("totalDevices").cast("int").alias("totalDevices"),
        F.col("onlineDevices").cast("int").alias("onlineDevices"),
        F.col("offlineDevices").cast("int").alias("offlineDevices"),
        "avgTemp", "avgHumidity")


def recent_summary_for(spark: SparkSession, latest_summary: DataFrame, env: str, tenant: str) -> DataFrame:
    """One row; when the tenant has no summary: zeros and null averages."""
    req = spark.createDataFrame([(env, tenant)], "env string, tenantId string")
    found = summary_response(latest_summary, env, tenant)
    j = req.join(found, ["env", "tenantId"], "left")
    return j.select(
        "env", "tenantId", F.lit(WINDOW_SECONDS).cast("int").alias("windowSeconds"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("totalDevices", "onlineDevices", "offlineDevices")],
        "avgTemp", "avgHumidity")


def drought_streaks(streaks: DataFrame, env: str | None = None, tenant: str | None = None) -> DataFrame:
    """Fields of the drought-streak response (times as epoch ms)."""
    v = _tenant_filter(streaks, env, tenant, tenant_col="tenantId")
    return v.select(
        "env", "tenantId", F.col("device_id").alias("deviceId"), "threshold",
        F.unix_millis("last_event_ts").alias("lastEventTs"),
        F.unix_millis("last_ok_event_ts").alias("lastOkEventTs"),
        F.col("streak_days").alias("streakDays"), F.col("last_humidity").alias("lastHumidity"))


def drought_streak(streaks: DataFrame, env: str, tenant: str, device_id: str) -> DataFrame:
    return drought_streaks(streaks, env, tenant).filter(F.col("deviceId") == device_id)


def drought_summary_for(spark: SparkSession, streaks: DataFrame, env: str, tenant: str) -> DataFrame:
    """One row with the drought level; no streak keys -> (null, 0, 0.0, null, 'ok')."""
    req = spark.createDataFrame([(env, tenant)], "env string, tenantId string")
    found = drought_summary(_tenant_filter(streaks, env, tenant, tenant_col="tenantId"))
    j = req.join(found, ["env", "tenantId"], "left").select(
        "env", "tenantId", "threshold",
        F.coalesce("devicesInDrought", F.lit(0)).alias("devicesInDrought"),
        F.coalesce("maxStreakDays", F.lit(0.0)).alias("maxStreakDays"), "maxDeviceId")
    return drought_level(j)


def metrics_range(bucket: str, from_s: int | None, to_s: int | None, as_of: Column | None = None):
    """(from, to) timestamps of a metrics request: the given range only when both ends are
    set and ``from < to``; otherwise the bucket's look-back (24 h / 30 d / 26 w) ending at
    ``as_of`` (default now)."""
    if from_s is not None and to_s is not None and from_s < to_s:
        return F.timestamp_seconds(F.lit(from_s)), F.timestamp_seconds(F.lit(to_s))
    hi = as_of if as_of is not None else F.current_timestamp()
    return range_back(hi, bucket), hi


def device_metrics(rows: DataFrame, env: str, tenant: str, device_id: str, bucket: str = "HOUR",
                   from_s: int | None = None, to_s: int | None = None,
                   as_of: Column | None = None) -> DataFrame:
    """Bucketed points ``(ts epoch s, tAvg, hAvg)`` of one device, ordered by time (range
    rules: :func:`metrics_range`)."""
    lo, hi = metrics_range(bucket, from_s, to_s, as_of)
    picked = filter_device_range(rows, env, tenant, device_id, lo, hi)
    return (metrics_by_bucket(picked, bucket, ordered=True)
            .select(F.unix_seconds("bucket").alias("ts"), "tAvg", "hAvg")
            .orderBy("ts"))


def device_metrics_from_history(spark: SparkSession, history_path: str, env: str, tenant: str,
                                device_id: str, bucket: str = "HOUR", from_s: int | None = None,
                                to_s: int | None = None, as_of: Column | None = None) -> DataFrame:
    """:func:`device_metrics` over the history table, reading only the date partitions of
    the range and pushing the device predicates into the Parquet scan."""
    lo, hi = metrics_range(bucket, from_s, to_s, as_of)
    rows = scan_history(spark, history_path, env, tenant, device_id, lo, hi)
    return device_metrics(rows, env, tenant, device_id, bucket, from_s, to_s, as_of)


def latency_by_run(history: DataFrame, prefix: str) -> DataFrame:
    """Latency statistics of one benchmark run (devices named ``<prefix>...``)."""
    return latency_stats(history, prefix=prefix).withColumn("prefix", F.lit(prefix))


def keys_like(view: DataFrame, pattern: str, key_col: str = "redis_key") -> DataFrame:
    """Rows whose key matches a SQL LIKE pattern, e.g. ``keys.state_key_pattern(env, tenant)``
    (a key scan ``<prefix>:<env>:<tenant>:device:*:state``)."""
    return view.filter(F.col(key_col).like(pattern))


def latency_runs(history: DataFrame, prefix_pattern: str = r"^([^-]+-)") -> DataFrame:
    """Latency statistics per benchmark run, the run being the device-id prefix captured by
    ``prefix_pattern`` (the load generator names devices ``cnt<N>-...``); one row per run
    with its device count, ordered by device count."""
    runs = history.withColumn("run", F.regexp_extract("device_id", prefix_pattern, 1))
    stats = latency_stats(runs, ("run",))
    devices = runs.groupBy("run").agg(F.countDistinct("device_id").alias("devices"))
    return stats.join(devices, "run").orderBy("devices", "run")


def recent_summary_from_rows(spark: SparkSession, enriched: DataFrame, env: str, tenant: str) -> DataFrame:
    """The recent-summary response straight from enriched rows: only the tenant's newest
    window closed by the (global) watermark is aggregated, not every window."""
    from fieldpulse.operators.summary import latest_closed_summary
    return recent_summary_for(spark, latest_closed_summary(enriched), env, tenant)


def recent_summary_from_history(spark: SparkSession, history_path: str, env: str, tenant: str) -> DataFrame:
    """The recent-summary response from the history table. The watermark comes from the newest date alone and
    the tenant's last reading before it from the newest dates that have one; its window is then aggregated
    from the one or two dates it lies in."""
    newest = last_reading(spark, history_path)
    bounds = None if newest is None else newest_window(newest, lambda cutoff: last_reading(spark, history_path, cutoff, env, tenant))
    if bounds is None:
        return recent_summary_for(spark, spark.createDataFrame([], RECENT_SUMMARY), env, tenant)
    rows = scan_history(spark, history_path, env, tenant, None, *(F.timestamp_micros(F.lit(b)) for b in bounds))
    return recent_summary_for(spark, one_window(rows, *bounds), env, tenant)
