"""J1: pair humidity and temperature readings of the same device and sequence number."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.constants import DEFAULT_ENV, DEFAULT_TENANT
from fieldpulse.functions.clock import now_ms
from fieldpulse.functions.parsing import event_time
from fieldpulse.schemas import MEASUREMENT

MEASUREMENT_COLUMNS = [f.name for f in MEASUREMENT.fields]


def with_event_ts(df: DataFrame) -> DataFrame:
    """Add ``event_ts`` from ``eventTime`` unless the parser already produced it."""
    return df if "event_ts" in df.columns else df.withColumn("event_ts", event_time(F.col("eventTime")))


def tenancy(df: DataFrame, env: str = DEFAULT_ENV, tenant: str = DEFAULT_TENANT) -> DataFrame:
    """``env`` and ``tenant`` columns, with defaults where they are missing or null."""
    if "env" not in df.columns:
        return df.withColumn("env", F.lit(env)).withColumn("tenant", F.lit(tenant))
    return (df.withColumn("env", F.coalesce("env", F.lit(env)))
              .withColumn("tenant", F.coalesce("tenant", F.lit(tenant))))


def collapse_copies(readings: DataFrame, value_col: str) -> DataFrame:
    """One row per distinct reading (env, tenant, device, seq, event time, value): repeated
    deliveries of the same message collapse, keeping the first ingestion. A hash aggregate
    with map-side combine, so a group of copies is reduced before it is shuffled."""
    keys = ["env", "tenant", "deviceId", "seq", "eventTime", value_col]
    return readings.groupBy(*keys).agg(F.min("ingestedAt").alias("ingestedAt"),
                                       F.min("sourceTopic").alias("sourceTopic"))


def join_measurement(humidity: DataFrame, temperature: DataFrame,
                     processing_ms: Column | Callable[[], Column] | None = None,
                     env: str = DEFAULT_ENV, tenant: str = DEFAULT_TENANT,
                     max_time_skew: str | None = None, copies: str = "keep") -> DataFrame:
    """Inner equi-join on (env, tenant, deviceId, seq); event time is the humidity reading's.

    Distinct readings that share (device, seq) – a counter restart – pair up as in the
    reference, and copies of a message multiply. ``copies="collapse"`` first makes one row of
    exact copies (redeliveries), for feeds that deliver at least once. ``max_time_skew`` (e.g. ``'1 hour'``) adds ``|t.event_ts - h.event_ts| <= skew`` – off
    by default for equivalence; on a stream it is what lets the state be dropped.

    Scale: both sides shuffle once on the four key columns (seq makes the key nearly unique,
    so a busy device is spread over all partitions; a repeated key is split by AQE's skew-join
    handling). Collapsing adds one aggregate a side, whose map-side combine reduces a group of
    copies before it is shuffled.
    """
    h, t = tenancy(humidity, env, tenant), tenancy(temperature, env, tenant)
    if copies == "collapse":
        h, t = collapse_copies(h, "humidity"), collapse_copies(t, "temperature")
    h = with_event_ts(h).alias("h")
    t = with_event_ts(t).alias("t")
    keys = ["env", "tenant", "deviceId", "seq"]
    if not (humidity.isStreaming or temperature.isStreaming):  # a stream's state keeps its key order
        keys.reverse()  # sorted by a number first, which is nearly unique
    cond = [F.col(f"h.{c}") == F.col(f"t.{c}") for c in keys]
    if max_time_skew:
        skew = F.expr(f"INTERVAL {max_time_skew}")
        cond.append(F.col("t.event_ts").between(F.col("h.event_ts") - skew, F.col("h.event_ts") + skew))
    joined = h.join(t, cond, "inner").select(
        F.col("h.deviceId").alias("device_id"),
        F.col("h.env").alias("env"),
        F.col("h.tenant").alias("tenant"),
        F.col("h.humidity").alias("humidity"),
        F.col("t.temperature").alias("temperature"),
        F.col("h.seq").alias("humidity_seq"),
        F.col("t.seq").alias("temperature_seq"),
        F.col("h.eventTime").alias("humidity_event_time"),
        F.col("t.eventTime").alias("temperature_event_time"),
        F.col("h.ingestedAt").alias("humidity_ingested_at"),
        F.col("t.ingestedAt").alias("temperature_ingested_at"),
        F.col("h.event_ts").alias("measurement_event_ts"),
    )
    stamp = processing_ms() if callable(processing_ms) else processing_ms
    return joined.withColumn("measurement_processing_ts_ms",
                             (stamp if stamp is not None else now_ms()).cast("long"))
