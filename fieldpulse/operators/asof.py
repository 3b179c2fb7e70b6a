"""J2/J3: as-of (temporal LEFT) join of measurements with versioned device dimensions.

Semantics: for each measurement, the latest location version and the latest state version of
the same device with ``version.event_ts <= measurement_event_ts`` (inclusive); null when there
is none. Versions at the same instant: the later-ingested one wins (upsert order).

Plan (no pairs are ever formed, and no device's history has to fit in one task):

1. Measurements are counted per ``(key, time bucket)`` (default one hour); the counts and the versions, cut
   to key, time and payload, give each bucket's count and each dimension's last version in it.
2. One window over a key's buckets gives what each bucket inherits from earlier ones. This table is
   small next to the readings (one row per key and bucket; widen the bucket for sparse fleets).
3. Measurements, versions and what buckets inherit (as versions before all others of the bucket) are
   shuffled once, whole, on ``(key, bucket, salt)`` and read in time order: the last version seen. A bucket
   above ``max_rows_per_bucket`` measurements is salted: its measurements are spread, its versions copied
   to each salt. The list of such buckets is broadcast (one entry for each ``max_rows_per_bucket``
   measurements at most), so the rows don't move for it.

The key is (env, tenant, device): devices of different tenants never meet. Sorts begin with a number, which
Spark compares by itself; texts, of which many begin alike, are compared only where it is equal.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.constants import KEY_PREFIX
from fieldpulse.functions.clock import now_ms
from fieldpulse.functions.keys import build_key_state
from fieldpulse.operators.measurement import MEASUREMENT_COLUMNS, tenancy, with_event_ts
from fieldpulse.schemas import ENRICHED_COLUMNS

LOCATION_FIELDS = ["eventTime", "ingestedAt", "lat", "lon"]
STATE_FIELDS = ["eventTime", "ingestedAt", "rssi", "snr", "battery", "online"]


def asof_latest(events: DataFrame, versions: dict[str, tuple[DataFrame, list[str]]],
                keys: list[str], ts: str, bucket_seconds: int = 3600,
                max_rows_per_bucket: int = 4_000_000) -> DataFrame:
    """Generic backward, inclusive as-of lookup.

    ``events``: rows with the ``keys`` and ``ts`` columns (kept whole, in a struct). They are read
    twice (key and time alone the first time), so hand in a table rather than a long plan.
    ``versions``: name -> (DataFrame with the same key columns, ``event_ts``, ``ingestedAt`` and the
    payload ``fields``); read twice too.
    Returns ``events``' columns plus one struct column per version name (null if none).
    """
    names = list(versions)
    own = events.select(F.struct(*events.columns).alias("e")).schema["e"].dataType
    payload = {n: versions[n][0].select(F.struct(*versions[n][1]).alias("s")).schema["s"].dataType for n in names}
    k = [f"_k{i}" for i in range(len(keys))]
    nothing = {"_ts": events.schema[ts].dataType, "_ord": "long", "_e": own, **payload}

    def null(c: str):
        return F.lit(None).cast(nothing[c]).alias(c)

    def keyed(df: DataFrame, time: str):
        bucket = F.floor(F.unix_millis(time) / F.lit(bucket_seconds * 1000))
        return [F.col(c).alias(a) for c, a in zip(keys, k)] + [F.col(time).alias("_ts"), bucket.alias("_b")]

    def union(parts) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    def version_rows(*extra: Column) -> list[DataFrame]:
        return [df.filter(F.col("event_ts").isNotNull()).select(
            *keyed(df, "event_ts"), F.col("ingestedAt").cast("long").alias("_ord"), *extra,
            *[F.struct(*fields).alias(m) if m == n else null(m) for m in names]) for n, (df, fields) in versions.items()]

    # 1-2. per key and bucket: measurements, last versions, and what earlier buckets left
    by_bucket = ["_b", *reversed(k)]
    counts = events.select(*keyed(events, ts)).groupBy(*by_bucket).agg(F.count(F.lit(1)).alias("_n"))
    parts = union([counts.select(*k, "_b", null("_ts"), null("_ord"), "_n", *[null(n) for n in names]),
                   *version_rows(F.lit(0).cast("long").alias("_n"))])
    per_bucket = parts.groupBy(*by_bucket).agg(
        F.sum("_n").alias("_n"), *[F.max_by(n, F.when(F.col(n).isNotNull(), F.struct("_ts", "_ord"))).alias(n) for n in names])
    earlier = Window.partitionBy("_h", *k).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(max_rows_per_bucket))).cast("int")
    inherited = (per_bucket.withColumn("_h", F.xxhash64(*k))
                 .select(*k, "_b", "_n", *[F.last(n, ignorenulls=True).over(earlier).alias(n) for n in names])
                 .filter(F.col("_n") > 0).filter(reduce(Column.__or__, [F.col(n).isNotNull() for n in names]))
                 .select(*k, "_b", null("_ts"), F.lit(-1).alias("_kind"), null("_ord"), null("_e"), *names,
                         F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")))

    # 3. the rows themselves; buckets that need no salt are absent from ``hot``
    hot = counts.filter(F.col("_n") > max_rows_per_bucket).select(*k, "_b", salts.alias("_salts"))
    n_salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = (F.when(F.col("_kind") == 1, F.array(F.pmod(F.xxhash64("_e", "_ts"), n_salts).cast("int")))
              .otherwise(F.sequence(F.lit(0), n_salts - 1)))
    rows = union([events.select(*keyed(events, ts), F.lit(1).alias("_kind"), null("_ord"), F.struct(*events.columns).alias("_e"),
                                *[null(n) for n in names]),
                  *version_rows(F.lit(0).alias("_kind"), null("_e"))])
    rows = rows.join(F.broadcast(hot), [*k, "_b"], "left").withColumn("_salt", F.explode(spread)).drop("_salts")
    rows = rows.unionByName(inherited).repartition(*k, "_b", "_salt").withColumn("_h", F.xxhash64(*k, "_b", "_salt"))
    so_far = (Window.partitionBy("_h", *k, "_b", "_salt").orderBy("_ts", "_kind", "_ord")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.select("_kind", "_e", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names])
            .filter(F.col("_kind") == 1).select("_e.*", *names))


def asof_enrich(measurement: DataFrame, location: DataFrame, state: DataFrame,
                enrich_ms: Column | Callable[[], Column] | None = None,
                key_prefix: str = KEY_PREFIX, bucket_seconds: int = 3600,
                max_rows_per_bucket: int = 4_000_000) -> DataFrame:
    """Measurement -> enriched rows (25 columns, the reference's order)."""
    m = measurement.select(*MEASUREMENT_COLUMNS)

    def dim(df: DataFrame) -> DataFrame:
        return tenancy(with_event_ts(df)).withColumnRenamed("deviceId", "device_id")

    joined = asof_latest(m, {"l": (dim(location), LOCATION_FIELDS), "s": (dim(state), STATE_FIELDS)},
                         keys=["env", "tenant", "device_id"], ts="measurement_event_ts", bucket_seconds=bucket_seconds,
                         max_rows_per_bucket=max_rows_per_bucket)
    enriched = joined.select(
        "device_id", "env", "tenant",
        F.col("l.lat").alias("lat"), F.col("l.lon").alias("lon"),
        "humidity", "temperature", "humidity_seq", "temperature_seq",
        "humidity_event_time", "temperature_event_time",
        F.col("s.eventTime").alias("state_event_time"),
        F.col("l.eventTime").alias("location_event_time"),
        "humidity_ingested_at", "temperature_ingested_at",
        F.col("s.ingestedAt").alias("state_ingested_at"),
        F.col("l.ingestedAt").alias("location_ingested_at"),
        "measurement_event_ts", "measurement_processing_ts_ms",
        F.col("s.rssi").alias("rssi"), F.col("s.snr").alias("snr"),
        F.col("s.battery").alias("battery"), F.col("s.online").alias("online"),
    )
    stamp = enrich_ms() if callable(enrich_ms) else enrich_ms
    enriched = enriched.withColumn("enriched_processing_ts_ms",
                                   (stamp if stamp is not None else now_ms()).cast("long"))
    enriched = enriched.withColumn(
        "redis_key", build_key_state(F.col("env"), F.col("tenant"), F.col("device_id"), key_prefix))
    return enriched.select(*ENRICHED_COLUMNS)
