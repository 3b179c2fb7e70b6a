"""Sliding-window fleet summary (HOP 10 s / 10 min) per (env, tenant).

Three equivalent plans (tests check they agree):

* ``direct``    – ``window()`` expands every row into 60 windows, then three
  ``count_distinct`` (Catalyst plans an Expand over them).
* ``two_stage`` – expand, aggregate per (window, device), then per window.
* ``panes``     – default, see :func:`recent_summary_panes`: measures are aggregated per
  (tenant, 10-second pane) and expanded to windows; distinct devices are counted once per
  window at the device's *first* pane in it (bounds from the previous pane, found inside
  small (device, pane-bucket) partitions), so there is no (window, device) aggregate. All
  aggregates combine map-side, so hot tenants/devices are reduced before any shuffle.

Averages are carried as (sum, non-null count) so the pane plan is exact up to float
summation order; distinct device counts are exact; a device seen both online and offline in
a window counts in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.constants import SLIDE_SECONDS, WINDOW_SECONDS
from fieldpulse.functions.keys import build_key_summary
from fieldpulse.schemas import RECENT_SUMMARY_COLUMNS

TS = "measurement_event_ts"


def _online() -> "F.Column":
    return F.coalesce(F.col("online"), F.lit(False))


def finish_summary(df: DataFrame, window_seconds: int) -> DataFrame:
    return df.select(
        build_key_summary(F.col("env"), F.col("tenant")).alias("redis_key"),
        "env", F.col("tenant").alias("tenantId"),
        "window_start", "window_end",
        F.lit(window_seconds).cast("long").alias("windowSeconds"),
        "totalDevices", "onlineDevices", "offlineDevices", "avgTemp", "avgHumidity",
        "minEventTs", "maxEventTs",
        "minMeasurementProcessingTsMs", "maxMeasurementProcessingTsMs",
        "minEnrichedProcessingTsMs", "maxEnrichedProcessingTsMs",
    ).select(*RECENT_SUMMARY_COLUMNS)


def _window(col: str, window_seconds: int, slide_seconds: int):
    return F.window(col, f"{window_seconds} seconds", f"{slide_seconds} seconds")


def recent_summary_direct(enriched: DataFrame, window_seconds: int = WINDOW_SECONDS,
                          slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    agg = (enriched.groupBy("env", "tenant", _window(TS, window_seconds, slide_seconds).alias("w"))
           .agg(F.count_distinct("device_id").alias("totalDevices"),
                F.count_distinct(F.when(_online(), F.col("device_id"))).alias("onlineDevices"),
                F.count_distinct(F.when(~_online(), F.col("device_id"))).alias("offlineDevices"),
                F.avg("temperature").alias("avgTemp"),
                F.avg("humidity").alias("avgHumidity"),
                F.min(TS).alias("minEventTs"), F.max(TS).alias("maxEventTs"),
                F.min("measurement_processing_ts_ms").alias("minMeasurementProcessingTsMs"),
                F.max("measurement_processing_ts_ms").alias("maxMeasurementProcessingTsMs"),
                F.min("enriched_processing_ts_ms").alias("minEnrichedProcessingTsMs"),
                F.max("enriched_processing_ts_ms").alias("maxEnrichedProcessingTsMs"))
           .select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")))
    return finish_summary(agg, window_seconds)


# Per-(…, device) partial state: any-online, any-offline, (sum, count) per average, min/max.
def device_partials(df: DataFrame, keys: list, first_level: bool) -> DataFrame:
    if first_level:
        aggs = [F.max(_online().cast("int")).alias("on"), F.max((~_online()).cast("int")).alias("off"),
                F.sum("temperature").alias("t_sum"), F.count("temperature").alias("t_cnt"),
                F.sum("humidity").alias("h_sum"), F.count("humidity").alias("h_cnt"),
                F.min(TS).alias("ts_min"), F.max(TS).alias("ts_max"),
                F.min("measurement_processing_ts_ms").alias("mp_min"),
                F.max("measurement_processing_ts_ms").alias("mp_max"),
                F.min("enriched_processing_ts_ms").alias("ep_min"),
                F.max("enriched_processing_ts_ms").alias("ep_max")]
    else:
        aggs = [F.max("on").alias("on"), F.max("off").alias("off"),
                F.sum("t_sum").alias("t_sum"), F.sum("t_cnt").alias("t_cnt"),
                F.sum("h_sum").alias("h_sum"), F.sum("h_cnt").alias("h_cnt"),
                F.min("ts_min").alias("ts_min"), F.max("ts_max").alias("ts_max"),
                F.min("mp_min").alias("mp_min"), F.max("mp_max").alias("mp_max"),
                F.min("ep_min").alias("ep_min"), F.max("ep_max").alias("ep_max")]
    return df.groupBy(*keys).agg(*aggs)


def window_totals(per_device: DataFrame) -> DataFrame:
    return per_device.groupBy("env", "tenant", "window_start", "window_end").agg(
        F.count("*").alias("totalDevices"),
        F.count_if(F.col("on") == 1).alias("onlineDevices"),
        F.count_if(F.col("off") == 1).alias("offlineDevices"),
        (F.sum("t_sum") / F.sum("t_cnt")).alias("avgTemp"),
        (F.sum("h_sum") / F.sum("h_cnt")).alias("avgHumidity"),
        F.min("ts_min").alias("minEventTs"), F.max("ts_max").alias("maxEventTs"),
        F.min("mp_min").alias("minMeasurementProcessingTsMs"),
        F.max("mp_max").alias("maxMeasurementProcessingTsMs"),
        F.min("ep_min").alias("minEnrichedProcessingTsMs"),
        F.max("ep_max").alias("maxEnrichedProcessingTsMs"))


def recent_summary_two_stage(enriched: DataFrame, window_seconds: int = WINDOW_SECONDS,
                             slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    w = enriched.withColumn("w", _window(TS, window_seconds, slide_seconds)) \
        .withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end"))
    per_device = device_partials(w, ["env", "tenant", "window_start", "window_end", "device_id"], True)
    return finish_summary(window_totals(per_device), window_seconds)


def recent_summary_panes(enriched: DataFrame, window_seconds: int = WINDOW_SECONDS,
                         slide_seconds: int = SLIDE_SECONDS, bucket_panes: int = 360) -> DataFrame:
    """Pane plan: no (window, device) aggregate at all.

    Time is cut into panes of one slide (10 s); window ``w`` (indexed by its first pane)
    covers panes ``w .. w+K-1`` (K = window / slide = 60).

    * Averages, min and max: aggregate per (tenant, pane) – devices collapse here – then
      expand each tenant-pane into its K windows.
    * Distinct devices: a device is counted in window ``w`` at its *first* pane inside it.
      Pane ``p`` is that first pane exactly for ``w`` in ``[max(prev+1, p-K+1), p]``, where
      ``prev`` is the device's previous pane with data (previous *online* / *offline* pane
      for the other two counts). ``prev`` comes from ``lag`` inside (device, pane-bucket)
      partitions of ``bucket_panes`` panes; rows in the last K-1 panes of a bucket are also
      copied into the next bucket as look-behind, so no partition ever holds more than one
      bucket of one device (a hot device is spread over its buckets).
    * One final hash aggregate per (tenant, window) over both row sets.

    At one reading per device and second a continuously reporting device adds ~1 row per
    pane instead of K, and the measures collapse to one row per tenant and pane.
    """
    if window_seconds % slide_seconds:
        return recent_summary_two_stage(enriched, window_seconds, slide_seconds)
    return windows_of_panes(pane_measures(enriched, slide_seconds), pane_devices(enriched, slide_seconds),
                            window_seconds, slide_seconds, bucket_panes)


def pane_of(ts: str, slide_seconds: int):
    return F.floor(F.unix_micros(ts) / F.lit(slide_seconds * 1_000_000))


_MEASURES = {"t_sum": F.sum, "t_cnt": F.sum, "h_sum": F.sum, "h_cnt": F.sum, "ts_min": F.min, "ts_max": F.max, "mp_min": F.min, "mp_max": F.max,
             "ep_min": F.min, "ep_max": F.max}


def pane_measures(enriched: DataFrame, slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """Sums, counts, least and greatest of the measures per (env, tenant, pane ``_p``)."""
    return enriched.groupBy("env", "tenant", pane_of(TS, slide_seconds).alias("_p")).agg(
        F.sum("temperature").alias("t_sum"), F.count("temperature").alias("t_cnt"),
        F.sum("humidity").alias("h_sum"), F.count("humidity").alias("h_cnt"),
        F.min(TS).alias("ts_min"), F.max(TS).alias("ts_max"),
        F.min("measurement_processing_ts_ms").alias("mp_min"),
        F.max("measurement_processing_ts_ms").alias("mp_max"),
        F.min("enriched_processing_ts_ms").alias("ep_min"),
        F.max("enriched_processing_ts_ms").alias("ep_max"))


def pane_devices(enriched: DataFrame, slide_seconds: int = SLIDE_SECONDS) -> DataFrame:
    """Device presence per (env, tenant, device, pane ``_p``): any online (``on``), any offline (``off``)."""
    return enriched.groupBy("env", "tenant", "device_id", pane_of(TS, slide_seconds).alias("_p")).agg(
        F.max(_online().cast("int")).alias("on"), F.max((~_online()).cast("int")).alias("off"))


def add_measures(parts: DataFrame) -> DataFrame:
    """Several tables of :func:`pane_measures` in one, added up."""
    return parts.groupBy("env", "tenant", "_p").agg(*[f(c).alias(c) for c, f in _MEASURES.items()])


def add_devices(parts: DataFrame) -> DataFrame:
    return parts.groupBy("env", "tenant", "device_id", "_p").agg(F.max("on").alias("on"), F.max("off").alias("off"))


def windows_of_panes(panes: DataFrame, dev: DataFrame, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                     bucket_panes: int = 360) -> DataFrame:
    """The windows over tables of :func:`pane_measures` and :func:`pane_devices`, as
    :func:`recent_summary_panes` describes."""
    k = window_seconds // slide_seconds
    bucket_panes = max(bucket_panes, k)
    slide_us = slide_seconds * 1_000_000
    # measures, expanded to the K windows containing the pane
    measures = panes.select("*", F.explode(F.sequence(F.col("_p") - (k - 1), F.col("_p"))).alias("_w")).drop("_p")
    dev = dev.withColumn("_b", F.floor(F.col("_p") / F.lit(bucket_panes)))
    ghosts = (dev.filter(F.col("_p") - F.col("_b") * bucket_panes >= bucket_panes - (k - 1))
              .withColumn("_b", F.col("_b") + 1).withColumn("_ghost", F.lit(True)))
    rows = dev.withColumn("_ghost", F.lit(False)).unionByName(ghosts)
    w = (Window.partitionBy("env", "tenant", "device_id", "_b").orderBy("_p")
         .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "*",
        F.max("_p").over(w).alias("_prev"),
        F.max(F.when(F.col("on") == 1, F.col("_p"))).over(w).alias("_prev_on"),
        F.max(F.when(F.col("off") == 1, F.col("_p"))).over(w).alias("_prev_off"),
    ).filter(~F.col("_ghost"))
    floor_w = F.col("_p") - (k - 1)
    lo_all = F.greatest(floor_w, F.coalesce(F.col("_prev") + 1, floor_w))
    lo_on = F.when(F.col("on") == 1, F.greatest(floor_w, F.coalesce(F.col("_prev_on") + 1, floor_w)))
    lo_off = F.when(F.col("off") == 1, F.greatest(floor_w, F.coalesce(F.col("_prev_off") + 1, floor_w)))
    # the previous online/offline pane can be older than the previous pane of any kind, so
    # ranges can start earlier. A device enters each count at the range's first window and leaves them behind
    # pane ``_p``: entries and leavings are added up per window, then along the windows of a bucket. A range that
    # began in the bucket before enters anew where its own bucket begins; what lasts to the end needs no leaving.
    on, off = F.col("_lo_on").isNotNull().cast("int"), F.col("_lo_off").isNotNull().cast("int")
    begin = F.col("_b") * bucket_panes

    def move(window, c_all, c_on, c_off):
        return F.struct(window.alias("_w"), *[F.coalesce(c, F.lit(0)).alias(n) for c, n in ((c_all, "c_all"), (c_on, "c_on"), (c_off, "c_off"))])

    one, none = F.lit(1), F.lit(0)
    bounds = {"_lo": (one, none, none), "_lo_on": (none, one, none), "_lo_off": (none, none, one)}
    moves = (rows.select("env", "tenant", "_p", "_b", lo_all.alias("_lo"), lo_on.alias("_lo_on"), lo_off.alias("_lo_off"))
             .filter(F.col("_p").isNotNull())
             .select("env", "tenant", F.explode(F.array(
                 *[F.when(F.col(lo).isNotNull(), move(F.col(lo), *c)) for lo, c in bounds.items()],
                 F.when(F.least(*bounds) < begin, move(begin, *[(F.col(lo) < begin).cast("int") for lo in bounds])),
                 F.when(F.col("_p") + 1 < begin + bucket_panes, move(F.col("_p") + 1, F.lit(-1), -on, -off)))).alias("_m"))
             .filter(F.col("_m").isNotNull()).select("env", "tenant", "_m.*"))

    both = moves.unionByName(measures, allowMissingColumns=True)
    totals = both.groupBy("env", "tenant", "_w").agg(
        *[F.sum(c).alias(c) for c in ("c_all", "c_on", "c_off")],
        (F.sum("t_sum") / F.sum("t_cnt")).alias("avgTemp"),
        (F.sum("h_sum") / F.sum("h_cnt")).alias("avgHumidity"),
        F.min("ts_min").alias("minEventTs"), F.max("ts_max").alias("maxEventTs"),
        F.min("mp_min").alias("minMeasurementProcessingTsMs"),
        F.max("mp_max").alias("maxMeasurementProcessingTsMs"),
        F.min("ep_min").alias("minEnrichedProcessingTsMs"),
        F.max("ep_max").alias("maxEnrichedProcessingTsMs"))
    along = (Window.partitionBy("env", "tenant", F.floor(F.col("_w") / F.lit(bucket_panes))).orderBy("_w")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = totals.select("*", *[F.coalesce(F.sum(c).over(along), F.lit(0)).cast("long").alias(n) for c, n in (
        ("c_all", "totalDevices"), ("c_on", "onlineDevices"), ("c_off", "offlineDevices"))]).filter(F.col("minEventTs").isNotNull())
    start = F.timestamp_micros(F.col("_w") * F.lit(slide_us))
    return finish_summary(totals.withColumn("window_start", start)
                   .withColumn("window_end", start + F.expr(f"INTERVAL {window_seconds} SECONDS")),
                   window_seconds)


def recent_summary(enriched: DataFrame, window_seconds: int = WINDOW_SECONDS,
                   slide_seconds: int = SLIDE_SECONDS, method: str = "panes") -> DataFrame:
    fn = {"direct": recent_summary_direct, "two_stage": recent_summary_two_stage,
          "panes": recent_summary_panes}[method]
    return fn(enriched, window_seconds, slide_seconds)


def closed_windows(summary: DataFrame, enriched: DataFrame, watermark_seconds: int = 5) -> DataFrame:
    """The windows a streaming run has emitted by the end of its input: those the watermark
    (max event time - delay) has passed, ``window_end <= max(ts) - delay``. The max is a
    scalar subquery, evaluated once – no join."""
    cutoff = enriched.agg(F.max(TS)).scalar() - F.expr(f"INTERVAL {int(watermark_seconds)} SECONDS")
    return summary.filter(F.col("window_end") <= cutoff)


def latest_summary(summary: DataFrame, enriched: DataFrame | None = None,
                   watermark_seconds: int = 5) -> DataFrame:
    """What the upsert sink holds: per summary key, the newest window (largest window_end)
    replaces the older ones. Given ``enriched``, only windows the watermark has closed count
    (the sink never sees a window before it closes). One aggregate (max_by), no sort."""
    if enriched is not None:
        summary = closed_windows(summary, enriched, watermark_seconds)
    return (summary.groupBy("redis_key")
            .agg(F.max_by(F.struct(*RECENT_SUMMARY_COLUMNS), F.col("window_end")).alias("r"))
            .select("r.*"))


def latest_closed_summary(enriched: DataFrame, window_seconds: int = WINDOW_SECONDS,
                          slide_seconds: int = SLIDE_SECONDS, watermark_seconds: int = 5) -> DataFrame:
    """The same result as ``latest_summary(recent_summary(e), e)`` without computing every
    window: per tenant only its newest closed window is aggregated.

    With ``C`` = the watermark cutoff (max ts - delay) aligned down to the slide, a reading at
    ``t`` lies in windows ending in ``(t, t + size]``; the newest closed one of a tenant ends
    at ``min(C, align(t_last + size))`` for its last reading ``t_last`` before ``C``. That
    one window's rows are then aggregated directly (one group per tenant).
    """
    slide_us, size_us = slide_seconds * 1_000_000, window_seconds * 1_000_000
    cutoff = enriched.agg(F.max(TS)).scalar() - F.expr(f"INTERVAL {int(watermark_seconds)} SECONDS")
    c_us = F.floor(F.unix_micros(cutoff) / F.lit(slide_us)) * F.lit(slide_us)
    # bare timestamps against constants, so both bounds reach the scan (and, on the history table,
    # its date folders: a row before the newest window of the slowest tenant is still looked for)
    last = (enriched.filter(F.col(TS) < F.timestamp_micros(c_us))
            .groupBy("env", "tenant").agg(F.max(TS).alias("_last")))
    end_us = F.least(c_us, F.floor((F.unix_micros("_last") + F.lit(size_us)) / F.lit(slide_us)) * F.lit(slide_us))
    win = last.select("env", "tenant", (end_us - F.lit(size_us)).alias("_ws"), end_us.alias("_we"))
    rows = (enriched.join(win, ["env", "tenant"])
            .filter((F.col(TS) >= F.timestamp_micros("_ws")) & (F.col(TS) < F.timestamp_micros("_we"))))
    per_device = device_partials(rows, ["env", "tenant", "_ws", "_we", "device_id"], True)
    totals = window_totals(per_device.withColumn("window_start", F.timestamp_micros("_ws"))
                           .withColumn("window_end", F.timestamp_micros("_we")))
    return finish_summary(totals, window_seconds)


def newest_window(newest_us: int, last_before, window_seconds: int = WINDOW_SECONDS, slide_seconds: int = SLIDE_SECONDS,
                  watermark_seconds: int = 5) -> tuple[int, int] | None:
    """Start and end (microseconds) of a tenant's newest closed window. ``newest_us``: the newest event time of all;
    ``last_before(cutoff)``: the tenant's last event time before the watermark, aligned down to the slide."""
    second = 1_000_000
    slide, size = slide_seconds * second, window_seconds * second
    cutoff = (newest_us - watermark_seconds * second) // slide * slide
    last = last_before(cutoff)
    if last is None:
        return None
    end = min(cutoff, (last + size) // slide * slide)
    return end - size, end


def one_window(rows: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """The summary of the readings of one window."""
    start, end = (F.timestamp_micros(F.lit(x)) for x in (start_us, end_us))
    inside = rows.filter((F.col(TS) >= start) & (F.col(TS) < end)).withColumn("window_start", start).withColumn("window_end", end)
    per_device = device_partials(inside, ["env", "tenant", "window_start", "window_end", "device_id"], True)
    return finish_summary(window_totals(per_device), (end_us - start_us) // 1_000_000)
