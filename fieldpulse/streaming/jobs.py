"""The reference's streaming jobs as Structured Streaming queries.

  normalizer : raw feed -> typed readings per kind + dead letter      (foreachBatch, one write)
  measurement: humidity x temperature                                  (append, file sink)
  enrichment : measurement x location/state versions, as-of            (foreachBatch, fan-out sink)
  summary    : hop 10 s / 10 min per tenant, windows as they close     (foreachBatch, upsert sink)
  streak     : per-device streak, continuously updated                 (update, upsert sink)

Each builder returns the streaming DataFrame (testable on its own); ``start_*`` wires the
sink, trigger and checkpoint. Checkpoints live under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.constants import READING_WATERMARK
from fieldpulse.operators.measurement import join_measurement, with_event_ts
from fieldpulse.operators.normalize import parse_all
from fieldpulse.operators.streak import low_humidity_streak
from fieldpulse.schemas import ENRICHED, MEASUREMENT, PARSE_ERROR, RAW, TYPED
from fieldpulse.session import checkpoint_dir
from fieldpulse.sources.topics import route_by_topic
from fieldpulse.streaming import sinks
from fieldpulse.streaming.asof_state import AsofBatches, tagged_feeds
from fieldpulse.streaming.summary_state import SummaryBatches

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}  # the reference checkpoints every 10 s


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def _ckpt(spark: SparkSession, name: str, base: str | None) -> str:
    return f"{(base or checkpoint_dir(spark)).rstrip('/')}/streams/{name}"


# ---- sources ---------------------------------------------------------------------------------

def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, nested: bool = False) -> DataFrame:
    """Parquet files as they arrive; ``nested``: also those in folders below ``path``."""
    r = spark.readStream.schema(schema)
    if nested:
        r = r.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def typed_stream(spark: SparkSession, root: str, kind: str, **kw) -> DataFrame:
    """Typed readings written by the normalizer."""
    from pyspark.sql import types as T
    schema = T.StructType(TYPED[kind].fields + [T.StructField("env", T.StringType()), T.StructField("tenant", T.StringType())])
    return read_stream(spark, f"{root.rstrip('/')}/batch_id=*/kind={kind}/status=ok", schema, **kw)


# ---- normalizer ----------------------------------------------------------------------------

def normalizer_batch(out_root: str, ingest_ms: Column | None = None):
    """foreachBatch body: every line of the batch is parsed once and written once, in folders
    ``batch_id=<n>/kind=<kind>/status=ok|error``. Dead-letter rows keep their source topic; the
    constant record key of the reference's error topics is ``<kind>-parse-error``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sinks.write_batch(parse_all(route_by_topic(batch), ingest_ms=ingest_ms), out_root, batch_id, ("kind", "status"))
    return run


def read_parse_errors(spark: SparkSession, out_root: str) -> DataFrame:
    """The dead-letter table, with its record key."""
    rows = spark.read.option("basePath", out_root).parquet(f"{out_root.rstrip('/')}/batch_id=*/kind=*/status=error")
    return rows.select(*[f.name for f in PARSE_ERROR.fields], F.concat("kind", F.lit("-parse-error")).alias("key"))


def start_normalizer(spark: SparkSession, raw_path: str, out_root: str, trigger: dict | None = None,
                     ckpt_base: str | None = None, ingest_ms: Column | None = None, max_files: int | None = None,
                     nested: bool = False) -> StreamingQuery:
    raw = read_stream(spark, raw_path, RAW, max_files, nested)
    w = raw.writeStream.foreachBatch(normalizer_batch(out_root, ingest_ms)) \
        .option("checkpointLocation", _ckpt(spark, "normalizer", ckpt_base))
    return _trigger(w, trigger).start()


# ---- measurement (J1) --------------------------------------------------------------------------

def measurement_stream(humidity: DataFrame, temperature: DataFrame, watermark: str = READING_WATERMARK,
                       max_time_skew: str | None = None, processing_ms=None,
                       copies: str = "keep") -> DataFrame:
    """Stream-stream inner join on (env, tenant, device, seq).

    By default a regular join, as in the reference: no row is late, copies multiply, and the state
    grows with the readings. Production should give ``max_time_skew``: partners are then at most that
    far apart, the watermark (widened by the skew) lets Spark drop state, and readings later than
    that find no partner. ``copies="collapse"`` drops redelivered copies with
    ``dropDuplicatesWithinWatermark``; it needs the skew, whose watermark bounds its state too.
    """
    h, t = with_event_ts(humidity), with_event_ts(temperature)
    if not max_time_skew and humidity.isStreaming:
        warnings.warn("without max_time_skew the join keeps every reading as state, for ever", stacklevel=2)
    if max_time_skew:
        bound = f"{max_time_skew} {watermark}"  # an interval: the skew and the delay together
        h, t = h.withWatermark("event_ts", bound), t.withWatermark("event_ts", bound)
    if copies == "collapse":
        if not max_time_skew:
            raise ValueError("collapsing copies on a stream needs max_time_skew, which bounds its state")
        base = ["deviceId", "seq", "eventTime"] + (["env", "tenant"] if "env" in humidity.columns else [])
        h = h.dropDuplicatesWithinWatermark(base + ["humidity"])
        t = t.dropDuplicatesWithinWatermark(base + ["temperature"])
    return join_measurement(h, t, processing_ms=processing_ms, max_time_skew=max_time_skew, copies="keep")


def start_measurement(spark: SparkSession, typed_root: str, out_path: str, trigger: dict | None = None,
                      ckpt_base: str | None = None, **kw) -> StreamingQuery:
    m = measurement_stream(typed_stream(spark, typed_root, "humidity"),
                           typed_stream(spark, typed_root, "temperature"), **kw)
    w = (m.writeStream.format("parquet").outputMode("append").option("path", out_path)
         .option("checkpointLocation", _ckpt(spark, "measurement", ckpt_base)))
    return _trigger(w, trigger).start()


# ---- enrichment (J2/J3)

def start_enrichment(spark: SparkSession, measurement_path: str, typed_root: str, enriched_path: str,
                     history_path: str, state_path: str, trigger: dict | None = None,
                     ckpt_base: str | None = None, max_files: int | None = None, **kw) -> StreamingQuery:
    feeds = tagged_feeds(read_stream(spark, measurement_path, MEASUREMENT, max_files), typed_stream(spark, typed_root, "location"),
                         typed_stream(spark, typed_root, "state"))
    ckpt = _ckpt(spark, "enrichment", ckpt_base)
    body = AsofBatches(f"{ckpt}-tables", sinks.fanout_enriched(enriched_path, history_path, state_path), **kw)
    return _trigger(feeds.writeStream.foreachBatch(body).option("checkpointLocation", ckpt), trigger).start()


# ---- summary and streak ------------------------------------------------------------------------

def streak_stream(enriched: DataFrame, **kw) -> DataFrame:
    """Unwindowed per-device aggregate; run in update mode (state: one row per device)."""
    return low_humidity_streak(enriched, **kw)


def enriched_stream(spark: SparkSession, enriched_path: str, **kw) -> DataFrame:
    from pyspark.sql import types as T
    schema = T.StructType(ENRICHED.fields + [T.StructField("batch_id", T.LongType())])
    return read_stream(spark, enriched_path, schema, **kw).drop("batch_id")


def start_summary(spark: SparkSession, enriched_path: str, out_path: str, trigger: dict | None = None,
                  ckpt_base: str | None = None, max_files: int | None = None, merge_every: int = sinks.MERGE_EVERY,
                  ttl_seconds: int | None = None) -> StreamingQuery:
    """A batch may close several windows of a tenant; the view (``read_upsert_view(..., then="window_end")``) has
    the newest. Readings dropped for being late are in ``late`` beside the checkpoint (``summary_state.read_late``)."""
    e = enriched_stream(spark, enriched_path, max_files=max_files)
    ckpt = _ckpt(spark, "summary", ckpt_base)
    body = SummaryBatches(f"{ckpt}-tables", sinks.upsert_sink(out_path, compact_every=merge_every, ttl_seconds=ttl_seconds, then="window_end"))
    return _trigger(e.writeStream.foreachBatch(body).option("checkpointLocation", ckpt), trigger).start()


def start_streak(spark: SparkSession, enriched_path: str, out_path: str, trigger: dict | None = None,
                 ckpt_base: str | None = None, max_files: int | None = None, merge_every: int = sinks.MERGE_EVERY,
                 ttl_seconds: int | None = None) -> StreamingQuery:
    e = enriched_stream(spark, enriched_path, max_files=max_files)
    w = (streak_stream(e).writeStream.outputMode("update").foreachBatch(sinks.upsert_sink(out_path, compact_every=merge_every, ttl_seconds=ttl_seconds))
         .option("checkpointLocation", _ckpt(spark, "streak", ckpt_base)))
    return _trigger(w, trigger).start()
