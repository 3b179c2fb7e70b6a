"""Replay fixture tables through the streaming jobs.

Used by the registered ``stream_*`` queries and by tests. Inputs are cut by event time into slices, which
arrive out of order (``ARRIVAL``), one slice a micro-batch, so state, late rows and updates are all at work;
the stream is stopped half way and resumed from its checkpoint. All slices of a table are written by one
parallel job; a slice arrives when its folder is moved to where the stream looks. The sink's content is
returned as a batch DataFrame. Every slice has to make a micro-batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.operators.measurement import tenancy, with_event_ts
from fieldpulse.plans import flow
from fieldpulse.schemas import ENRICHED, MEASUREMENT
from fieldpulse.session import checkpoint_dir
from fieldpulse.sources import fixtures as FX
from fieldpulse.sources.history import read_history
from fieldpulse.streaming import jobs
from fieldpulse.streaming.asof_state import AsofBatches, tagged_feeds
from fieldpulse.streaming.summary_state import SummaryBatches, read_late
from fieldpulse.streaming.sinks import fanout_enriched, make_folder, move, read_upsert_view, upsert_sink, write_batch

ONCE = {"availableNow": True}
AT_ONCE = {"processingTime": "0 seconds"}
ARRIVAL = (0, 2, 1, 4, 3, 5)
IN_ORDER = tuple(range(len(ARRIVAL)))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/replay/{name}-{uuid.uuid4().hex[:12]}"


def slice_bounds(df: DataFrame, ts_col: str, slices: int = len(ARRIVAL)) -> list:
    """Event times that cut ``df`` into equal stretches of time."""
    lo, hi = df.agg(F.min(ts_col), F.max(ts_col)).first()
    return [] if lo is None else [lo + (hi - lo) / slices * i for i in range(1, slices)]


def slice_number(ts_col: str, bounds: list) -> Column:
    number = F.lit(0)
    for b in bounds:
        number = number + F.when(F.col(ts_col) >= F.lit(b), 1).otherwise(0)
    return number


def write_slices(df: DataFrame, ts_col: str, path: str, bounds: list) -> None:
    """All slices in one job, by as many tasks as the table has, each slice in a folder of its own."""
    df.withColumn("_slice", slice_number(ts_col, bounds)).write.partitionBy("_slice").parquet(path)


class Feed:
    """Slices of tables, to arrive one by one under ``<root>/in/<table>/``."""

    def __init__(self, spark: SparkSession, tables: dict[str, tuple[DataFrame, str]], root: str, orders: dict | None = None):
        self.spark, self.root, self.tables, self.orders = spark, root, list(tables), orders or {}
        bounds = {n: slice_bounds(df, ts) for n, (df, ts) in tables.items()}
        common = max(bounds.values(), key=len)  # one set of bounds for all feeds
        for n, (df, ts) in tables.items():
            write_slices(df, ts, f"{root}/slices/{n}", common)

    def path(self, table: str) -> str:
        return f"{self.root}/in/{table}"

    def reveal(self, k: int) -> None:
        """The k-th slice to arrive, of every table. A slice without rows is a folder without files."""
        for n in self.tables:
            number = self.orders.get(n, ARRIVAL)[k]
            move(self.spark, f"{self.root}/slices/{n}/_slice={number}", f"{self.path(n)}/slice-{number}")

    def stream(self, table: str, schema) -> DataFrame:
        make_folder(self.spark, self.path(table))
        return jobs.read_stream(self.spark, self.path(table), schema, nested=True)


def run_in_two(start, feed: Feed, batches: int = len(ARRIVAL)) -> None:
    """Let half of the slices arrive, each processed before the next, and stop; resume from the checkpoint for
    the rest. ``start()`` gives a running query."""
    half, last = len(ARRIVAL) // 2, -1
    for part in (range(half), range(half, len(ARRIVAL))):
        q = start()
        try:
            for k in part:
                feed.reveal(k)
                q.processAllAvailable()
            last = max(last, *(p["batchId"] for p in q.recentProgress), -1)
        finally:
            q.stop()
    if last + 1 < batches:
        raise RuntimeError(f"{last + 1} micro-batches ran, {batches} were expected")


def replay_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark, "measurement")
    tables = {k: (with_event_ts(FX.typed_readings(spark, sf_dir, k)), "event_ts") for k in ("humidity", "temperature")}
    # the two feeds disagree on the order, so partners arrive batches apart
    feed = Feed(spark, tables, root, {"temperature": ARRIVAL[::-1]})

    def start():
        h, t = (feed.stream(k, tables[k][0].schema) for k in tables)
        m = jobs.measurement_stream(h, t, processing_ms=FX.fixture_measurement_clock)
        return (m.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
                .option("checkpointLocation", f"{root}/ckpt").trigger(**AT_ONCE).start())

    run_in_two(start, feed)
    return spark.read.schema(MEASUREMENT).parquet(f"{root}/out")


def replay_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows as the streaming as-of emits them."""
    root = _scratch(spark, "asof")
    _asof(spark, sf_dir, root, lambda df, n: write_batch(df, f"{root}/out", n))
    return spark.read.option("basePath", f"{root}/out").schema(ENRICHED).parquet(f"{root}/out/batch_id=*").select(*ENRICHED.fieldNames())


def replay_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device-state view that the fan-out sink keeps of the same stream."""
    root = _scratch(spark, "fanout")
    _asof(spark, sf_dir, root, fanout_enriched(f"{root}/enriched", f"{root}/history", f"{root}/state", compact_every=3, ttl_seconds=None))
    seen = read_history(spark, f"{root}/history").count()
    kept = spark.read.parquet(f"{root}/enriched").count()
    if seen != kept:
        raise RuntimeError(f"history has {seen} rows, the enriched table {kept}")
    return read_upsert_view(spark, f"{root}/state", "redis_key").drop("batch_id", "written_at")


def _asof(spark: SparkSession, sf_dir: str, root: str, sink) -> None:
    """The watermark's delay covers the disorder of the slices (two of them), so every version arrives
    before the measurements it belongs to are emitted; what is held at the end goes out last."""
    m = flow.written(flow.measurement(spark, sf_dir), "measurement")
    dims = {k: tenancy(with_event_ts(FX.typed_readings(spark, sf_dir, k))) for k in ("location", "state")}
    tables = {"measurement": (m, "measurement_event_ts"), **{k: (d, "event_ts") for k, d in dims.items()}}
    feed = Feed(spark, tables, root)
    lo, hi = m.agg(F.min("measurement_event_ts"), F.max("measurement_event_ts")).first()
    delay = int((hi - lo).total_seconds() * 1000 * 2.1 / len(ARRIVAL)) if lo is not None else 0
    body = AsofBatches(f"{root}/asof", sink, delay_ms=delay, enrich_ms=FX.fixture_enrich_clock)

    def start():
        s = {n: feed.stream(n, df.schema) for n, (df, _) in tables.items()}
        feeds = tagged_feeds(s["measurement"], s["location"], s["state"])
        return feeds.writeStream.foreachBatch(body).option("checkpointLocation", f"{root}/ckpt").trigger(**AT_ONCE).start()

    run_in_two(start, feed)
    one = tagged_feeds(m, dims["location"], dims["state"])
    body.finish(spark, one.select("l.*").schema, one.select("s.*").schema)


def _replay_enriched(spark: SparkSession, sf_dir: str, root: str, order, query) -> None:
    e = flow.enriched_table(spark, sf_dir)
    feed = Feed(spark, {"enriched": (e, "measurement_event_ts")}, root, {"enriched": order})
    run_in_two(lambda: query(feed.stream("enriched", ENRICHED)).option("checkpointLocation", f"{root}/ckpt").trigger(**AT_ONCE).start(), feed)


def _replay_summary(spark: SparkSession, sf_dir: str, name: str, order) -> str:
    root = _scratch(spark, name)
    body = SummaryBatches(f"{root}/state", upsert_sink(f"{root}/out"))
    _replay_enriched(spark, sf_dir, root, order, lambda e: e.writeStream.foreachBatch(body))
    return root


def replay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows the stream has emitted (closed by the watermark), as the changelog holds them. Readings
    count only for windows still open, as in the reference; here the slices come in order."""
    return spark.read.parquet(f"{_replay_summary(spark, sf_dir, 'summary', IN_ORDER)}/out").drop("batch_id", "written_at")


def replay_summary_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with slices out of order: readings of two slices come behind the watermark."""
    return spark.read.parquet(f"{_replay_summary(spark, sf_dir, 'summary-late', ARRIVAL)}/out").drop("batch_id", "written_at")


def replay_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings that this stream drops, with the batch that brought them."""
    return read_late(spark, f"{_replay_summary(spark, sf_dir, 'late-drop', ARRIVAL)}/state")


def replay_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streak view (latest row per key of the update-mode changelog, compacted on the way) after
    the stream."""
    root = _scratch(spark, "streak")
    _replay_enriched(spark, sf_dir, root, ARRIVAL, lambda e: jobs.streak_stream(e).writeStream.outputMode("update")
                     .foreachBatch(upsert_sink(f"{root}/out", compact_every=2)))
    return read_upsert_view(spark, f"{root}/out", "redis_key").drop("batch_id", "written_at")


def replay_normalizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead-letter table the streaming normalizer writes for the raw feed (ingestion
    time = the raw record's timestamp, as in the batch twin)."""
    root = _scratch(spark, "normalizer")
    feed = Feed(spark, {"raw": (FX.raw_messages(spark, sf_dir), "timestamp")}, root)
    make_folder(spark, feed.path("raw"))
    run_in_two(lambda: jobs.start_normalizer(spark, feed.path("raw"), f"{root}/out", AT_ONCE, f"{root}/ckpt",
                                             ingest_ms=F.unix_millis(F.col("timestamp")), nested=True), feed)
    return jobs.read_parse_errors(spark, f"{root}/out").drop("key")


def replay_chain_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs in a row, with the first job's last batch replayed in between (as after a crash before
    its checkpoint was written): humidity readings as the second job sees them."""
    root = _scratch(spark, "chain")
    raw = FX.raw_messages(spark, sf_dir)
    feed = Feed(spark, {"raw": (raw, "timestamp")}, root)
    make_folder(spark, feed.path("raw"))
    stamp = F.unix_millis(F.col("timestamp"))
    run_in_two(lambda: jobs.start_normalizer(spark, feed.path("raw"), f"{root}/typed", AT_ONCE, f"{root}/ckpt", stamp, nested=True), feed)

    def downstream():
        s = jobs.typed_stream(spark, f"{root}/typed", "humidity")
        (s.writeStream.format("parquet").option("path", f"{root}/seen").option("checkpointLocation", f"{root}/ckpt2")
         .trigger(**ONCE).start().awaitTermination())
    downstream()
    body = jobs.normalizer_batch(f"{root}/typed", stamp)
    for n in range(len(ARRIVAL)):
        body(raw, n)  # whatever a replay brings, a batch that is there stays
    downstream()
    return spark.read.parquet(f"{root}/seen")
