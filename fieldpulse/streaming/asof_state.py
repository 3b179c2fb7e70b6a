"""Streaming as-of (temporal LEFT) join: measurements x versioned location/state.

Spark has no temporal join for streams, and a stream-stream range join would emit every earlier
version. Here the three feeds are one stream whose micro-batches run the batch as-of join over state
tables:

* versions: a store of each dimension's versions, see :class:`VersionStore`;
* pending: measurements held back until the watermark passes them.

The watermark is the least, over the feeds, of the newest event time seen less ``delay``; it never
goes back. It only decides *when* a measurement is emitted. Nothing is dropped for being late: a late version
counts for every measurement not yet emitted, and a late measurement is emitted at once with the versions
known by then. A silent feed holds the others, since its next version may belong to any of them. Where that
can't be borne, ``idle_batches`` says after how many batches without a row a feed no longer holds; the
measurements emitted ahead of it are counted in the marks (``ahead``).

State lives in tables in the shared folder: no device's rows have to fit in one group or one state row, and a
replayed batch starts from the state before it and writes nothing twice (``sinks.write_once``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.constants import KEY_PREFIX
from fieldpulse.operators.asof import LOCATION_FIELDS, STATE_FIELDS, asof_enrich
from fieldpulse.operators.measurement import MEASUREMENT_COLUMNS, tenancy, with_event_ts
from fieldpulse.schemas import MEASUREMENT
from fieldpulse.streaming import sinks

DIMS = {"l": LOCATION_FIELDS, "s": STATE_FIELDS}
MARKS = "feed string, newest_ms long, last_batch long, watermark_ms long, held_ms long, ahead long"
#: Batches after which the versions the watermark has passed are settled.
SETTLE_EVERY = 64
DAY_MS = 86_400_000


def tagged_feeds(measurement: DataFrame, location: DataFrame, state: DataFrame) -> DataFrame:
    """The three feeds as one stream: ``feed`` and a struct for each."""
    def version(df: DataFrame, fields: list[str]) -> DataFrame:
        return tenancy(with_event_ts(df)).select("env", "tenant", "deviceId", "event_ts", *fields)

    feeds = {"m": measurement.select(*MEASUREMENT_COLUMNS), "l": version(location, LOCATION_FIELDS), "s": version(state, STATE_FIELDS)}
    kinds = {n: df.select(F.struct(*df.columns).alias("x")).schema["x"].dataType for n, df in feeds.items()}
    parts = [df.select(F.lit(n).alias("feed"), *[(F.struct(*df.columns) if k == n else F.lit(None).cast(kinds[k])).alias(k) for k in feeds])
             for n, df in feeds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _event_ms() -> Column:
    return F.unix_millis(F.coalesce("m.measurement_event_ts", "l.event_ts", "s.event_ts"))


class VersionStore:
    """Versions of one dimension for a stream of as-of look-ups.

    Every batch's versions are a folder. Every ``every`` batches all that came since are *settled* at the
    watermark, the cut: of each device's versions before it, the last goes to ``newest`` (one row a device), the
    others become closed validity intervals in ``closed``, in a folder for the day they end; versions after the
    cut stay in ``later``. A batch reads ``newest``, ``later`` and the folders since: their number does not grow
    with the life of the stream. ``closed`` is read for measurements from before the cut alone, and of it only
    the days from the earliest of them on: an interval that ended before has nothing to say.

    A version that arrives behind the cut counts from the batch it arrives in; when it is settled, its interval
    is closed by the next version known then, which may be later than the true one. That is harmless: where
    intervals overlap, the one that begins last wins.

    A settlement is visible once its mark is there; what it replaces is deleted one settlement later, so a
    replayed batch finds the state it started from.
    """

    KEY = ("env", "tenant", "deviceId")

    def __init__(self, root: str, every: int = SETTLE_EVERY):
        self.root, self.every = root.rstrip("/"), every

    def add(self, versions: DataFrame, batch_id: int) -> None:
        sinks.write_batch(versions, f"{self.root}/batches", batch_id)

    def settled(self, spark: SparkSession, before: int) -> tuple[int, int | None]:
        """The last settlement of a batch before ``before`` and its cut (-1: none)."""
        done = [int(n.split("=")[1]) for n in sinks.children(spark, f"{self.root}/marks", "batch_id=")]
        last = max((n for n in done if n < before), default=-1)
        return last, None if last < 0 else spark.read.schema("cut_ms long").parquet(f"{self.root}/marks/batch_id={last}").first()[0]

    def folders(self, spark: SparkSession, upto: int, since_ms: int | None = None) -> list[str]:
        """What a look-up in batch ``upto`` reads; ``since_ms``: the earliest measurement before the cut, if any."""
        last, _ = self.settled(spark, upto)
        found = [f"{self.root}/batches/{n}" for n in sinks.children(spark, f"{self.root}/batches", "batch_id=") if last < int(n.split("=")[1]) <= upto]
        if last >= 0:
            found += [f"{self.root}/{part}/batch_id={last}" for part in ("newest", "later")]
            if since_ms is not None:
                day = since_ms // DAY_MS
                for d in sinks.children(spark, f"{self.root}/closed", "end_day="):
                    if int(d.split("=")[1]) >= day:
                        found += [f"{self.root}/closed/{d}/{n}" for n in sinks.children(spark, f"{self.root}/closed/{d}", "batch_id=") if int(n.split("=")[1]) <= last]
        return found

    def read(self, spark: SparkSession, schema, upto: int, since_ms: int | None = None) -> DataFrame:
        found = self.folders(spark, upto, since_ms)
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

    def settle(self, spark: SparkSession, schema, batch_id: int, cut_ms: int | None) -> None:
        """Settle what came up to ``batch_id``, if it is time."""
        last, _ = self.settled(spark, batch_id)
        if cut_ms is None or batch_id - last < self.every or sinks.exists(spark, f"{self.root}/marks/batch_id={batch_id}"):
            return
        rows = self.read(spark, schema, batch_id).filter(F.col("event_ts").isNotNull())
        cut = F.timestamp_millis(F.lit(cut_ms))
        following = Window.partitionBy(*self.KEY).orderBy("event_ts", "ingestedAt")
        past = rows.filter(F.col("event_ts") < cut).withColumn("valid_to", F.lead("event_ts").over(following)).persist()
        try:
            sinks.write_batch(past.filter("valid_to IS NULL").drop("valid_to"), f"{self.root}/newest", batch_id)
            closed = past.filter(F.col("valid_to") > F.col("event_ts")).withColumn("end_day", F.floor(F.unix_millis("valid_to") / F.lit(DAY_MS)))
            sinks.write_by(closed.drop("valid_to"), "end_day", f"{self.root}/closed", batch_id)
        finally:
            past.unpersist()
        sinks.write_batch(rows.filter(F.col("event_ts") >= cut), f"{self.root}/later", batch_id)
        sinks.write_batch(spark.createDataFrame([(cut_ms,)], "cut_ms long").coalesce(1), f"{self.root}/marks", batch_id)
        for part, upto in (("batches", last), ("newest", last - 1), ("later", last - 1), ("marks", last - 1)):
            sinks.forget_batches(spark, f"{self.root}/{part}", upto)


class AsofBatches:
    """``foreachBatch`` body: ``sink(enriched, batch_id)`` gets what each batch makes ready."""

    def __init__(self, state_root: str, sink, delay_ms: int = 200, idle_batches: int | None = None,
                 enrich_ms=None, key_prefix: str = KEY_PREFIX, settle_every: int = SETTLE_EVERY):
        self.root, self.sink, self.delay, self.idle = state_root.rstrip("/"), sink, delay_ms, idle_batches
        self.enrich_ms, self.prefix = enrich_ms, key_prefix
        self.stores = {d: VersionStore(f"{self.root}/versions_{d}", settle_every) for d in DIMS}

    def marks(self, spark: SparkSession, batch_id: int) -> dict:
        path = f"{self.root}/marks/batch_id={batch_id}"
        return {r["feed"]: r for r in spark.read.schema(MARKS).parquet(path).collect()} if batch_id >= 0 and sinks.exists(spark, path) else {}

    def _advance(self, batch: DataFrame, batch_id: int, old: dict) -> tuple[dict, int | None, int | None]:
        """Newest time and last batch of each feed, the watermark, and what it would be if every feed held it."""
        new = {r["feed"]: r["t"] for r in batch.groupBy("feed").agg(F.max(_event_ms()).alias("t")).collect()}
        feeds = {}
        for f in ("m", *DIMS):
            was = old.get(f)
            newest = max([t for t in (new.get(f), was and was["newest_ms"]) if t is not None], default=None)
            feeds[f] = (newest, batch_id if f in new else was["last_batch"] if was else -1)

        def least(times: list, name: str) -> int | None:
            mark = None if not times or None in times else min(times) - self.delay
            before = next((r[name] for r in old.values()), None)  # all feeds' rows have the same marks
            return max([x for x in (mark, before) if x is not None], default=None)

        busy = [t for t, last in feeds.values() if self.idle is None or batch_id - last < self.idle]
        return feeds, least(busy, "watermark_ms"), least([t for t, _ in feeds.values()], "held_ms")

    def _emit(self, spark: SparkSession, ready: DataFrame, batch_id: int, schemas: dict) -> None:
        cuts = {d: store.settled(spark, batch_id)[1] for d, store in self.stores.items()}
        cut = max((c for c in cuts.values() if c is not None), default=None)
        since = None
        if cut is not None:  # measurements from before a cut need the intervals that are closed
            since = ready.filter(F.unix_millis("measurement_event_ts") < F.lit(cut)).agg(F.unix_millis(F.min("measurement_event_ts"))).first()[0]
        dims = {d: store.read(spark, schemas[d], batch_id, since) for d, store in self.stores.items()}
        self.sink(asof_enrich(ready, dims["l"], dims["s"], enrich_ms=self.enrich_ms, key_prefix=self.prefix), batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            old = self.marks(spark, batch_id - 1)
            feeds, mark, held_mark = self._advance(batch, batch_id, old)
            schemas = {d: batch.select(f"{d}.*").schema for d in DIMS}
            for d, store in self.stores.items():
                store.add(batch.filter(F.col("feed") == d).select(f"{d}.*"), batch_id)
            rows = batch.filter("feed = 'm'").select("m.*")
            held = f"{self.root}/pending/batch_id={batch_id - 1}"
            if batch_id and sinks.exists(spark, held):
                rows = rows.unionByName(spark.read.schema(MEASUREMENT).parquet(held))
            ms = F.unix_millis("measurement_event_ts")
            passed = F.lit(False) if mark is None else ms < F.lit(mark)
            self._emit(spark, rows.filter(passed), batch_id, schemas)
            sinks.write_batch(rows.filter(~passed), f"{self.root}/pending", batch_id)
            ahead = next((r["ahead"] for r in old.values()), 0)
            if mark != held_mark:
                ahead += rows.filter(passed if held_mark is None else passed & (ms >= F.lit(held_mark))).count()
            marks = [(f, t, last, mark, held_mark, ahead) for f, (t, last) in feeds.items()]
            sinks.write_batch(spark.createDataFrame(marks, MARKS).coalesce(1), f"{self.root}/marks", batch_id)
            for d, store in self.stores.items():
                store.settle(spark, schemas[d], batch_id, mark)
            for name in ("pending", "marks"):  # a replay needs the batch before
                sinks.forget_batches(spark, f"{self.root}/{name}", batch_id - 2)
        finally:
            batch.unpersist()

    def finish(self, spark: SparkSession, location_schema, state_schema) -> None:
        """End of all feeds: what is still held goes out (as a batch of its own)."""
        last = max((int(n.split("=")[1]) for n in sinks.children(spark, f"{self.root}/pending", "batch_id=")), default=None)
        if last is not None:
            rows = spark.read.schema(MEASUREMENT).parquet(f"{self.root}/pending/batch_id={last}")
            self._emit(spark, rows, last + 1, {"l": location_schema, "s": state_schema})
