"""Streaming hop summary: each micro-batch closes the windows that the watermark has passed.

A reading lies in sixty windows and a window needs exact distinct devices. Kept as streaming state,
that is sixty (window, device) entries a reading. Here the state is two tables of *panes* (ten-second
stretches), as the batch plan aggregates them: the measures of a tenant's pane, and which devices were
seen in a pane, online or offline. A batch adds its readings' panes to them and runs the batch plan over
the panes for the windows that close in it. What is held grows with devices and panes of one window
length, however many readings a pane has.

The watermark is the newest event time less ``delay``. A window is emitted once, when its end is
passed; a late reading still counts for its windows that are open. One whose windows are all closed is
dropped, as in the reference, but not without a trace: it goes to the table ``late``, and the marks count
it, and those that came too late for some of their windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.constants import SLIDE_SECONDS, WINDOW_SECONDS
from fieldpulse.operators import summary as SM
from fieldpulse.schemas import ENRICHED, ENRICHED_COLUMNS
from fieldpulse.streaming import sinks

MARK = "watermark_ms long, dropped long, partly_late long"
TS = SM.TS
KEPT_BATCHES = 2


class SummaryBatches:
    """``foreachBatch`` body: ``sink(windows, batch_id)`` gets the windows each batch closes. The window has to be
    a multiple of the slide."""

    def __init__(self, state_root: str, sink, delay_ms: int = 5_000, window_seconds: int = WINDOW_SECONDS,
                 slide_seconds: int = SLIDE_SECONDS):
        if window_seconds % slide_seconds:
            raise ValueError("the window has to be a multiple of the slide")
        self.root, self.sink, self.delay = state_root.rstrip("/"), sink, delay_ms
        self.window, self.slide = window_seconds, slide_seconds

    def mark(self, spark: SparkSession, batch_id: int):
        """``(watermark_ms, dropped, partly_late)`` after a batch; counts are of all batches so far."""
        path = f"{self.root}/marks/batch_id={batch_id}"
        return spark.read.schema(MARK).parquet(path).first() if sinks.exists(spark, path) else None

    def _held(self, new: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = f"{self.root}/{name}/batch_id={batch_id - 1}"
        spark = new.sparkSession
        return new.unionByName(spark.read.schema(new.schema).parquet(path)) if batch_id and sinks.exists(spark, path) else new

    def _end_ms(self, panes: int) -> Column:
        """When the window ends that begins ``panes - window / slide`` panes after a row's own."""
        return (F.col("_p") + panes) * (self.slide * 1000)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, k = batch.sparkSession, self.window // self.slide
        old = self.mark(spark, batch_id - 1) if batch_id else None
        before = old["watermark_ms"] if old else None
        rows = batch.select(*ENRICHED_COLUMNS).persist()
        panes = devices = None
        try:
            at_pane = rows.withColumn("_p", SM.pane_of(TS, self.slide))
            closed = F.lit(before) if before is not None else F.lit(None).cast("long")
            newest, dropped, partly = at_pane.agg(F.unix_millis(F.max(TS)), F.count_if(self._end_ms(k) <= closed),
                                                  F.count_if((self._end_ms(1) <= closed) & (self._end_ms(k) > closed))).first()
            mark = max([x for x in (before, None if newest is None else newest - self.delay) if x is not None], default=None)
            if dropped:
                sinks.write_batch(at_pane.filter(self._end_ms(k) <= closed).drop("_p"), f"{self.root}/late", batch_id)
            panes = SM.add_measures(self._held(SM.pane_measures(rows, self.slide), "panes", batch_id)).persist()
            devices = SM.add_devices(self._held(SM.pane_devices(rows, self.slide), "devices", batch_id)).persist()
            passed = self._end_ms(1) <= F.lit(mark) if mark is not None else F.lit(False)
            windows = SM.windows_of_panes(panes.filter(passed), devices.filter(passed), self.window, self.slide)
            windows = windows.filter(F.col("window_end") <= F.timestamp_millis(F.lit(mark).cast("long")))
            if before is not None:
                windows = windows.filter(F.col("window_end") > F.timestamp_millis(F.lit(before)))
            self.sink(windows, batch_id)
            open_ = F.col("_p").isNotNull() & (self._end_ms(k) > F.lit(mark) if mark is not None else F.lit(True))
            sinks.write_batch(panes.filter(open_), f"{self.root}/panes", batch_id)
            sinks.write_batch(devices.filter(open_), f"{self.root}/devices", batch_id)
            counts = (dropped + (old["dropped"] if old else 0), partly + (old["partly_late"] if old else 0))
            sinks.write_batch(spark.createDataFrame([(mark, *counts)], MARK).coalesce(1), f"{self.root}/marks", batch_id)
            for name in ("panes", "devices", "marks"):  # a replay needs the batch before
                sinks.forget_batches(spark, f"{self.root}/{name}", batch_id - KEPT_BATCHES)
        finally:
            for t in (rows, panes, devices):
                if t is not None:
                    t.unpersist()


def read_late(spark: SparkSession, state_root: str) -> DataFrame:
    """Readings that were dropped because all their windows were closed, with the batch that brought them."""
    path = f"{state_root.rstrip('/')}/late"
    if not sinks.children(spark, path, "batch_id="):
        return spark.createDataFrame([], ENRICHED).withColumn("batch_id", F.lit(None).cast("long")).limit(0)
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")
    return rows.select(*ENRICHED_COLUMNS, F.col("batch_id").cast("long").alias("batch_id"))
