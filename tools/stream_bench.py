"""Throughput of the streaming jobs: fixture rows replayed as time-ordered files, each job run
with trigger(availableNow=True). Prints one JSON line: rows/s per job (input rows / seconds
of the streaming run only; writing the input files is not timed).

usage: python tools/stream_bench.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from fieldpulse import build_session
    from fieldpulse.operators.metrics import latency_stats
    from fieldpulse.schemas import MEASUREMENT
    from fieldpulse.sources import fixtures as FX
    from fieldpulse.sources.history import read_history
    from fieldpulse.streaming import jobs
    from fieldpulse.streaming.replay import ARRIVAL, Feed

    spark = build_session("local[8]", shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="fieldpulse-stream-bench-")
    once = {"availableNow": True}
    out = {}

    def timed(name, query_start, rows):
        t0 = time.perf_counter()
        query_start().awaitTermination()
        dt = time.perf_counter() - t0
        out[name] = {"rows": rows, "sec": round(dt, 2), "rows_per_sec": round(rows / dt, 1)}

    # normalizer over the raw feed, in six slices out of order
    raw = FX.raw_messages(spark, sf)
    feed = Feed(spark, {"raw": (raw, "timestamp")}, root)
    for k in range(len(ARRIVAL)):
        feed.reveal(k)
    n_raw = raw.count()
    timed("normalizer", lambda: jobs.start_normalizer(spark, f"{root}/in/raw", f"{root}/typed", once, f"{root}/ck", max_files=8, nested=True), n_raw)
    typed = lambda k: spark.read.parquet(f"{root}/typed/batch_id=*/kind={k}/status=ok").count()
    timed("measurement", lambda: jobs.start_measurement(spark, f"{root}/typed", f"{root}/m", once, f"{root}/ck"), typed("humidity") + typed("temperature"))
    n_m = spark.read.schema(MEASUREMENT).parquet(f"{root}/m").count()
    timed("enrichment_asof", lambda: jobs.start_enrichment(spark, f"{root}/m", f"{root}/typed", f"{root}/e", f"{root}/h", f"{root}/s", once, f"{root}/ck",
                                                           max_files=1), n_m + typed("location") + typed("state"))
    n_e = spark.read.parquet(f"{root}/e").count()
    timed("summary", lambda: jobs.start_summary(spark, f"{root}/e", f"{root}/sum", once, f"{root}/ck"), n_e)
    timed("streak", lambda: jobs.start_streak(spark, f"{root}/e", f"{root}/st", once, f"{root}/ck"), n_e)

    # create -> normalized / measurement / enriched / stored: lines whose event time is the time they
    # are written, handed through the chain at once
    live = f"{root}/live"
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.regexp_replace(F.col("value").cast("string"), r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+Z", now)
    raw.withColumn("value", text.cast("binary")).limit(20_000).coalesce(1).write.parquet(f"{live}/raw")
    ck = f"{live}/ck"
    jobs.start_normalizer(spark, f"{live}/raw", f"{live}/typed", once, ck).awaitTermination()
    jobs.start_measurement(spark, f"{live}/typed", f"{live}/m", once, ck).awaitTermination()
    jobs.start_enrichment(spark, f"{live}/m", f"{live}/typed", f"{live}/e", f"{live}/h", f"{live}/s", once, ck, delay_ms=-60_000).awaitTermination()
    stats = latency_stats(read_history(spark, f"{live}/h")).first()
    out["create_to_stored_ms"] = {k: v for k, v in stats.asDict().items()}
    print(json.dumps({"metric": "stream_rows_per_sec", "sf": sf, "jobs": out}))
    spark.stop()


if __name__ == "__main__":
    main()
