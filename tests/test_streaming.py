"""Batch-vs-stream: the streaming jobs, fed the fixture as time-ordered files, agree with the
batch operators on everything the watermark has closed."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from fieldpulse.operators import streak as SK
from fieldpulse.operators import summary as SM
from fieldpulse.plans import flow
from fieldpulse.sources import fixtures as FX
from fieldpulse.streaming import jobs
from fieldpulse.streaming.sinks import read_upsert_view

ONCE = {"availableNow": True}
DIM_COLS = ["device_id", "humidity_seq", "lat", "lon", "rssi", "snr", "battery", "online",
            "location_event_time", "state_event_time", "location_ingested_at", "state_ingested_at",
            "measurement_event_ts", "humidity", "temperature"]


def write_in_slices(df, ts_col, path, slices=4):
    """Write ``df`` as ``slices`` files in time order (older files first)."""
    lo, hi = df.agg(F.min(ts_col), F.max(ts_col)).first()
    step = (hi - lo) / slices
    for i in range(slices):
        a, b = lo + step * i, lo + step * (i + 1)
        part = df.filter((F.col(ts_col) >= a) & ((F.col(ts_col) < b) if i < slices - 1 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="fieldpulse-stream-test-")


@pytest.fixture(scope="module")
def chain(spark, scratch):
    """raw files -> normalizer -> measurement -> enrichment -> summary, streak."""
    raw = FX.raw_messages(spark, SF_SMALL).withColumn("_t", F.col("timestamp"))
    write_in_slices(raw, "_t", f"{scratch}/raw")
    ck = f"{scratch}/ckpt"
    ingest = F.unix_millis(F.col("timestamp"))
    jobs.start_normalizer(spark, f"{scratch}/raw", f"{scratch}/typed", ONCE, ck, ingest_ms=ingest).awaitTermination()
    jobs.start_measurement(spark, f"{scratch}/typed", f"{scratch}/measurement", ONCE, ck,
                           processing_ms=FX.fixture_measurement_clock).awaitTermination()
    jobs.start_enrichment(spark, f"{scratch}/measurement", f"{scratch}/typed", f"{scratch}/enriched",
                          f"{scratch}/history", f"{scratch}/state", ONCE, ck,
                          enrich_ms=FX.fixture_enrich_clock).awaitTermination()
    jobs.start_summary(spark, f"{scratch}/enriched", f"{scratch}/summary", ONCE, ck).awaitTermination()
    jobs.start_streak(spark, f"{scratch}/enriched", f"{scratch}/streak", ONCE, ck).awaitTermination()
    return scratch


def test_normalizer_stream_equals_batch(spark, chain):
    for kind in ("humidity", "state"):
        want = flow.typed_from_raw(spark, SF_SMALL, kind).drop("event_ts")
        got = spark.read.parquet(f"{chain}/typed/batch_id=*/kind={kind}/status=ok").select(*want.columns)
        assert rows(got) == rows(want)
    errs = jobs.read_parse_errors(spark, f"{chain}/typed")
    assert errs.count() == flow.errors_from_raw(spark, SF_SMALL).count()
    assert errs.filter(F.col("key").endswith("-parse-error")).count() == errs.count()


def test_measurement_stream_equals_batch(spark, chain):
    got = spark.read.parquet(f"{chain}/measurement")
    t = {k: flow.typed_from_raw(spark, SF_SMALL, k) for k in ("humidity", "temperature")}
    from fieldpulse.operators.measurement import join_measurement
    want = join_measurement(t["humidity"], t["temperature"], processing_ms=FX.fixture_measurement_clock)
    assert rows(got) == rows(want)


def test_asof_stream_equals_batch_behind_watermark(spark, chain):
    got = spark.read.parquet(f"{chain}/enriched").drop("batch_id")
    want = flow.enriched_from_raw(spark, SF_SMALL)
    # held rows are those the watermark (the slowest feed's newest time) has not passed
    last = min(want.agg(F.max("measurement_event_ts")).first()[0],
               *[flow.typed_from_raw(spark, SF_SMALL, k).agg(F.max("event_ts")).first()[0] for k in ("location", "state")])
    closed = want.filter(F.col("measurement_event_ts") < F.lit(last - dt.timedelta(milliseconds=200)))
    assert rows(got, *DIM_COLS) == rows(closed, *DIM_COLS) and closed.count() > 0


def test_summary_stream_windows_equal_batch(spark, chain):
    log = spark.read.parquet(f"{chain}/summary")
    enriched = spark.read.parquet(f"{chain}/enriched").drop("batch_id")
    batch = SM.recent_summary(enriched, method="direct")
    cols = ["redis_key", "window_start", "window_end", "totalDevices", "onlineDevices", "offlineDevices",
            "minEventTs", "maxEventTs"]
    got = rows(log, *cols)
    assert len(got) > 0
    want = set(rows(batch, *cols))
    assert set(got) <= want  # every emitted (closed) window equals its batch value
    view = read_upsert_view(spark, f"{chain}/summary", "redis_key")
    assert view.count() == enriched.select("env", "tenant").distinct().count()


def test_streak_stream_final_state_equals_batch(spark, chain):
    view = read_upsert_view(spark, f"{chain}/streak", "redis_key")
    enriched = spark.read.parquet(f"{chain}/enriched").drop("batch_id")
    want = SK.low_humidity_streak(enriched)
    cols = ["redis_key", "streak_days", "last_event_ts", "last_ok_event_ts", "last_humidity"]
    assert rows(view, *cols) == rows(want, *cols)


def test_history_and_state_sinks(spark, chain):
    hist = spark.read.parquet(f"{chain}/history")
    enriched = spark.read.parquet(f"{chain}/enriched")
    assert hist.count() == enriched.count()
    assert {"postgres_inserted_at", "event_date", "batch_id"} <= set(hist.columns)
    state = read_upsert_view(spark, f"{chain}/state", "redis_key")
    assert state.count() == enriched.select("redis_key").distinct().count()


LOC = "deviceId string, eventTime string, lat double, lon double, ingestedAt long, sourceTopic string"
STA = "deviceId string, eventTime string, rssi int, snr double, battery double, online boolean, ingestedAt long, sourceTopic string"


def _meas(seq, t):
    t = f"2024-01-05T{t}.000Z"
    return ("d", "prod", "tenant-1", 50.0, 1.0, seq, seq, t, t, 1, 1, dt.datetime.fromisoformat(t.replace("Z", "")), 0)


def test_stream_asof_loses_nothing(spark, scratch):
    """Late versions count for what is not yet emitted, late measurements come out, a quiet feed doesn't
    hold the others for ever, and the query stops and resumes from its checkpoint."""
    from fieldpulse.schemas import MEASUREMENT
    from fieldpulse.streaming.asof_state import AsofBatches, tagged_feeds
    from fieldpulse.streaming.sinks import write_batch
    root = f"{scratch}/asof-edges"
    schemas = {"m": MEASUREMENT, "l": LOC, "s": STA}

    def drop(n, m=(), l=(), s=()):
        for kind, data in (("m", m), ("l", l), ("s", s)):
            if data:
                spark.createDataFrame(list(data), schemas[kind]).coalesce(1).write.mode("append").parquet(f"{root}/{kind}/{n}")

    loc = lambda t, v: ("d", f"2024-01-05T{t}Z", v, v, int(v), "l")
    sta = lambda t: ("d", f"2024-01-05T{t}Z", -70, 1.0, 90.0, True, 1, "s")
    body = AsofBatches(f"{root}/state", lambda df, n: write_batch(df, f"{root}/out", n), idle_batches=3, enrich_ms=F.lit(0))

    def run():
        src = {k: spark.readStream.schema(v).parquet(f"{root}/{k}/*") for k, v in schemas.items()}
        q = (tagged_feeds(src["m"], src["l"], src["s"]).writeStream.foreachBatch(body)
             .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.read.schema("humidity_seq long, lat double, rssi int").parquet(f"{root}/out/batch_id=*").collect()
        return {r.humidity_seq: r.lat for r in got}, len(got)

    drop(1, [_meas(1, "10:00:00")], [loc("09:00:00.000", 1.0)], [sta("08:00:00.000")])
    assert run() == ({}, 0)                      # held: the state feed stands at 08:00
    # a version behind every feed's newest time, but before the measurement
    drop(2, [_meas(2, "11:00:00")], [loc("09:59:59.900", 2.0), loc("11:00:00.000", 3.0)], [sta("11:00:00.000")])
    assert run()[0] == {1: 2.0}
    drop(3, [_meas(3, "08:30:00"), _meas(4, "12:00:00")], [loc("12:00:00.000", 4.0)], [sta("12:00:00.000")])
    got, n = run()
    assert got == {1: 2.0, 2: 3.0, 3: None} and n == 3   # 3 was late: out at once, with what is known
    for k in range(4, 9):                        # the dimension feeds fall silent
        drop(k, [_meas(k + 1, f"{9 + k}:00:00")])
        got, n = run()
    assert {4, 5, 6, 7, 8} <= set(got) and n == len(got)
    dims = tagged_feeds(spark.createDataFrame([], MEASUREMENT), spark.createDataFrame([], LOC), spark.createDataFrame([], STA))
    body.finish(spark, dims.select("l.*").schema, dims.select("s.*").schema)
    assert spark.read.parquet(f"{root}/out/batch_id=*").count() == 9


def test_summary_stream_late_rows_count_for_open_windows(spark, scratch):
    """A reading behind the watermark counts for its windows that are still open, and not for those
    already emitted; every window is emitted once."""
    from fieldpulse.schemas import ENRICHED
    from fieldpulse.streaming.summary_state import SummaryBatches
    from fieldpulse.streaming.sinks import upsert_sink
    root = f"{scratch}/summary-late"
    body = SummaryBatches(f"{root}/state", upsert_sink(f"{root}/out"))
    base = dict.fromkeys(ENRICHED.fieldNames())

    def send(n, *readings):
        data = [tuple({**base, "device_id": d, "env": "prod", "tenant": "t1", "humidity": 1.0, "temperature": 1.0, "online": True, "humidity_seq": 1,
                       "measurement_event_ts": dt.datetime(2024, 1, 5, 10, 0) + dt.timedelta(seconds=t)}.values()) for d, t in readings]
        for _ in range(2):  # each batch is replayed once
            body(spark.createDataFrame(data, ENRICHED), n)

    send(0, ("a", 0), ("a", 300))            # watermark 295
    send(1, ("b", 100), ("a", 320))          # b is late: windows up to 290 are out
    send(2, ("a", 2000))
    got = {(r.window_end - dt.datetime(2024, 1, 5, 10, 0)).total_seconds(): r.totalDevices for r in spark.read.parquet(f"{root}/out").collect()}
    n = spark.read.parquet(f"{root}/out").count()
    # ends from 10 s on hold a's reading at 0; from 300 s on (still open when b came), b's at 100 too
    assert n == len(got) and all(got[e] == 1 for e in range(10, 300, 10)) and all(got[e] == 2 for e in range(300, 610, 10))
    assert got[700] == 2 and got[710] == 1 and max(got) == 920


def test_stream_join_keeps_late_rows_and_copies(spark, scratch):
    """Partners far behind the newest reading still meet; copies multiply unless collapsed."""
    root = f"{scratch}/j1-late"
    h_schema = "deviceId string, eventTime string, humidity double, seq long, ingestedAt long, sourceTopic string, env string, tenant string"
    t_schema = h_schema.replace("humidity", "temperature")
    row = lambda t, seq: ("d", f"2024-01-05T{t}.000Z", 4.0, seq, 1, "x", "prod", "t1")

    def start():
        m = jobs.measurement_stream(spark.readStream.schema(h_schema).parquet(f"{root}/h/*"), spark.readStream.schema(t_schema).parquet(f"{root}/t/*"),
                                    processing_ms=F.lit(0))
        m.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt").trigger(**ONCE).start().awaitTermination()

    for n, (h, t) in enumerate([([row("10:00:00", 1)], [row("10:00:00", 1)]), ([row("12:00:00", 3)], [row("12:00:00", 3)]),
                                ([row("09:00:00", 2), row("09:00:00", 2)], [row("09:00:00", 2)])]):
        spark.createDataFrame(h, h_schema).coalesce(1).write.parquet(f"{root}/h/{n}")
        spark.createDataFrame(t, t_schema).coalesce(1).write.parquet(f"{root}/t/{n}")
        start()
    assert sorted(r.humidity_seq for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 2, 3]


def test_stream_join_drops_redelivered_copies(spark, scratch):
    from pyspark.sql import functions as F
    root = f"{scratch}/j1-copies"
    h_schema = ("deviceId string, eventTime string, humidity double, seq long, ingestedAt long, "
                "sourceTopic string, env string, tenant string")
    t_schema = h_schema.replace("humidity", "temperature")
    row = ("d", "2024-01-05T10:00:00.000Z", 40.0, 1, 1, "h", "prod", "t1")
    spark.createDataFrame([row, row[:4] + (2,) + row[5:], row], h_schema).coalesce(1).write.parquet(f"{root}/h")
    spark.createDataFrame([("d", "2024-01-05T10:00:00.100Z", 5.0, 1, 3, "t", "prod", "t1")] * 2,
                          t_schema).coalesce(1).write.parquet(f"{root}/t")
    m = jobs.measurement_stream(spark.readStream.schema(h_schema).parquet(f"{root}/h"),
                                spark.readStream.schema(t_schema).parquet(f"{root}/t"), processing_ms=F.lit(0),
                                max_time_skew="1 hour", copies="collapse")
    q = (m.writeStream.format("memory").queryName("j1_copies").outputMode("append")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("j1_copies").collect()
    assert [(r.humidity, r.temperature) for r in got] == [(40.0, 5.0)]  # 3 x 2 copies -> one pair


def test_foreach_batch_sinks_are_idempotent_on_replay(spark, scratch):
    from fieldpulse.streaming.sinks import compact_changelog, fanout_enriched, read_upsert_view, upsert_sink
    e = flow.enriched(spark, SF_SMALL)
    root = f"{scratch}/idem"
    run = fanout_enriched(f"{root}/enriched", f"{root}/history", f"{root}/state")
    for _ in range(2):               # a micro-batch replayed after a failure keeps its id
        run(e, 7)
    run(e.limit(5), 8)
    assert spark.read.parquet(f"{root}/enriched").filter("batch_id = 7").count() == e.count()
    assert spark.read.parquet(f"{root}/history").filter("batch_id = 7").count() == e.count()
    state = read_upsert_view(spark, f"{root}/state", "redis_key")
    assert state.count() == e.select("redis_key").distinct().count()
    # time to live on the view: nothing written "now" has expired; all of it has a day later
    now = F.current_timestamp()
    assert read_upsert_view(spark, f"{root}/state", "redis_key", as_of=now, ttl_seconds=600).count() == state.count()
    later = now + F.expr("INTERVAL 1 DAY")
    assert read_upsert_view(spark, f"{root}/state", "redis_key", as_of=later, ttl_seconds=600).count() == 0
    files = sorted(spark.read.parquet(f"{root}/enriched").inputFiles())
    run(e.limit(3), 7)               # a batch that is there stays as it is, file names too
    assert sorted(spark.read.parquet(f"{root}/enriched").inputFiles()) == files
    compact_changelog(spark, f"{root}/state", "redis_key", upto=7)
    assert rows(read_upsert_view(spark, f"{root}/state", "redis_key").drop("batch_id", "written_at")) == \
        rows(state.drop("batch_id", "written_at"))
    sink = upsert_sink(f"{root}/kv")
    sink(e.select("redis_key", "humidity"), 1)
    sink(e.select("redis_key", "humidity"), 1)
    assert spark.read.parquet(f"{root}/kv").count() == e.count()


def test_one_large_day_has_several_history_writers(spark, tmp_path):
    from fieldpulse.sources.history import SORT_COLUMNS, read_history
    from fieldpulse.streaming.sinks import children, compact_history_dates, write_history_batch
    e = flow.enriched_table(spark, SF_SMALL)
    day = F.to_timestamp(F.lit("2024-05-01 00:00:00")) + F.make_dt_interval(secs=F.pmod(F.col("humidity_seq"), F.lit(86400)).cast("decimal(18,6)"))
    small = e.limit(3).withColumn("measurement_event_ts", F.to_timestamp(F.lit("2024-05-02 00:00:00")))
    none = e.limit(2).withColumn("measurement_event_ts", F.lit(None).cast("timestamp"))
    big = e.withColumn("measurement_event_ts", day).unionByName(small).unionByName(none)
    path, n = str(tmp_path / "history"), e.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # would put this little into one task again
    try:
        write_history_batch(big, path, 0, F.to_timestamp(F.lit("2024-06-01")), rows_per_writer=max(1, n // 6))
        compact_history_dates(spark, path, str(tmp_path / "compact"), ["2024-05-01", "2024-05-02"], rows_per_writer=max(1, n // 6))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for root, folder in ((path, "/batch_id=0"), (str(tmp_path / "compact"), "")):
        files = children(spark, f"{root}/event_date=2024-05-01{folder}", "part-")
        assert len(files) > 1 and len(children(spark, f"{root}/event_date=2024-05-02{folder}", "part-")) == 1
        for f in files:  # each sorted as the batch writer sorts
            got = [tuple(r) for r in spark.read.parquet(f"{root}/event_date=2024-05-01{folder}/{f}").select(*SORT_COLUMNS).toPandas().itertuples(index=False)]
            assert got == sorted(got)
    assert read_history(spark, path).count() == n + 5
    cols = [c for c in e.columns]
    assert rows(read_history(spark, path).select(*cols)) == rows(big.select(*cols))
    assert read_history(spark, str(tmp_path / "compact")).count() == n + 3
