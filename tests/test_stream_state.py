"""State tables of the streaming jobs: bounded over many batches, right for late rows, whole after a crash."""

import datetime as dt
import itertools
import random
import shutil

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from fieldpulse.plans import flow
from fieldpulse.schemas import ENRICHED, MEASUREMENT
from fieldpulse.sources.history import read_history
from fieldpulse.streaming import sinks
from fieldpulse.streaming.asof_state import AsofBatches, VersionStore, tagged_feeds
from fieldpulse.streaming.summary_state import SummaryBatches, read_late

DAY = dt.datetime(2024, 1, 5)
VERSION = "env string, tenant string, deviceId string, event_ts timestamp, eventTime string, ingestedAt long, lat double, lon double"
LOC = "deviceId string, eventTime string, lat double, lon double, ingestedAt long, sourceTopic string, env string, tenant string"
STA = "deviceId string, eventTime string, rssi int, snr double, battery double, online boolean, ingestedAt long, sourceTopic string, env string, tenant string"


def at(seconds):
    return DAY + dt.timedelta(seconds=seconds)


def folders(spark, root):
    fs, p = sinks._fs(spark, root)
    return sum(1 for s in fs.listStatus(p) if s.isDirectory() and not s.getPath().getName().startswith("_")) if fs.exists(p) else 0


def test_version_store_over_two_hundred_batches(spark, tmp_path):
    """What a look-up reads and what is kept don't grow with the batches; late versions and late look-ups are right."""
    rng, store, every = random.Random(1), VersionStore(str(tmp_path), every=10), 10
    schema, known, read, kept = spark.createDataFrame([], VERSION).schema, [], [], []
    for n in range(200):
        for _ in range(3):
            t = n * 3000 + rng.randrange(3000) - (rng.choice([0, 0, 0, 20_000, 90_000]) if n > 40 else 0)
            known.append(("e", "t", f"d{rng.randrange(4)}", at(t), str(t), n, float(len(known)), 0.0))
    every_row = spark.createDataFrame(known, schema).coalesce(1).persist()
    for n in range(200):
        store.add(every_row.filter(F.col("ingestedAt") == n), n)
        read.append(len(store.folders(spark, n)))
        store.settle(spark, schema, n, int((at(n * 3000) - dt.datetime(1970, 1, 1)).total_seconds() * 1000))
        kept.append(sum(folders(spark, f"{tmp_path}/{p}") for p in ("batches", "newest", "later", "marks")))
    assert max(read) <= every + 2 and max(kept[100:]) <= max(kept[:100]) <= 3 * every + 10
    asked = [(f"d{d}", t) for d in range(4) for t in (0, 50_000, 123_456, 300_000, 420_000, 555_555, 599_000, 700_000)]
    _, cut = store.settled(spark, 200)
    for since in {t for _, t in asked}:
        ms = int((at(since) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
        got = store.read(spark, schema, 199, ms if ms < cut else None).collect()
        for d in range(4):
            best = lambda vs: max(((v[3], v[5], v[6]) for v in vs if v[2] == f"d{d}" and v[3] <= at(since)), default=None)
            want, have = best(known), best(got)
            assert (want and want[:2]) == (have and have[:2])


def test_upsert_table_over_two_hundred_batches(spark, tmp_path):
    """Folders stay few, and the view is the last row a key whatever has been merged and deleted."""
    rng, path, want, seen = random.Random(2), f"{tmp_path}/kv", {}, []
    sink = sinks.upsert_sink(path, "k", compact_every=4, grace_seconds=0)
    batches = [dict((f"k{rng.randrange(60)}", n * 10 + i) for i in range(4)) for n in range(200)]
    every_row = spark.createDataFrame([(k, v) for b in batches for k, v in b.items()], "k string, v long").coalesce(1).persist()
    for n in range(200):
        want.update(batches[n])
        batch = every_row.filter(F.floor(F.col("v") / 10) == n)
        sink(batch, n)
        if n % 7 == 0:
            sink(batch, n)  # replayed
        seen.append(folders(spark, path) + folders(spark, f"{path}.runs"))
        if n % 60 == 59:
            got = {r.k: r.v for r in sinks.read_upsert_view(spark, path, "k").collect()}
            assert got == want
    assert max(seen) <= 4 * 5 + 4
    assert {r.k: r.v for r in sinks.read_upsert_view(spark, path, "k").collect()} == want


def test_covered_folders_wait_for_readers(spark, tmp_path):
    path = f"{tmp_path}/kv"
    sink = sinks.upsert_sink(path, "k", compact_every=3, grace_seconds=3600)
    for n in range(7):
        sink(spark.createDataFrame([("a", n)], "k string, v long").coalesce(1), n)
    assert folders(spark, path) == 7 and sinks.live_folders(spark, path) == ([(0, 2), (3, 5)], [6])
    assert [tuple(r)[:2] for r in sinks.read_upsert_view(spark, path, "k").select("k", "v").collect()] == [("a", 6)]


def reading(device, seconds, online=True, seq=1, value=1.0):
    base = dict.fromkeys(ENRICHED.fieldNames())
    return tuple({**base, "device_id": device, "env": "prod", "tenant": "t1", "humidity": value, "temperature": value, "online": online,
                  "humidity_seq": seq, "measurement_event_ts": at(seconds)}.values())


def test_summary_holds_panes_not_readings(spark, tmp_path):
    body = SummaryBatches(f"{tmp_path}/s", sinks.upsert_sink(f"{tmp_path}/out"))
    for n in range(4):
        data = [reading(f"d{i % 5}", n * 60 + (i % 600) / 10, seq=i) for i in range(3000)]
        body(spark.createDataFrame(data, ENRICHED), n)
    held = spark.read.parquet(f"{tmp_path}/s/devices/batch_id=3").count()
    assert held == 5 * 24 and spark.read.parquet(f"{tmp_path}/s/panes/batch_id=3").count() == 24
    assert folders(spark, f"{tmp_path}/s/devices") == folders(spark, f"{tmp_path}/s/marks") == 2


def test_late_readings_are_kept_and_counted(spark, tmp_path):
    body = SummaryBatches(f"{tmp_path}/s", sinks.upsert_sink(f"{tmp_path}/out"))
    assert read_late(spark, f"{tmp_path}/s").count() == 0
    body(spark.createDataFrame([reading("a", 0), reading("a", 2000)], ENRICHED), 0)       # watermark 1995
    body(spark.createDataFrame([reading("b", 100), reading("c", 1500), reading("d", 1990), reading("e", 1380)], ENRICHED), 1)
    assert [(r.device_id, r.batch_id) for r in read_late(spark, f"{tmp_path}/s").orderBy("device_id").collect()] == [("b", 1), ("e", 1)]
    mark = body.mark(spark, 1)
    assert (mark["dropped"], mark["partly_late"]) == (2, 1)  # c missed some of its windows, d none


# ---- crashes ----------------------------------------------------------------------------------------

class Crash(Exception):
    pass


def crashing(monkeypatch, k):
    """The k-th move or marker from now on fails before it happens (which is after the one before)."""
    calls = [0]

    def wrap(fn):
        def run(*args):
            calls[0] += 1
            if calls[0] == k:
                raise Crash
            return fn(*args)
        return run

    monkeypatch.setattr(sinks, "_move", wrap(sinks._move))
    monkeypatch.setattr(sinks, "commit", wrap(sinks.commit))
    return calls


def crash_everywhere(monkeypatch, root, make, batches, crash_in, result):
    """Run the batches with a crash before every write of one of them in turn, and after the last; each time the
    result is that of an uninterrupted run. ``make(folder)`` gives a job over tables in a folder; the batches before
    the crash run once. Returns how many writes there are."""
    run = make(f"{root}/base")
    for n in range(crash_in):
        run(batches[n], n)
    want, calls = None, [0]
    for k in itertools.count():
        shutil.copytree(f"{root}/base", f"{root}/{k}")
        run = make(f"{root}/{k}")
        for n in range(crash_in, len(batches)):
            if n == crash_in and k:
                with monkeypatch.context() as m:
                    calls = crashing(m, k)
                    try:
                        run(batches[n], n)
                    except Crash:
                        pass
            run(batches[n], n)
        got = result(f"{root}/{k}")
        want = got if want is None else want
        assert got == want, k
        if calls[0] < k:  # nothing has failed this time: the batch was simply replayed
            return calls[0]


def test_summary_survives_a_crash_at_every_write(spark, tmp_path, monkeypatch):
    data = [[reading("a", 0), reading("b", 300)], [reading("a", 900), reading("c", 10)], [reading("b", 1500, False), reading("a", 1500)]]
    batches = [spark.createDataFrame(d, ENRICHED).coalesce(1) for d in data]
    make = lambda p: SummaryBatches(f"{p}/s", sinks.upsert_sink(f"{p}/out", compact_every=2, grace_seconds=0, then="window_end"))

    def result(p):
        view = sinks.read_upsert_view(spark, f"{p}/out", "redis_key", then="window_end").drop("written_at")
        return rows(view), rows(read_late(spark, f"{p}/s"))

    assert crash_everywhere(monkeypatch, tmp_path, make, batches, 1, result) >= 4


def feeds(spark, m=(), l=(), s=()):
    stamp = lambda t: at(t).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    meas = [("d", "prod", "t1", 50.0, 1.0, i, i, stamp(t), stamp(t), 1, 1, at(t), 0) for i, t in m]
    loc = [("d", stamp(t), v, v, int(v), "x", "prod", "t1") for t, v in l]
    sta = [("d", stamp(t), -70, 1.0, 90.0, True, 1, "x", "prod", "t1") for t in s]
    return tagged_feeds(spark.createDataFrame(meas, MEASUREMENT), spark.createDataFrame(loc, LOC), spark.createDataFrame(sta, STA))


def test_asof_survives_a_crash_at_every_write(spark, tmp_path, monkeypatch):
    """Also at the writes of a settlement, and with measurements from before its cut."""
    batches = [feeds(spark, [(1, 100)], [(50, 1.0), (90, 2.0)], [50, 100]), feeds(spark, [(2, 200)], [(200, 3.0), (95, 2.5)], [200]),
               feeds(spark, [(3, 300), (4, 94), (5, 96)], [(300, 4.0)], [300]), feeds(spark, [(6, 400)], [(400, 5.0)], [400])]
    make = lambda p: AsofBatches(f"{p}/s", lambda df, n: sinks.write_batch(df, f"{p}/out", n), delay_ms=0, enrich_ms=F.lit(0), settle_every=1)

    def result(p):
        got = spark.read.schema("humidity_seq long, lat double, rssi int").parquet(f"{p}/out/batch_id=*")
        return sorted((r.humidity_seq, r.lat) for r in got.collect())

    assert crash_everywhere(monkeypatch, tmp_path, make, batches, 2, result) >= 8
    assert result(f"{tmp_path}/0") == [(1, 2.5), (2, 3.0), (3, 4.0), (4, 2.0), (5, 2.5)]


def test_quiet_feeds_hold_unless_told_not_to(spark, tmp_path):
    """A location of 03:30 arrives in the seventh batch: the measurements after it get it, since all feeds hold
    the watermark; with ``idle_batches`` they are emitted ahead, and counted."""
    start = [feeds(spark, [(0, 0)], [(0, 1.0)], [0])] + [feeds(spark, [(n, 60 * n)]) for n in range(1, 6)]
    last = feeds(spark, [(6, 360)], [(210, 2.0), (600, 3.0)], [600])
    for idle in (None, 2):
        root = f"{tmp_path}/{idle}"
        body = AsofBatches(f"{root}/s", lambda df, n: sinks.write_batch(df, f"{root}/out", n), idle_batches=idle, enrich_ms=F.lit(0))
        for n, batch in enumerate([*start, last]):
            body(batch, n)
        got = {r.humidity_seq: r.lat for r in spark.read.schema("humidity_seq long, lat double").parquet(f"{root}/out/batch_id=*").collect()}
        ahead = {r["ahead"] for r in body.marks(spark, 6).values()}
        if idle is None:
            assert [got[n] for n in (3, 4, 5)] == [1.0, 2.0, 2.0] and ahead == {0}
        else:
            assert got[4] == 1.0 and ahead != {0}


def test_fanout_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """A batch of several dates, stopped at each of its writes: readers see nothing of it until it is committed."""
    keyed = lambda *data: spark.createDataFrame(list(data), ENRICHED).withColumn("redis_key", F.col("device_id")).coalesce(1)
    day = 86_400
    first, second = keyed(reading("a", 0), reading("b", 10)), keyed(reading("a", day), reading("b", 2 * day), reading("c", 2 * day + 5))
    paths = lambda p: [f"{p}/{n}" for n in ("enriched", "history", "state")]
    sinks.fanout_enriched(*paths(f"{tmp_path}/base"), compact_every=1, ttl_seconds=None)(first, 0)
    stopped = 0
    for k in range(1, 12):
        shutil.copytree(f"{tmp_path}/base", f"{tmp_path}/{k}")
        t, h, s = paths(f"{tmp_path}/{k}")
        run = sinks.fanout_enriched(t, h, s, compact_every=1, ttl_seconds=None)
        look = lambda: (read_history(spark, h).count(), sinks.read_enriched(spark, t, f"{h}.commits").count(),
                        sinks.read_upsert_view(spark, s, "redis_key", commits=f"{h}.commits").agg(F.max("batch_id")).first()[0])
        with monkeypatch.context() as m:
            crashing(m, k)
            try:
                run(second, 1)
            except Crash:
                stopped += 1
        if stopped < k:
            assert look() == (5, 5, 1)
            break
        assert look() == (2, 2, 0), k
    else:
        raise AssertionError("more writes than expected")
    run(second, 1)  # replayed
    assert stopped >= 5 and look() == (5, 5, 1)


def test_state_of_the_streak_job(spark, tmp_path):
    """The state data source shows one row a device."""
    from fieldpulse.streaming import jobs

    e = flow.enriched_table(spark, SF_SMALL)
    e.write.parquet(f"{tmp_path}/e/batch_id=0")
    jobs.start_streak(spark, f"{tmp_path}/e", f"{tmp_path}/out", {"availableNow": True}, str(tmp_path)).awaitTermination()
    state = spark.read.format("statestore").load(f"{tmp_path}/streams/streak")
    assert state.count() == e.select("env", "tenant", "device_id").distinct().count()
