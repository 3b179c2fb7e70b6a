"""Summary, streak, drought, metrics, latency statistics."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from fieldpulse.operators import latest as LT
from fieldpulse.operators import metrics as MT
from fieldpulse.operators import streak as SK
from fieldpulse.operators import summary as SM
from fieldpulse.plans import flow
from fieldpulse.schemas import ENRICHED


def enriched_rows(spark, items):
    """items: (device, ts, humidity, temperature, online[, tenant]) -> ENRICHED-shaped DataFrame."""
    base = {f.name: None for f in ENRICHED.fields}
    out = []
    for i, it in enumerate(items):
        d, t, h, temp, online = it[:5]
        r = dict(base, device_id=d, env="prod", tenant=it[5] if len(it) > 5 else "t1", humidity=h,
                 temperature=temp, online=online, measurement_event_ts=t, humidity_seq=i,
                 measurement_processing_ts_ms=1000 + i, enriched_processing_ts_ms=2000 + i,
                 humidity_ingested_at=500 + i)
        out.append(tuple(r[f.name] for f in ENRICHED.fields))
    return spark.createDataFrame(out, ENRICHED)


def T(h, m=0, s=0, ms=0, day=5):
    return dt.datetime(2024, 1, day, h, m, s, ms * 1000)


@pytest.fixture(scope="module")
def fixture_enriched(spark):
    return flow.enriched(spark, SF_SMALL).cache()


def test_summary_plans_agree(spark, fixture_enriched):
    base = rows(SM.recent_summary(fixture_enriched, method="direct"))
    for m in ("two_stage", "panes"):
        got = rows(SM.recent_summary(fixture_enriched, method=m))
        assert len(got) == len(base)
        for a, b in zip(got, base):
            assert a[:9] == b[:9] and a[11:] == b[11:]
            for x, y in zip(a[9:11], b[9:11]):
                assert (x is None and y is None) or abs(x - y) < 1e-9


def test_summary_edges(spark):
    df = enriched_rows(spark, [
        ("a", T(10, 0, 5), 40.0, 1.0, True),
        ("a", T(10, 0, 7), 42.0, None, False),    # same device online and offline -> counted in both
        ("b", T(10, 0, 9), None, 3.0, None),      # null online -> offline; null humidity skipped
        ("c", T(10, 10, 0), 50.0, 5.0, True),     # exactly on a window edge
    ])
    for method in ("direct", "two_stage", "panes"):
        s = SM.recent_summary(df, method=method)
        w = {r.window_start: r for r in s.collect()}
        r = w[T(10, 0, 0)]
        # distinct devices a, b; a is both online and offline; b's null online is offline
        assert (r.totalDevices, r.onlineDevices, r.offlineDevices) == (2, 1, 2)
        assert r.avgTemp == pytest.approx(2.0) and r.avgHumidity == pytest.approx(41.0)
        assert r.windowSeconds == 600 and r.window_end == T(10, 10, 0)
        assert T(9, 50, 0) not in w  # ends at 10:00:00, before the first row
        # the row at 10:10:00 opens windows starting 10:00:10 .. 10:10:00, not the 10:00:00 one
        assert w[T(10, 10, 0)].totalDevices == 1 and w[T(10, 0, 10)].totalDevices == 1
        assert len(w) == 120  # 09:50:10..10:00:00 for the first rows, 10:00:10..10:10:00 for the edge row


def test_latest_summary_is_newest_window(spark):
    df = enriched_rows(spark, [("a", T(10), 40.0, 1.0, True), ("b", T(12), 40.0, 1.0, True, "t2")])
    latest = {r.redis_key: r.window_start for r in SM.latest_summary(SM.recent_summary(df)).collect()}
    assert latest == {"prod:t1": T(10), "prod:t2": T(12)}
    # only windows the watermark (max ts 12:00 - 5 s) has closed reach the sink
    closed = {r.redis_key: (r.window_start, r.window_end)
              for r in SM.latest_summary(SM.recent_summary(df), df).collect()}
    # t2's only reading (12:00) opens windows ending after 12:00: none closed yet
    assert closed == {"prod:t1": (T(10), T(10, 10))}


def test_streak_rules(spark):
    df = enriched_rows(spark, [
        ("never", T(1), 10.0, 0.0, True), ("never", T(3), 20.0, 0.0, True),           # from first: 2 h
        ("lastok", T(1), 10.0, 0.0, True), ("lastok", T(5), 60.0, 0.0, True),         # last ok -> 0
        ("exact", T(1), 50.0, 0.0, True), ("exact", T(2), 10.0, 0.0, True),           # 50.0 is ok
        ("nullh", T(1), 55.0, 0.0, True), ("nullh", T(4), None, 0.0, True),           # null not ok
        ("single", T(1), 5.0, 0.0, True),
        ("subsec", T(1, 0, 0, 900), 60.0, 0.0, True), ("subsec", T(1, 0, 1, 800), 1.0, 0.0, True),
    ])
    got = {r.device_id: r for r in SK.low_humidity_streak(df).collect()}
    assert got["never"].streak_days == pytest.approx(2 / 24)
    assert got["lastok"].streak_days == 0.0 and got["lastok"].last_humidity == 60.0
    assert got["exact"].streak_days == pytest.approx(1 / 24)
    assert got["nullh"].streak_days == pytest.approx(3 / 24) and got["nullh"].last_humidity is None
    assert got["single"].streak_days == 0.0
    assert got["subsec"].streak_days == 0.0  # 0.9 s elapsed -> 0 whole seconds
    assert got["never"].redis_key == "pvz:prod:t1:device:never:humidity_low_streak"
    assert got["never"].threshold == 50.0


def _newest(fixture_enriched):
    """Per device: its rows, oldest first."""
    by = {}
    for r in fixture_enriched.collect():
        by.setdefault((r.env, r.tenant, r.device_id), []).append(r)
    return {k: sorted(v, key=lambda r: (r.measurement_event_ts, r.humidity_seq)) for k, v in by.items()}


def test_streak_against_brute_force(spark, fixture_enriched):
    got = {(r.env, r.tenantId, r.device_id): r for r in SK.low_humidity_streak(fixture_enriched).collect()}
    want = _newest(fixture_enriched)
    assert set(got) == set(want) and want
    for k, seen in want.items():
        ok = [r.measurement_event_ts for r in seen if r.humidity is not None and r.humidity >= 50.0]
        since, last = (ok or [seen[0].measurement_event_ts])[-1], seen[-1]
        assert got[k].streak_days == pytest.approx(int((last.measurement_event_ts - since).total_seconds()) / 86400)
        assert (got[k].last_humidity, got[k].last_event_ts) == (last.humidity, last.measurement_event_ts)


def test_latest_against_brute_force(spark, fixture_enriched):
    want = sorted(tuple(v[-1]) for v in _newest(fixture_enriched).values())
    assert sorted(tuple(r) for r in LT.latest_per_device(fixture_enriched).collect()) == want


def test_latest_by_ties_nulls_and_negative_order(spark):
    df = spark.createDataFrame([("a", 1, -5, "x"), ("a", 1, 7, "y"), ("a", None, 9, "z"), ("b", None, None, "n"), (None, 3, 1, "k"), (None, 3, 1, "k"),
                                ("c", 2, 2, "p"), ("c", 2, 2, "q")], "k string, t long, s long, v string")
    got = {r.k: r.v for r in LT.latest_by(df, ["k"], ["t", "s"]).collect()}
    assert (got["a"], got["b"], got[None]) == ("y", "n", "k") and got["c"] in "pq" and len(got) == 4


def test_drought_summary(spark):
    st = spark.createDataFrame(
        [("prod", "t1", "d2", 50.0, 3.0), ("prod", "t1", "d1", 50.0, 3.0), ("prod", "t1", "d3", 50.0, 0.0),
         ("prod", "t2", "d4", 50.0, 0.0), ("prod", "t2", "d5", 50.0, None)],
        "env string, tenantId string, device_id string, threshold double, streak_days double")
    got = {r.tenantId: r for r in SK.drought_level(SK.drought_summary(st)).collect()}
    t1, t2 = got["t1"], got["t2"]
    assert (t1.devicesInDrought, t1.maxStreakDays, t1.maxDeviceId, t1.droughtLevel) == (2, 3.0, "d1", "warn")
    assert (t2.devicesInDrought, t2.maxStreakDays, t2.maxDeviceId, t2.droughtLevel) == (0, 0.0, None, "ok")
    bad = SK.drought_level(SK.drought_summary(st.withColumn("streak_days", F.lit(10.0)))).collect()
    assert {r.droughtLevel for r in bad} == {"bad"}


def test_metrics_buckets(spark):
    df = enriched_rows(spark, [("a", T(10, 5, day=3), 40.0, 1.0, True), ("a", T(10, 55, day=3), 60.0, 3.0, None),
                               ("a", T(11, 0, day=7), 10.0, 5.0, False)])
    hour = {r.bucket: r for r in MT.metrics_by_bucket(df, "HOUR").collect()}
    r = hour[T(10, day=3)]
    assert (r.tAvg, r.hAvg, r.totalCount, r.okCount, r.errorCount) == (2.0, 50.0, 2, 1, 0)
    week = [r.bucket for r in MT.metrics_by_bucket(df, "week").collect()]
    assert week == [dt.datetime(2024, 1, 1)]  # Wed 3rd and Sun 7th: the week of Monday 1st


def test_averages_do_not_follow_the_order_of_rows(spark):
    values = [*np.random.default_rng(0).uniform(-30, 60, 59).round(2).tolist(), None]
    means = set()
    for vals in (values, values[::-1], sorted(values, key=lambda v: v or 0)):
        rows = enriched_rows(spark, [("a", T(10, k), v, v, True) for k, v in enumerate(vals)]).coalesce(1)
        means.add(tuple(MT.metrics_by_bucket(rows, "HOUR").select("tAvg", "hAvg", "totalCount").first()))
    known = [v for v in values if v is not None]
    assert means == {(math.fsum(known) / len(known), math.fsum(known) / len(known), 60)}


@pytest.mark.parametrize("values, mean", [([None, None], None), ([float("inf"), 1.5], float("inf")), ([1e300, 1e300], 1e300),
                                          ([0.1], 0.1), ([float("inf"), float("-inf")], None), ([float("nan"), 1.0], None)])
def test_average_of_odd_values(spark, values, mean):
    got, plain = spark.createDataFrame([(v,) for v in values], "v double").agg(MT.average("v"), F.avg("v")).first()
    assert got == plain == mean or mean is None and (got is plain is None or math.isnan(got) and math.isnan(plain))


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(3)
    vals = rnd.integers(-50, 500, size=997).tolist() + [7] * 300  # heavy duplicates
    df = spark.createDataFrame([(int(v) % 3, int(v)) for v in vals], "g int, x long")
    out = {r.g: r for r in MT.exact_stats(df, ["g"], ("x",)).collect()}
    for g in (0, 1, 2):
        xs = np.array([v for v in vals if v % 3 == g], dtype=float)
        r = out[g]
        assert r.samples == len(xs)
        assert r.mean == pytest.approx(xs.mean())
        assert r.p50 == pytest.approx(np.quantile(xs, 0.5))
        assert r.p95 == pytest.approx(np.quantile(xs, 0.95))


def test_latency_stats_columns(spark):
    h = flow.history(spark, SF_SMALL)
    out = MT.latency_stats(h).collect()[0].asDict()
    assert out["samples"] == h.count()
    for m in MT.LATENCIES:
        assert out[f"p50_{m}_ms"] <= out[f"p95_{m}_ms"]
    assert out["mean_create_to_postgres_ms"] > out["mean_create_to_enriched_ms"] > out["mean_create_to_measurement_ms"]


@pytest.mark.parametrize("bucket_panes", [60, 97, 360])
def test_panes_first_occurrence_across_buckets(spark, bucket_panes):
    import random
    rnd = random.Random(bucket_panes)
    items = []
    for i in range(700):  # a dense device (every 10 s, with gaps) and sparse ones
        if rnd.random() < 0.8:
            items.append(("dense", T(10) + dt.timedelta(seconds=10 * i + rnd.randrange(10)), 40.0 + i % 20,
                          float(i % 7), rnd.random() < 0.5))
    for i in range(120):
        items.append((f"s{i % 9}", T(10) + dt.timedelta(seconds=rnd.randrange(7000)), 55.0, 1.0,
                      rnd.choice([True, False, None])))
    df = enriched_rows(spark, items)
    want = rows(SM.recent_summary(df, method="direct"), "window_start", "totalDevices", "onlineDevices",
                "offlineDevices", "minEventTs", "maxEventTs")
    got = rows(SM.recent_summary_panes(df, bucket_panes=bucket_panes), "window_start", "totalDevices",
               "onlineDevices", "offlineDevices", "minEventTs", "maxEventTs")
    assert got == want


def test_latest_closed_summary_fast_path(spark, fixture_enriched):
    slow = rows(SM.latest_summary(SM.recent_summary(fixture_enriched), fixture_enriched))
    fast = rows(SM.latest_closed_summary(fixture_enriched))
    assert len(fast) == len(slow) > 0
    for a, b in zip(fast, slow):
        assert a[:9] == b[:9] and a[11:] == b[11:]
        assert all((x is None and y is None) or abs(x - y) < 1e-9 for x, y in zip(a[9:11], b[9:11]))


def test_append_results_accumulates(spark, tmp_path):
    h = flow.history(spark, SF_SMALL)
    path = str(tmp_path / "latency")
    for prefix in ("device-", "nope-"):
        MT.append_results(MT.latency_stats(h, prefix=prefix).withColumn("prefix", F.lit(prefix)), path)
    got = {r.prefix: r.samples for r in spark.read.parquet(path).collect()}
    assert got["device-"] == h.count() and got["nope-"] == 0


def test_latest_closed_summary_edges(spark):
    df = enriched_rows(spark, [
        ("a", T(9, 0, 3), 40.0, 1.0, True), ("b", T(9, 5, 0), 60.0, 3.0, False),   # t1: old readings
        ("c", T(11, 59, 58), 50.0, 2.0, True, "t2"),                               # t2: after the cutoff
        ("d", T(11, 55, 1), 20.0, 4.0, None, "t3"), ("e", T(11, 59, 59), 30.0, 5.0, True, "t3"),
    ])  # max ts 11:59:59 -> cutoff 11:59:54 -> aligned 11:59:50
    slow = {r.redis_key: r for r in SM.latest_summary(SM.recent_summary(df, method="direct"), df).collect()}
    fast = {r.redis_key: r for r in SM.latest_closed_summary(df).collect()}
    assert set(fast) == set(slow) == {"prod:t1", "prod:t3"}          # t2 has no closed window yet
    assert (fast["prod:t1"].window_start, fast["prod:t1"].window_end) == (T(9, 5), T(9, 15))
    assert fast["prod:t1"].totalDevices == 1                          # only b's reading is in it
    assert (fast["prod:t3"].window_end, fast["prod:t3"].totalDevices) == (T(11, 59, 50), 1)  # capped
    for k in fast:
        assert tuple(fast[k]) == tuple(slow[k])
    resp = SV_recent(spark, df)
    assert (resp.totalDevices, resp.avgHumidity) == (1, 20.0)


def SV_recent(spark, df):
    from fieldpulse.plans import serving as SV
    return SV.recent_summary_from_rows(spark, df, "prod", "t3").collect()[0]
