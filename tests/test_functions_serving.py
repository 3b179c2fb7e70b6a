"""Lenient decoders, key functions, TTL, serving queries, history layout, entry points."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fieldpulse.functions import keys as K
from fieldpulse.functions import lenient as LN
from fieldpulse.operators import latest as LT
from fieldpulse.operators import streak as SK
from fieldpulse.operators import summary as SM
from fieldpulse.plans import flow
from fieldpulse.plans import serving as SV


def one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_lenient_ts_millis(spark):
    vals = ["9999999999", "10000000000", "2024-01-05T10:00:00Z", "2024-01-05T10:00:00", "2024-01-05T10:00",
            "", "  ", "text", None, "2024-01-05", "2024-01-05 10:00:00", "2024-01-05T11:00:00+01:00"]
    got = dict(zip(vals, [r[0] for r in one_col(spark, vals).select(LN.lenient_ts_millis(F.col("v"))).collect()]))
    ms = 1704448800000
    assert got["9999999999"] == 9999999999000 and got["10000000000"] == 10000000000
    assert got["2024-01-05T10:00:00Z"] == ms and got["2024-01-05T10:00:00"] == ms
    assert got["2024-01-05T10:00"] == ms and got["2024-01-05T11:00:00+01:00"] == ms
    for v in ("", "  ", "text", None, "2024-01-05", "2024-01-05 10:00:00"):
        assert got[v] is None


def test_lenient_numbers_and_bools(spark):
    vals = ["1", " 2", "x", "", "3.5", "TRUE", "off", "Yes", "maybe", "0"]
    df = one_col(spark, vals).select(
        "v", LN.lenient_int(F.col("v")).alias("i0"), LN.lenient_int_or_null(F.col("v")).alias("i"),
        LN.lenient_long_or_null(F.col("v")).alias("l"), LN.lenient_double_or_null(F.col("v")).alias("d"),
        LN.lenient_bool_or_null(F.col("v")).alias("b"))
    got = {r.v: (r.i0, r.i, r.l, r.d, r.b) for r in df.collect()}
    assert got["1"] == (1, 1, 1, 1.0, True)
    assert got[" 2"] == (0, None, None, 2.0, None)
    assert got["x"] == (0, None, None, None, None)
    assert got[""] == (0, None, None, None, None)
    assert got["3.5"] == (0, None, None, 3.5, None)
    assert got["TRUE"][4] is True and got["Yes"][4] is True and got["off"][4] is False
    assert got["maybe"][4] is None and got["0"][4] is False


def test_keys(spark):
    df = spark.createDataFrame([("prod", "t1", "d:1")], "env string, tenant string, d string")
    r = df.select(K.build_key_state(F.col("env"), F.col("tenant"), F.col("d")).alias("s"),
                  K.build_key_streak(F.col("env"), F.col("tenant"), F.col("d")).alias("k"),
                  K.build_key_summary(F.col("env"), F.col("tenant")).alias("m"),
                  K.build_key_state(F.col("env"), F.lit(None).cast("string"), F.col("d")).alias("n")).first()
    assert r.s == "pvz:prod:t1:device:d:1:state" and r.m == "prod:t1" and r.n is None
    assert r.k == "pvz:prod:t1:device:d:1:humidity_low_streak"
    keys = ["pvz:p:t:device:abc:state", "pvz:p:t:device::state", "pvz:p:t:devices:state",
            "pvz:p:t:device:a:state:x:state", "pvz:p:t:device:z:humidity_low_streak", None]
    got = one_col(spark, keys).select("v", K.device_from_state_key(F.col("v")).alias("s"),
                                      K.device_from_streak_key(F.col("v")).alias("k")).collect()
    m = {r.v: (r.s, r.k) for r in got}
    assert m["pvz:p:t:device:abc:state"] == ("abc", None)
    assert m["pvz:p:t:device::state"] == (None, None)
    assert m["pvz:p:t:devices:state"] == (None, None)
    assert m["pvz:p:t:device:a:state:x:state"] == ("a:state:x", None)  # last ':state'
    assert m["pvz:p:t:device:z:humidity_low_streak"] == (None, "z")


def test_view_ttl_boundary(spark):
    as_of = dt.datetime(2024, 1, 5, 12, 0, 0)
    df = spark.createDataFrame([(k, as_of - dt.timedelta(seconds=s)) for k, s in (("a", 599), ("b", 600), ("c", 601))],
                               "k string, written_at timestamp")
    alive = [r.k for r in LT.view_ttl(df, F.lit(as_of)).collect()]
    assert alive == ["a"]


@pytest.fixture(scope="module")
def views(spark):
    e = flow.enriched(spark, SF_SMALL).cache()
    return e, LT.latest_state_view(e).cache(), SK.low_humidity_streak(e).cache(), \
        SM.latest_summary(SM.recent_summary(e)).cache()


def test_serving_queries(spark, views):
    e, state, streaks, summary = views
    n_dev = e.select("device_id").distinct().count()
    assert SV.devices(state).count() == n_dev
    one = state.first()
    d = SV.device(state, one.env, one.tenant, one.device_id).collect()
    assert len(d) == 1 and d[0].tsHt == int(one.measurement_event_ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert SV.device(state, one.env, one.tenant, "nope").count() == 0
    snaps = SV.recent_snapshots(state).collect()
    assert all(s.lastSeenTs >= 0 for s in snaps)
    pts = SV.map_points(state).collect()
    assert all(p.lat is not None for p in pts)
    assert {p.marker for p in pts} <= {"online", "offline"}
    empty = SV.recent_summary_for(spark, summary, "prod", "no-such-tenant").collect()[0]
    assert (empty.totalDevices, empty.onlineDevices, empty.offlineDevices, empty.avgTemp, empty.windowSeconds) == \
        (0, 0, 0, None, 600)
    found = SV.recent_summary_for(spark, summary, "prod", "tenant-1").collect()[0]
    assert found.totalDevices >= 1
    dr = SV.drought_summary_for(spark, streaks, "prod", "no-such-tenant").collect()[0]
    assert (dr.threshold, dr.devicesInDrought, dr.maxStreakDays, dr.maxDeviceId, dr.droughtLevel) == \
        (None, 0, 0.0, None, "ok")
    ds = SV.drought_streak(streaks, one.env, one.tenant, one.device_id).collect()
    assert len(ds) == 1


def test_device_metrics_range_rules(spark, views):
    e = views[0]
    one = e.orderBy("measurement_event_ts").first()
    t0 = int(one.measurement_event_ts.replace(tzinfo=dt.timezone.utc).timestamp())
    pts = SV.device_metrics(e, one.env, one.tenant, one.device_id, "DAY", t0 - 10, t0 + 86400 * 40).collect()
    assert pts and pts[0].ts <= t0 and [p.ts for p in pts] == sorted(p.ts for p in pts)
    # from >= to: fall back to the default look-back (30 days back from as_of)
    as_of = F.lit(one.measurement_event_ts + dt.timedelta(days=1))
    back = SV.device_metrics(e, one.env, one.tenant, one.device_id, "DAY", t0 + 5, t0, as_of=as_of).collect()
    assert back and back[0].ts <= t0


def test_history_write_and_pruned_scan(spark, tmp_path, views):
    from fieldpulse.sources.history import scan_history, write_history
    e = views[0]
    path = str(tmp_path / "history")
    write_history(e, path, inserted_at=F.timestamp_millis(F.col("enriched_processing_ts_ms") + 400))
    one = e.first()
    q = scan_history(spark, path, one.env, one.tenant, one.device_id,
                     one.measurement_event_ts - dt.timedelta(days=1), one.measurement_event_ts)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan and "PushedFilters" in plan
    assert q.filter(F.col("measurement_event_ts") == one.measurement_event_ts).count() >= 1
    assert spark.read.parquet(path).count() == e.count()
    # serving from history: same points as from the enriched rows; the date range prunes
    t0 = int(one.measurement_event_ts.replace(tzinfo=dt.timezone.utc).timestamp())
    args = (one.env, one.tenant, one.device_id, "DAY", t0 - 86400, t0 + 86400)
    h = SV.device_metrics_from_history(spark, path, *args)
    assert h.collect() == SV.device_metrics(e, *args).collect()
    hp = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in hp and "event_date" in hp


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert "redis_key" in df.columns


def test_keys_like_and_latency_runs(spark, views):
    e, state, streaks, _ = views
    from fieldpulse.functions.keys import state_key_pattern, streak_key_pattern
    one = state.first()
    got = SV.keys_like(state, state_key_pattern(one.env, one.tenant))
    assert got.count() == state.filter((F.col("env") == one.env) & (F.col("tenant") == one.tenant)).count()
    assert SV.keys_like(streaks, streak_key_pattern(one.env, one.tenant)).count() > 0
    assert SV.keys_like(state, streak_key_pattern(one.env, one.tenant)).count() == 0
    h = flow.history(spark, SF_SMALL)
    v = spark.createDataFrame([("pvz:prod:t_1:device:a:state",), ("pvz:prod:tx1:device:a:state",), ("pvz:prod:t%:device:a:state",)], "redis_key string")
    assert [r[0] for r in SV.keys_like(v, state_key_pattern("prod", "t_1")).collect()] == ["pvz:prod:t_1:device:a:state"]
    assert [r[0] for r in SV.keys_like(v, state_key_pattern("prod", "t%")).collect()] == ["pvz:prod:t%:device:a:state"]
    runs = SV.latency_runs(h).collect()
    assert len(runs) == 1 and runs[0].run == "device-" and runs[0].samples == h.count()
    one_run = SV.latency_by_run(h, "device-").collect()[0]
    assert one_run.samples == h.count() and one_run.prefix == "device-"


def test_batch_normalizer_writes_once_and_matches(spark, tmp_path):
    from fieldpulse.sources import fixtures as FX
    out = str(tmp_path / "normalized")
    flow.normalize_to_tables(FX.raw_messages(spark, SF_SMALL), out, ingest_ms=F.unix_millis(F.col("timestamp")))
    for kind in ("humidity", "state"):
        got = flow.read_normalized(spark, out, kind)
        want = flow.typed_from_raw(spark, SF_SMALL, kind)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    errs = sum(flow.read_normalized(spark, out, k, "error").count()
               for k in ("humidity", "temperature", "location", "state"))
    assert errs == flow.errors_from_raw(spark, SF_SMALL).count()
    plan = flow.read_normalized(spark, out, "humidity")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "status" in plan


def test_readme_usage_chain(spark):
    from fieldpulse.operators import asof, measurement, normalize, streak, summary
    from fieldpulse.sources import fixtures as FX
    from fieldpulse.sources.topics import route_by_topic
    routed = route_by_topic(FX.raw_messages(spark, SF_SMALL))
    hum, hum_err = normalize.normalize(routed, "humidity")
    tmp, _ = normalize.normalize(routed, "temperature")
    loc, _ = normalize.normalize(routed, "location")
    sta, _ = normalize.normalize(routed, "state")
    m = measurement.join_measurement(hum, tmp)
    e = asof.asof_enrich(m, loc, sta)
    assert e.count() == m.count() > 0 and hum_err.count() > 0
    assert summary.recent_summary(e).count() > 0 and streak.low_humidity_streak(e).count() > 0
    r = SV.recent_summary_from_rows(spark, e, "prod", "tenant-1").collect()
    assert len(r) == 1


def test_clock_helpers(spark):
    from fieldpulse.functions.clock import greatest_nonneg, processing_ms, range_back
    r = spark.range(1).select(processing_ms(True).alias("s"), processing_ms().alias("ms")).first()
    assert r.s % 1000 == 0 and abs(r.ms - r.s) < 2000       # whole seconds vs milliseconds
    as_of = F.lit(dt.datetime(2024, 7, 1, 12, 0, 0))
    got = spark.range(1).select(*[range_back(as_of, b).alias(b) for b in ("HOUR", "DAY", "WEEK")]).first()
    assert got.HOUR == dt.datetime(2024, 6, 30, 12) and got.DAY == dt.datetime(2024, 6, 1, 12)
    assert got.WEEK == dt.datetime(2024, 1, 1, 12)          # 26 weeks back
    g = spark.createDataFrame([(None, None, None), (5, None, 3), (-4, -2, None)], "a long, b long, c long")
    assert [r[0] for r in g.select(greatest_nonneg(F.col("a"), F.col("b"), F.col("c"))).collect()] == [0, 5, 0]


def test_recent_summary_from_rows_unknown_tenant(spark, views):
    r = SV.recent_summary_from_rows(spark, views[0], "prod", "no-such-tenant").collect()
    assert [(x.totalDevices, x.onlineDevices, x.offlineDevices, x.avgTemp, x.avgHumidity, x.windowSeconds)
            for x in r] == [(0, 0, 0, None, None, 600)]


def test_scratch_is_cleared_by_age(spark):
    from fieldpulse.session import clear_scratch, written
    kept = written(spark.range(3), "scratch-test")
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert clear_scratch(spark, 3600) == [] and kept.count() == 3
    import os
    import time
    folder = path.replace("file://", "")
    os.utime(folder, (time.time() - 7200,) * 2)
    assert [p for p in clear_scratch(spark, 3600)] and not os.path.exists(folder)


def test_package_is_shipped_once_a_context(spark):
    from fieldpulse.session import ship_package
    ship_package(spark)
    assert spark.sparkContext._fieldpulse_shipped is True
