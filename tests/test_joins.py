"""J1 measurement join and the bucketed as-of join (J2/J3)."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from fieldpulse.operators.asof import asof_latest
from fieldpulse.operators.measurement import join_measurement

H = "deviceId string, eventTime string, humidity double, seq long, ingestedAt long, sourceTopic string"
TT = "deviceId string, eventTime string, temperature double, seq long, ingestedAt long, sourceTopic string"


def ts(s):
    return f"2024-01-05T{s}Z"


def test_join_duplicates_multiply_and_seq_restart(spark):
    h = spark.createDataFrame([("d", ts("10:00:00.000"), 40.0, 1, 1, "h"), ("d", ts("10:00:00.000"), 41.0, 1, 2, "h"),
                               ("d", ts("12:00:00.000"), 42.0, 2, 3, "h")], H)
    t = spark.createDataFrame([("d", ts("10:00:00.100"), 5.0, 1, 1, "t"),
                               ("d", ts("11:59:59.000"), 6.0, 2, 2, "t"),
                               ("d", ts("09:00:00.000"), 7.0, 2, 3, "t")], TT)  # seq 2 reused by a restart
    m = join_measurement(h, t, processing_ms=F.lit(0))
    assert m.count() == 2 + 2  # distinct readings pair up: (seq 1: 2x1) + (seq 2: 1x2)
    got = rows(m, "humidity", "temperature")
    assert got == [(40.0, 5.0), (41.0, 5.0), (42.0, 6.0), (42.0, 7.0)]
    # the optional time bound drops the partner from the earlier run
    bounded = join_measurement(h, t, processing_ms=F.lit(0), max_time_skew="1 hour")
    assert rows(bounded, "humidity", "temperature") == [(40.0, 5.0), (41.0, 5.0), (42.0, 6.0)]
    # event time is the humidity reading's
    assert {r.measurement_event_ts.hour for r in m.collect()} == {10, 12}


def test_join_collapses_exact_copies(spark):
    row = ("d", ts("10:00:00.000"), 40.0, 1, 1, "h")
    h = spark.createDataFrame([row, row[:4] + (5, "h"), row], H)          # 3 deliveries of one reading
    t = spark.createDataFrame([("d", ts("10:00:00.100"), 5.0, 1, 2, "t")] * 2, TT)
    m = join_measurement(h, t, processing_ms=F.lit(0), copies="collapse")
    assert [(r.humidity, r.temperature, r.humidity_ingested_at) for r in m.collect()] == [(40.0, 5.0, 1)]
    assert join_measurement(h, t, processing_ms=F.lit(0)).count() == 6  # by default copies multiply


def test_asof_keeps_tenants_apart(spark):
    ev = spark.createDataFrame([("a", "d", _t(10, 0), 1), ("b", "d", _t(10, 0), 2), (None, "d", _t(10, 0), 3)], "tenant string, device_id string, ts timestamp, id long")
    vv = spark.createDataFrame([("b", "d", _t(9, 0), 1, "b9"), (None, "d", _t(8, 0), 1, "n8")], "tenant string, device_id string, event_ts timestamp, ingestedAt long, v string")
    out = asof_latest(ev, {"x": (vv, ["v"])}, keys=["tenant", "device_id"], ts="ts")
    assert {r.id: r.x and r.x.v for r in out.collect()} == {1: None, 2: "b9", 3: "n8"}


def _asof_inputs(spark, events, versions):
    ev = spark.createDataFrame(events, "device_id string, ts timestamp, id long")
    vv = spark.createDataFrame(versions, "device_id string, event_ts timestamp, ingestedAt long, v string")
    return ev, vv


def _t(h, m, s=0, ms=0):
    import datetime
    return datetime.datetime(2024, 1, 5, h, m, s, ms * 1000)


@pytest.mark.parametrize("bucket_seconds", [1, 60, 3600, 86400 * 30])
def test_asof_edges(spark, bucket_seconds):
    events = [("a", _t(9, 0), 1),      # no version yet
              ("a", _t(10, 0), 2),     # version at exactly this time -> visible
              ("a", _t(10, 30), 3),    # two versions at 10:15 -> the later-ingested one
              ("a", _t(12, 0), 4),     # carried across many buckets; 13:00 version is after
              ("b", _t(10, 0), 5)]     # other device: its own history only
    versions = [("a", _t(10, 0), 1, "v10"), ("a", _t(10, 15), 3, "v1015-late"),
                ("a", _t(10, 15), 2, "v1015-early"), ("a", _t(13, 0), 4, "v13"),
                ("b", _t(8, 0), 1, "b8")]
    ev, vv = _asof_inputs(spark, events, versions)
    out = asof_latest(ev, {"x": (vv, ["v"])}, keys=["device_id"], ts="ts", bucket_seconds=bucket_seconds)
    got = {r.id: (r.x.v if r.x is not None else None) for r in out.collect()}
    assert got == {1: None, 2: "v10", 3: "v1015-late", 4: "v1015-late", 5: "b8"}


def test_asof_matches_brute_force_on_random_data(spark):
    rnd = random.Random(7)
    events, versions = [], []
    for i in range(400):
        d = f"d{rnd.randrange(5)}"
        events.append((d, _t(rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)), i))
    for j in range(150):
        d = f"d{rnd.randrange(6)}"
        versions.append((d, _t(rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)), j, f"v{j}"))
    ev, vv = _asof_inputs(spark, events, versions)

    def brute(e):
        cands = [v for v in versions if v[0] == e[0] and v[1] <= e[1]]
        return max(cands, key=lambda v: (v[1], v[2]))[3] if cands else None

    want = {e[2]: brute(e) for e in events}
    for bucket, max_rows in ((30, 10**9), (600, 10**9), (7200, 10**9), (7200, 3), (86400, 1)):
        # max_rows small: every bucket is "hot" and salted (versions copied to each salt)
        out = asof_latest(ev, {"x": (vv, ["v"])}, keys=["device_id"], ts="ts", bucket_seconds=bucket,
                          max_rows_per_bucket=max_rows)
        got = {r.id: (r.x.v if r.x is not None else None) for r in out.collect()}
        assert got == want


def test_asof_enriched_fixture_counts(spark):
    from fieldpulse.plans import flow
    e = flow.enriched(spark, SF_SMALL)
    m = flow.measurement(spark, SF_SMALL)
    assert e.count() == m.count()
    # every enriched row's location version is not after the measurement
    bad = e.filter(F.col("location_event_time").isNotNull()
                   & (F.to_timestamp(F.regexp_replace(F.regexp_replace("location_event_time", "T", " "), "Z", ""))
                      > F.col("measurement_event_ts")))
    assert bad.count() == 0
