"""History clustered by device, the newest window from its newest dates, and quantiles by radix selection."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from fieldpulse.operators import summary as SM
from fieldpulse.operators.latest import latest_by
from fieldpulse.operators.metrics import exact_stats
from fieldpulse.plans import flow, serving
from fieldpulse.sources import history as H
from fieldpulse.streaming.sinks import compact_history_dates


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("h") / "history")
    e = flow.enriched_table(spark, SF_SMALL)
    H.write_history(e, path, F.to_timestamp(F.lit("2024-06-01")), rows_per_writer=max(1, e.count() // 8))
    return path, e


def test_a_device_is_in_one_file_a_date(spark, table):
    path, e = table
    files = spark.read.schema(H.HISTORY_SCHEMA).parquet(path).select("event_date", "env", "tenant", "device_id", F.input_file_name().alias("f"))
    per = files.groupBy("event_date", "env", "tenant", "device_id").agg(F.count_distinct("f").alias("n"))
    spread = {r.n: r["count"] for r in per.groupBy("n").count().collect()}
    assert set(spread) <= {1, 2} and spread.get(2, 0) <= 8  # two at most where a range is cut
    assert files.select("f").distinct().count() > files.select("event_date").distinct().count()
    assert rows(H.read_history(spark, path).select(*e.columns)) == rows(e)


def test_hot_device_and_date_have_several_writers(spark, tmp_path):
    e = flow.enriched_table(spark, SF_SMALL).withColumn("device_id", F.lit("one")).withColumn(
        "measurement_event_ts", F.to_timestamp(F.lit("2024-05-01")) + F.make_dt_interval(secs=F.pmod("humidity_seq", F.lit(80000)).cast("decimal(18,6)")))
    H.write_history(e, str(tmp_path / "h"), F.to_timestamp(F.lit("2024-06-01")), rows_per_writer=max(1, e.count() // 6))
    assert len(spark.read.parquet(str(tmp_path / "h")).inputFiles()) >= 4


def test_compaction_can_be_repeated(spark, table, tmp_path):
    path, e = table
    dates, into = H.newest_dates(spark, path)[:2], str(tmp_path / "compact")
    for _ in range(2):
        compact_history_dates(spark, path, into, dates)
    want = H.read_history(spark, path).filter(F.col("event_date").cast("string").isin(*dates))
    assert rows(H.read_history(spark, into)) == rows(want)


def test_newest_window_from_the_newest_dates(spark, table, monkeypatch):
    path, e = table
    latest = SM.latest_closed_summary(e)
    for tenant in ("tenant-1", "tenant-2", "tenant-3", "nobody"):
        assert rows(serving.recent_summary_from_history(spark, path, "prod", tenant)) == rows(serving.recent_summary_for(spark, latest, "prod", tenant))
    read = []
    real = H.read_history
    monkeypatch.setattr(H, "read_history", lambda *a, **k: read.append(real(*a, **k)) or read[-1])
    assert H.last_reading(spark, path) is not None and len(read) == 1
    assert H.last_reading(spark, path, None, "prod", "nobody") is None
    assert len(read) <= 2 + int(np.log2(len(H.newest_dates(spark, path)) + 1)) + 1


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 44, None])
def test_radix_selection_in_one_to_four_rounds(spark, scale):
    rng = random.Random(4)
    data = [(f"g{i % 3}", rng.randint(-50, 900) * (scale or 1) + rng.randint(0, 99)) for i in range(700)] + [("g1", None), ("lonely", 7 * (scale or 1))]
    if scale is None:
        data += [("g0", -(1 << 63)), ("g0", (1 << 63) - 1)]
    df = spark.createDataFrame(data, "g string, m long")
    stats = exact_stats(df, ["g"], ("m",))
    assert "Window" not in stats._jdf.queryExecution().executedPlan().toString()
    if scale is None:  # sums of such numbers don't fit; the picked values must
        stats = stats.drop("mean")
        data = [d for d in data if d[0] != "g0"]
        got = {r.g: r for r in stats.filter("g <> 'g0'").collect()}
    else:
        got = {r.g: r for r in stats.collect()}
    for g in {d[0] for d in data}:
        v = np.array([x for k, x in data if k == g and x is not None], dtype=float)
        assert got[g].samples == len(v)
        assert np.allclose([got[g].p50, got[g].p95], np.quantile(v, [0.5, 0.95]), rtol=1e-12)


def test_no_rows_no_statistics(spark):
    assert exact_stats(spark.createDataFrame([], "g string, m long"), ["g"], ("m",)).count() == 0


def test_latest_settles_ties_among_few(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), (None, 3, "n"), (None, 1, "m")], "k string, o long, v string")
    got = sorted((tuple(r) for r in latest_by(df, ["k"], ["o"]).collect()), key=str)
    assert [r[:2] for r in got] == [("a", 2), ("b", None), (None, 3)] and got[0][2] in ("y", "z")
    plan = latest_by(df, ["k"], ["o"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
