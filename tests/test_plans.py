"""Plan-shape guards: the physical plans keep the properties the design relies on at scale."""

import re

from conftest import SF_SMALL
from fieldpulse.operators import streak as SK
from fieldpulse.plans import flow
from fieldpulse.sources import fixtures as FX


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parsing_is_shuffle_free(spark):
    for kind in ("humidity", "state"):
        assert "Exchange" not in plan(flow.typed_from_raw(spark, SF_SMALL, kind))
    assert "Exchange" not in plan(flow.errors_from_raw(spark, SF_SMALL))


def test_asof_main_pass_is_keyed_by_device_bucket_salt(spark):
    p = plan(flow.enriched(spark, SF_SMALL))
    assert re.search(r"Exchange hashpartitioning\(_k0#\d+, _k1#\d+, _k2#\d+, _b#\d+L, _salt#\d+", p)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def final_plan(df) -> str:
    """The plan as AQE leaves it after a run."""
    df.write.format("noop").mode("overwrite").save()
    rows = df._jdf.queryExecution()
    df.collect()
    return rows.executedPlan().toString().split("== Initial Plan ==")[0]


def test_asof_shuffles(spark):
    """At most four shuffles: bucket table, its window, the rows, the inherited versions."""
    p = final_plan(flow.enriched(spark, SF_SMALL))
    assert len(set(re.findall(r"Exchange hashpartitioning\(.*plan_id=(\d+)\]", p))) <= 4


def test_measurement_join_has_two_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(flow.measurement.__wrapped__(spark, SF_SMALL)).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))


def test_downstream_queries_scan_only_their_columns(spark):
    from fieldpulse.plans.catalog import QUERIES
    for name in ("metrics_day", "low_humidity_streak", "recent_summary", "latency_stats", "hop_window"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "FileScan parquet" in p and "ExistingRDD" not in p, name
        assert all(len(s.split(",")) < 20 for s in re.findall(r"ReadSchema: struct<([^\n]*)", p)), name


def test_raw_feed_is_read_once(spark):
    p = plan(flow.parse_all(flow.route_by_topic(FX.raw_messages(spark, SF_SMALL))))
    assert p.count("FileScan") == 1 and "Exchange" not in p


def test_latency_has_no_window_over_a_whole_group(spark):
    from fieldpulse.plans.catalog import QUERIES
    p = plan(QUERIES["latency_stats"](spark, SF_SMALL))
    assert all("bin" in w for w in re.findall(r"windowspecdefinition\(([^)]*)\)", p)) and "bin" in p


def test_streak_is_a_hash_aggregate(spark):
    p = plan(SK.low_humidity_streak(flow.enriched_table(spark, SF_SMALL)))
    assert "HashAggregate" in p and "SortAggregate" not in p and "Window" not in p


def test_no_pairwise_joins_in_registered_batch_queries(spark):
    import __spark_entry__ as E
    from fieldpulse.plans.catalog import QUERIES
    for name, fn in E.queries().items():
        if name not in QUERIES or name.startswith("stream_"):
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name  # no Python UDFs


def test_asof_moves_whole_rows_once(spark):
    """Neither the salts nor what buckets inherit are joined by sorting the readings, whatever is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan(flow.enriched.__wrapped__(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))


def test_summary_expands_tenants_panes_not_devices(spark):
    from fieldpulse.operators import summary as SM
    p = plan(SM.recent_summary(flow.enriched_table(spark, SF_SMALL)))
    assert len(re.findall(r"Generate explode\(sequence", p)) == 1


def test_tables_are_written_by_compiled_methods(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from fieldpulse.session import written
    from fieldpulse.streaming.sinks import write_batch
    key, seen, parquet = "spark.sql.codegen.hugeMethodLimit", [], DataFrameWriter.parquet
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **kw: (seen.append(spark.conf.get(key)), parquet(self, *a, **kw)))
    written(spark.range(2), "two")
    write_batch(spark.range(2), str(tmp_path / "t"), 0)
    assert seen == ["8000", "8000"] and spark.conf.get(key) == before
