"""Batch flows: the reference's chain of jobs as one DataFrame plan each.

raw feed -> route -> parse (4 kinds, dead letter) -> J1 measurement -> J2/J3 as-of enriched
-> {hop summary, low-humidity streak, latest state, history}.

``clock="fixture"`` swaps every wall-clock stamp for the deterministic stand-ins of
``sources.fixtures`` so results can be compared with an oracle; ``clock="wall"`` is what a
production run uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.operators.asof import LOCATION_FIELDS, STATE_FIELDS, asof_enrich
from fieldpulse.operators.measurement import join_measurement, tenancy, with_event_ts
from fieldpulse.operators.normalize import FIELDS, parse_all
from fieldpulse.schemas import PARSE_ERROR
from fieldpulse.sources import fixtures as FX
from fieldpulse.sources.fixtures import memo_plan
from fieldpulse.sources.topics import route_by_topic
from fieldpulse.session import written


def _clocks(clock: str):
    if clock == "fixture":
        return FX.fixture_measurement_clock, FX.fixture_enrich_clock
    return None, None


def typed_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {k: FX.typed_readings(spark, sf_dir, k) for k in ("humidity", "temperature", "location", "state")}


@memo_plan
def measurement(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    t = typed_inputs(spark, sf_dir)
    m_clock, _ = _clocks(clock)
    return join_measurement(t["humidity"], t["temperature"], processing_ms=m_clock)


@memo_plan
def enriched(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    """J1 then the as-of join. The measurements and the versions are tables between the two (as they are topics
    between two jobs): the as-of reads them once more for its buckets."""
    t = typed_inputs(spark, sf_dir)
    m_clock, e_clock = _clocks(clock)
    m = written(join_measurement(t["humidity"], t["temperature"], processing_ms=m_clock), "measurement")
    location, state = (written(tenancy(with_event_ts(t[k])).select("env", "tenant", "deviceId", "event_ts", *fields), k)
                       for k, fields in (("location", LOCATION_FIELDS), ("state", STATE_FIELDS)))
    return asof_enrich(m, location, state, enrich_ms=e_clock)


@memo_plan
def enriched_table(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    """The enriched rows as downstream jobs read them: a Parquet table written once a session and
    input folder (the reference publishes them to a topic that its summary, streak and sink jobs
    consume). An input folder that changes within a session needs a new session. Summaries,
    streaks, metrics and views scan only the columns they use."""
    return written(enriched(spark, sf_dir, clock), "enriched")


# --- from raw device lines ------------------------------------------------------------------

@memo_plan
def normalized_table(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    """All kinds' lines parsed in one pass over the raw feed and written once, in folders by kind and
    status; typed readings and dead letters read their folder. With the fixture clock, ingestion time
    is the raw record's timestamp."""
    stamp = F.unix_millis(F.col("timestamp")) if clock == "fixture" else None
    return written(parse_all(route_by_topic(FX.raw_messages(spark, sf_dir)), ingest_ms=stamp), "normalized", ("kind", "status"))


def typed_from_raw(spark: SparkSession, sf_dir: str, kind: str, clock: str = "fixture") -> DataFrame:
    t = normalized_table(spark, sf_dir, clock)
    return t.filter((F.col("kind") == kind) & (F.col("status") == "ok")).select(*[n for n, _ in FIELDS[kind]], "ingestedAt", "sourceTopic",
                                                                               "env", "tenant", "event_ts")


def errors_from_raw(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    return normalized_table(spark, sf_dir, clock).filter(F.col("status") == "error").select(*[f.name for f in PARSE_ERROR.fields])


@memo_plan
def enriched_from_raw(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    """The whole chain from raw device bytes to enriched rows."""
    t = {k: typed_from_raw(spark, sf_dir, k, clock) for k in ("humidity", "temperature", "location", "state")}
    m_clock, e_clock = _clocks(clock)
    m = written(join_measurement(t["humidity"], t["temperature"], processing_ms=m_clock), "measurement")
    return asof_enrich(m, t["location"], t["state"], enrich_ms=e_clock)


@memo_plan
def history(spark: SparkSession, sf_dir: str, clock: str = "fixture") -> DataFrame:
    """Enriched rows as the history table holds them (+ insert time), without writing."""
    from fieldpulse.sources.history import history_rows
    e = enriched_table(spark, sf_dir, clock)
    return history_rows(e, FX.fixture_history_clock() if clock == "fixture" else None)


# --- batch normalizer job ---------------------------------------------------------------------

def normalize_to_tables(raw: DataFrame, out_root: str, ingest_ms=None, mode: str = "overwrite") -> None:
    """Batch twin of the streaming normalizer, for backfills: one pass over the raw feed, one write,
    in folders ``kind=<kind>/status=ok|error``."""
    (parse_all(route_by_topic(raw), ingest_ms=ingest_ms)
     .write.mode(mode).partitionBy("kind", "status").parquet(out_root.rstrip("/")))


def read_normalized(spark: SparkSession, out_root: str, kind: str, status: str = "ok") -> DataFrame:
    df = spark.read.parquet(out_root.rstrip("/")).filter((F.col("kind") == kind) & (F.col("status") == status))
    if status == "ok":
        return df.select(*[n for n, _ in FIELDS[kind]], "ingestedAt", "sourceTopic", "env", "tenant", "event_ts")
    return df.select(*[f.name for f in PARSE_ERROR.fields])
