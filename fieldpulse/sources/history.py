"""History table: insert-only enriched rows, partitioned by event date.

Layout: Parquet partitioned by ``event_date = to_date(measurement_event_ts)``, dealt by range of
``(env, tenant, device_id, measurement_event_ts)`` within a date and sorted so, with a bloom filter on the
device: a device/time range query prunes whole date folders, opens one file of each and skips its other row
groups – the Spark counterpart of the reference's time-partitioned table and (device, time) indexes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.clock import now_ms
from fieldpulse.schemas import ENRICHED, ENRICHED_COLUMNS

HISTORY_SCHEMA = T.StructType([*ENRICHED.fields, T.StructField("postgres_inserted_at", T.TimestampType()),
                               T.StructField("event_date", T.DateType())])
SORT_COLUMNS = ["env", "tenant", "device_id", "measurement_event_ts"]
#: A date has one writer for each so many rows.
ROWS_PER_WRITER = 1_000_000


def history_rows(enriched: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Enriched rows + ``postgres_inserted_at`` (insert time) + ``event_date``."""
    stamp = inserted_at if inserted_at is not None else F.timestamp_millis(now_ms())
    return enriched.select(
        *ENRICHED_COLUMNS,
        stamp.alias("postgres_inserted_at"),
        F.to_date("measurement_event_ts").alias("event_date"))


def write_history(enriched: DataFrame, path: str, inserted_at: Column | None = None,
                  mode: str = "append", rows_per_writer: int = ROWS_PER_WRITER) -> None:
    """Append rows, clustered by device within a date (:func:`clustered`)."""
    write_clustered(clustered(history_rows(enriched, inserted_at), rows_per_writer).write.mode(mode), path)


def clustered(rows: DataFrame, rows_per_writer: int = ROWS_PER_WRITER) -> DataFrame:
    """History rows dealt by range of ``(event_date, env, tenant, device, time)`` and sorted so: a device's rows of a
    date are side by side, in one file (or two neighbours), whose min/max on the device skip all others. A
    date or a device with many rows is cut by the same ranges, so it has several writers. One count is read
    on the driver."""
    order = ["event_date", *SORT_COLUMNS]
    n = max(1, -(-rows.count() // rows_per_writer))
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)


def write_clustered(writer, path: str) -> None:
    """Files by date, with a bloom filter on the device."""
    writer.option("parquet.bloom.filter.enabled#device_id", "true").option("maxRecordsPerFile", 5_000_000).partitionBy("event_date").parquet(path)


def read_history(spark: SparkSession, path: str, commits: str | None = None) -> DataFrame:
    """The history table. Below the date, a stream's folders add ``batch_id``; its markers' folder
    (``commits``, by default ``<path>.commits`` if it is there) hides a batch that isn't in all its dates yet."""
    from fieldpulse.streaming import sinks

    schema = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).parquet(path)
    commits = commits or f"{path.rstrip('/')}.commits"
    if sinks.exists(spark, commits):
        rows = rows.filter(F.col("batch_id").isNull() | (F.col("batch_id") <= sinks.committed(spark, commits)))
    return rows.select(*HISTORY_SCHEMA.fieldNames())


def scan_history(spark: SparkSession, path: str, env: str | None = None, tenant: str | None = None,
                 device_id: str | None = None, from_ts=None, to_ts=None) -> DataFrame:
    """Device/time-range scan. The event-time bounds are also stated on ``event_date`` so
    the partition filter prunes folders (Spark cannot derive it from the timestamp)."""
    df = read_history(spark, path)
    cond = F.lit(True)
    if env is not None:
        cond = cond & (F.col("env") == env)
    if tenant is not None:
        cond = cond & (F.col("tenant") == tenant)
    if device_id is not None:
        cond = cond & (F.col("device_id") == device_id)
    # bounds may be literals or foldable Columns (e.g. current_timestamp() - INTERVAL 24 HOURS):
    # both fold to constants, so the date bounds prune partitions
    if from_ts is not None:
        f = (from_ts if isinstance(from_ts, Column) else F.lit(from_ts)).cast("timestamp")
        cond = cond & (F.col("measurement_event_ts") >= f) & (F.col("event_date") >= F.to_date(f))
    if to_ts is not None:
        t = (to_ts if isinstance(to_ts, Column) else F.lit(to_ts)).cast("timestamp")
        cond = cond & (F.col("measurement_event_ts") <= t) & (F.col("event_date") <= F.to_date(t))
    return df.filter(cond)


def newest_dates(spark: SparkSession, path: str) -> list[str]:
    """The table's dates, newest first (folder names; no file is opened)."""
    from fieldpulse.streaming import sinks

    return [n.split("=")[1] for n in reversed(sinks.children(spark, path, "event_date=")) if n.split("=")[1][:1].isdigit()]


def last_reading(spark: SparkSession, path: str, before_us: int | None = None, env: str | None = None, tenant: str | None = None) -> int | None:
    """The newest event time in microseconds (of a tenant, before a time), from as few dates as hold it: the newest date first,
    then twice as many each step, so a tenant silent for n dates costs log n steps. None: no reading."""
    dates, at, size = newest_dates(spark, path), 0, 1
    while at < len(dates):
        part = [F.lit(d).cast("date") for d in dates[at:at + size]]
        rows = read_history(spark, path).filter(F.col("event_date").isin(*part))
        for c, v in (("env", env), ("tenant", tenant)):
            rows = rows.filter(F.col(c) == v) if v is not None else rows
        rows = rows.filter(F.col("measurement_event_ts") < F.timestamp_micros(F.lit(before_us))) if before_us is not None else rows
        found = rows.agg(F.unix_micros(F.max("measurement_event_ts"))).first()[0]
        if found is not None:
            return found
        at, size = at + size, size * 2
    return None
