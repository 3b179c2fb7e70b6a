"""Streaming sinks.

* A ``foreachBatch`` table is a set of ``batch_id=<id>`` folders. A batch is written beside the table
  under a name that readers skip and renamed into place, so it appears whole or not at all; a batch
  that is already there is left alone. A micro-batch replayed after a failure therefore changes no
  file, and the job downstream, which remembers files, reads nothing twice. (The rename is atomic on
  HDFS and local file systems; an object store needs a committer of its own.)
* Upsert tables (keyed upsert topics and hashes) are a changelog of rows with ``batch_id`` and
  ``written_at``. Every few batches are merged into a *run*, the latest row a key of theirs, and every few
  runs of one size into a larger one, so a table of n batches has some log n folders and a row is rewritten
  log n times, not once a batch. What a run covers is deleted after a reader's grace time.
  :func:`read_upsert_view` reads the runs and batches that nothing else covers.
* One batch to several tables (:func:`fanout_enriched`) ends with a commit marker. Readers given the marker's
  folder take a batch of all the tables or of none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.constants import KEY_TTL_SECONDS
from fieldpulse.operators.latest import latest_by, view_ttl
from fieldpulse.session import compiled_steps
from fieldpulse.sources.history import ROWS_PER_WRITER, clustered, history_rows, write_clustered


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n.startswith(prefix))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a folder; nothing happens if ``dst`` is there already or ``src`` is not there."""
    if exists(spark, src):
        _move(spark, src, dst)


def _move(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = spark._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if not fs.exists(d) and not fs.rename(s, d) and not fs.exists(d):
        raise OSError(f"could not move {src} to {dst}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_once(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), bloom: tuple[str, ...] = ()) -> None:
    """Write ``df`` as the folder ``path`` unless it is there already (``bloom``: columns with a bloom filter)."""
    spark = df.sparkSession
    if exists(spark, path):
        return
    parent, name = path.rstrip("/").rsplit("/", 1)
    tmp = f"{parent}/_writing/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with compiled_steps(spark):
        writer.parquet(tmp)
    _move(spark, tmp, path)


def write_batch(df: DataFrame, table_path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    write_once(df, f"{table_path.rstrip('/')}/batch_id={int(batch_id)}", partition_by)


def forget_batches(spark: SparkSession, table_path: str, upto: int) -> None:
    """Delete the folders of batches up to ``upto`` (state that no replay needs any more)."""
    for n in children(spark, table_path, "batch_id="):
        if int(n.split("=")[1]) <= upto:
            delete(spark, f"{table_path.rstrip('/')}/{n}")


def write_by(df: DataFrame, column: str, path: str, batch_id: int, bloom: tuple[str, ...] = ()) -> None:
    """A batch into folders ``<column>=<value>/batch_id=<id>`` of a table, each moved into place once."""
    spark, path = df.sparkSession, path.rstrip("/")
    tmp = f"{path}/_writing/{int(batch_id)}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.partitionBy(column).parquet(tmp)
    for name in children(spark, tmp, f"{column}="):
        move(spark, f"{tmp}/{name}", f"{path}/{name}/batch_id={int(batch_id)}")


def write_history_batch(enriched: DataFrame, path: str, batch_id: int, inserted_at: Column | None = None,
                        rows_per_writer: int = ROWS_PER_WRITER) -> None:
    """A micro-batch into the history table: ``event_date=<date>/batch_id=<id>``, sorted as the batch
    writer sorts, so a date range is one folder a date whatever the number of batches. A date with many
    rows (a backlog) is written by several tasks."""
    rows = history_rows(enriched, inserted_at if inserted_at is not None else F.current_timestamp())
    write_by(clustered(rows, rows_per_writer), "event_date", path, batch_id, bloom=("device_id",))


def compact_history_dates(spark: SparkSession, path: str, into: str, dates: list[str],
                          rows_per_writer: int = ROWS_PER_WRITER) -> None:
    """Rewrite whole dates (those no stream writes to any more) as few sorted files under ``into``, one
    for each ``rows_per_writer`` rows or so. Repeated, it replaces those dates."""
    from fieldpulse.sources.history import read_history
    rows = read_history(spark, path).filter(F.col("event_date").isin(*[F.lit(d).cast("date") for d in dates]))
    writer = clustered(rows, rows_per_writer).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write_clustered(writer, into)


# ---- upsert tables -------------------------------------------------------------------------------

def append_changelog(df: DataFrame, table_path: str, batch_id: int, written_at: Column | None = None) -> None:
    """Upsert-sink write: the batch's rows + ``written_at`` (the batch's write time)."""
    stamp = written_at if written_at is not None else F.current_timestamp()
    write_batch(df.withColumn("written_at", stamp), table_path, batch_id)


def _runs_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.runs"


def runs(spark: SparkSession, table_path: str) -> list[tuple[int, int]]:
    """(first batch, last batch) of every run, covered ones included."""
    spans = [n.split("-") for n in children(spark, _runs_path(table_path), "from_")]
    return sorted((int(a.split("_")[1]), int(b.split("_")[1])) for a, b in spans)


def _within(span: tuple[int, int], other: tuple[int, int]) -> bool:
    return span != other and other[0] <= span[0] and span[1] <= other[1]


def live_folders(spark: SparkSession, table_path: str) -> tuple[list[tuple[int, int]], list[int]]:
    """The runs and the batches that no run covers."""
    every = runs(spark, table_path)
    top = [r for r in every if not any(_within(r, o) for o in every)]
    ids = [int(n.split("=")[1]) for n in children(spark, table_path, "batch_id=")]
    return top, sorted(n for n in ids if not any(a <= n <= b for a, b in top))


def _run_path(table_path: str, span: tuple[int, int]) -> str:
    return f"{_runs_path(table_path)}/from_{span[0]}-upto_{span[1]}"


def _read_parts(spark: SparkSession, table_path: str, spans: list[tuple[int, int]], batches: list[int]) -> DataFrame:
    path = table_path.rstrip("/")
    parts = [spark.read.parquet(_run_path(path, r)) for r in spans]
    if batches or not parts:
        log = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in batches] or [path])
        parts.append(log.withColumn("batch_id", F.col("batch_id").cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_changelog(spark: SparkSession, table_path: str, alive_after: Column | None = None, commits: str | None = None) -> DataFrame:
    """The runs and batches that nothing covers, with ``batch_id`` and ``written_at``. ``alive_after`` drops rows
    written before that: a key's newest row decides whether the key is alive, so older rows can go before any
    aggregate. ``commits``: only batches whose marker is there."""
    out = _read_parts(spark, table_path, *live_folders(spark, table_path))
    done = committed(spark, commits) if commits else None
    if done is not None:
        out = out.filter(F.col("batch_id") <= done)
    return out if alive_after is None else out.filter(F.col("written_at") > alive_after)


def read_upsert_view(spark: SparkSession, table_path: str, key: str, as_of: Column | None = None,
                     ttl_seconds: int | None = None, commits: str | None = None, then: str | None = None) -> DataFrame:
    """Latest row per ``key`` of a changelog (the later batch wins, and within a batch the greatest ``then``, where
    a batch may bring a key more than once), of the keys alive at ``as_of`` if a time to live is given."""
    ttl = as_of is not None and ttl_seconds is not None
    since = as_of - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS") if ttl else None
    latest = latest_by(read_changelog(spark, table_path, since, commits), [key], _order(then))
    return view_ttl(latest, as_of, ttl_seconds) if ttl else latest


def _order(then: str | None) -> list[str]:
    return ["batch_id", then] if then else ["batch_id"]


def _merge(spark: SparkSession, table_path: str, key: str, spans: list[tuple[int, int]], batches: list[int],
           as_of: Column | None = None, ttl_seconds: int | None = None, then: str | None = None) -> None:
    """The latest row a key of some runs and batches as one run; with a time to live, expired rows are left out.
    Files are dealt by key and carry a bloom filter on it, so a look-up of one key opens few of them."""
    ends = [n for span in spans for n in span] + batches
    rows = _read_parts(spark, table_path, spans, batches)
    if as_of is not None and ttl_seconds:
        rows = rows.filter(F.col("written_at") > as_of - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))
    merged = latest_by(rows, [key], _order(then)).repartition(key).sortWithinPartitions(key)
    write_once(merged, _run_path(table_path, (min(ends), max(ends))), bloom=(key,))


def merge_due(spark: SparkSession, table_path: str, key: str, every: int, before: int, as_of: Column | None = None,
              ttl_seconds: int | None = None, then: str | None = None) -> None:
    """Merge what is due among the batches before ``before``: ``every`` batches into a run, ``every`` runs of one
    size into the next (two at least)."""
    every = max(2, every)
    spans, batches = live_folders(spark, table_path)
    batches = [n for n in batches if n < before]
    if len(batches) >= every:
        _merge(spark, table_path, key, [], batches, as_of, ttl_seconds, then)
    while True:
        spans, _ = live_folders(spark, table_path)
        size = lambda r: _level(r[1] - r[0] + 1, every)
        tail = [r for r in spans if size(r) == size(spans[-1])] if spans else []
        if len(tail) < every or spans[-len(tail):] != tail:
            return
        _merge(spark, table_path, key, tail, [], as_of, ttl_seconds, then)


def _level(batches: int, every: int) -> int:
    level = 0
    while batches >= every ** (level + 1):
        level += 1
    return level


def delete_covered(spark: SparkSession, table_path: str, grace_seconds: int) -> None:
    """Delete folders that a run has covered for longer than readers take."""
    every, now = runs(spark, table_path), spark._jvm.java.lang.System.currentTimeMillis()
    fs, _ = _fs(spark, table_path)
    since = {r: fs.getFileStatus(_fs(spark, _run_path(table_path, r))[1]).getModificationTime() for r in every}
    old = [r for r in every if now - since[r] >= grace_seconds * 1000]
    for r in every:
        if any(_within(r, o) for o in old):
            delete(spark, _run_path(table_path, r))
    for n in children(spark, table_path, "batch_id="):
        if any(a <= int(n.split("=")[1]) <= b for a, b in old):
            delete(spark, f"{table_path.rstrip('/')}/{n}")


def compact_changelog(spark: SparkSession, table_path: str, key: str, upto: int, as_of: Column | None = None,
                      ttl_seconds: int | None = None, then: str | None = None) -> None:
    """One run of all batches up to ``upto``; with a time to live, expired keys are left out."""
    spans, batches = live_folders(spark, table_path)
    _merge(spark, table_path, key, [r for r in spans if r[1] <= upto], [n for n in batches if n <= upto], as_of, ttl_seconds, then)


#: Batches (and runs of one size) that are merged together, and how long covered folders stay for readers.
MERGE_EVERY, GRACE_SECONDS = 8, 600


def upsert_sink(table_path: str, key: str = "redis_key", compact_every: int = 0, ttl_seconds: int | None = None,
                grace_seconds: int = GRACE_SECONDS, then: str | None = None):
    """``foreachBatch`` body (``then``: as in :func:`read_upsert_view`). Every ``compact_every`` batches (0: never) are merged; the batch itself is merged by a
    later one, so a marker written after it can still hide it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not any(a <= batch_id <= b for a, b in runs(spark, table_path)):
            append_changelog(batch, table_path, batch_id)
        if compact_every:
            merge_due(spark, table_path, key, compact_every, batch_id, F.current_timestamp() if ttl_seconds else None, ttl_seconds, then)
            delete_covered(spark, table_path, grace_seconds)
    return run


# ---- one batch to several tables ------------------------------------------------------------------

#: Commit markers that are kept (readers want the newest).
MARKERS = 16


def commit(spark: SparkSession, commits: str, batch_id: int) -> None:
    """Say that a batch is in all its tables: one folder, made at once."""
    make_folder(spark, f"{commits.rstrip('/')}/batch_id={int(batch_id)}")
    old = sorted(int(n.split("=")[1]) for n in children(spark, commits, "batch_id="))[:-MARKERS]
    for n in old:
        delete(spark, f"{commits.rstrip('/')}/batch_id={n}")


def committed(spark: SparkSession, commits: str) -> int:
    """The newest committed batch (-1: none)."""
    return max((int(n.split("=")[1]) for n in children(spark, commits, "batch_id=")), default=-1)


def read_enriched(spark: SparkSession, path: str, commits: str | None = None) -> DataFrame:
    """The enriched table that :func:`fanout_enriched` writes."""
    rows = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch_id=*").withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows.filter(F.col("batch_id") <= committed(spark, commits)) if commits else rows


def fanout_enriched(enriched_path: str, history_path: str, state_path: str, compact_every: int = MERGE_EVERY,
                    ttl_seconds: int | None = KEY_TTL_SECONDS, commits: str | None = None):
    """One enriched batch to three sinks (enriched topic, history table, device-state hashes): kept
    once, written three times, then committed (marker folder: ``<history>.commits`` unless given)."""
    state = upsert_sink(state_path, "redis_key", compact_every, ttl_seconds)
    commits = commits or f"{history_path.rstrip('/')}.commits"

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, enriched_path, batch_id)
            write_history_batch(batch, history_path, batch_id)
            state(latest_by(batch, ["redis_key"], ["measurement_event_ts", "humidity_seq"]), batch_id)
            commit(batch.sparkSession, commits, batch_id)
        finally:
            batch.unpersist()
    return run


def kafka_append(df: DataFrame, bootstrap: str, topic: str, key_col: str, checkpoint: str):
    """Append rows to a Kafka topic as JSON values keyed by ``key_col`` (the reference's typed
    topics). Needs the spark-sql-kafka package; untested here (no connector jar)."""
    out = df.select(F.col(key_col).cast("string").alias("key"),
                    F.to_json(F.struct(*df.columns)).alias("value"))
    return (out.writeStream.format("kafka").outputMode("append")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint))
