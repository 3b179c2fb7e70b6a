"""Session helpers.

All timestamp semantics in this package assume a UTC session time zone (the reference's
timestamps are zone-less UTC wall clocks). ``ensure_utc`` is cheap and idempotent, so every
public entry point calls it.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces partitions from runtime
# statistics, skew-join splitting covers hot keys in the measurement join, and the
# auto-broadcast threshold stays at a fixed byte bound so only sides of a measured size are
# broadcast.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "fieldpulse",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None so the launcher decides; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests) is a scratch folder made and
    registered; on a cluster a missing setting is an error, since executors can't see the driver's
    own folders. Works with and without a SparkContext
    (Spark Connect sessions have none; they read the SQL conf).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        configured = configured or sc.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext
        sc = None
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="fieldpulse-ckpt-", dir=os.environ.get("FIELDPULSE_SCRATCH", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # a deployment may treat it as a static config; the context call suffices
        pass
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


#: The JVM interprets methods of more bytecode than this for ever. Spark fuses a stage's steps into one method up to
#: 65,535; with this limit, a longer one runs step by step, in methods that are compiled.
COMPILED_BYTES = "8000"


@contextmanager
def compiled_steps(spark: SparkSession):
    """What is written meanwhile runs in methods that the JVM compiles. The setting is put back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df, name: str, partition_by: tuple[str, ...] = ()):
    """``df`` as a Parquet table in the shared folder: readers prune its columns, row groups and
    partitions, and a lost executor re-reads files instead of running the plan again."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with compiled_steps(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def clear_scratch(spark, older_than_seconds: int = 7 * 86_400) -> list[str]:
    """Delete the tables that queries have left in the shared folder and that nothing has written to for so long
    (jobs' checkpoints, sinks and state are elsewhere). Returns what was deleted. For a nightly call: a table is
    read while its query's results are, so the age has to exceed the longest query."""
    base = checkpoint_dir(spark).rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(base).getFileSystem(spark._jsc.hadoopConfiguration())
    now, gone = spark._jvm.java.lang.System.currentTimeMillis(), []
    for folder in ("tables", "llm", "replay"):
        at = hadoop(f"{base}/{folder}")
        for status in fs.listStatus(at) if fs.exists(at) else []:
            if now - status.getModificationTime() >= older_than_seconds * 1000:
                fs.delete(status.getPath(), True)
                gone.append(status.getPath().toString())
    return gone


def ship_package(spark: SparkSession) -> None:
    """Make ``fieldpulse`` importable in the Python workers (the corpus operators run functions of the package
    in tasks). The package is zipped on the driver and distributed with ``addPyFile`` (Spark Connect:
    ``addArtifacts``), the standard way to ship Python code to executors; once a context, which remembers it
    itself. The zip goes when the driver ends."""
    import atexit
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    owner = sc if sc is not None else spark
    if getattr(owner, "_fieldpulse_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="fieldpulse-", suffix=".zip")
    os.close(fd)
    atexit.register(lambda: os.path.exists(zpath) and os.remove(zpath))
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, base))
    if sc is not None:
        sc.addPyFile(zpath)
    else:
        spark.addArtifacts(zpath, pyfile=True)
    owner._fieldpulse_shipped = True
