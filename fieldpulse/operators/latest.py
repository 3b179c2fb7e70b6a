"""Latest row per key (what an upsert/hash sink keeps) and the key time-to-live filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.constants import KEY_TTL_SECONDS


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per ``keys`` by ``order`` (lexicographic; later columns break ties; rows equal in all
    of ``order`` are one candidate each, of which the greatest row hash stays).

    The first aggregate carries only the order: timestamps and integers are packed into one decimal, which
    keeps it a hash aggregate with map-side combine (a key with a third of all rows shrinks before
    the shuffle). The rows themselves are then picked by one join on key and order, and what ties is
    settled by an aggregate of those few.
    """
    cols = df.columns
    rows = df.withColumn("_o", packed_order(df, order))
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    best = rows.select(*named, "_o").groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.max("_o").alias("_best"))
    top = rows.join(best, [*match, F.col("_o") == F.col("_best")]).select(*cols)
    return top.groupBy(*named).agg(F.max_by(F.struct(*cols), F.xxhash64(*cols)).alias("_r")).select("_r.*")


def packed_order(df: DataFrame, order: list[str]) -> Column:
    """Up to two integer or timestamp columns as one DECIMAL(38,0) in the same order."""
    d, kinds = "decimal(38,0)", dict(df.dtypes)

    def number(c: str) -> Column:
        n = F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith("timestamp") else F.col(c).cast("long")
        return n.cast(d)

    first, *rest = order
    if len(rest) > 1:
        raise ValueError("at most two order columns")
    # the second column's 64 bits fit below one step of the first; nulls come first
    low = F.coalesce(number(rest[0]) + F.lit(str(2 ** 63 + 1)).cast(d), F.lit(0).cast(d)) if rest else F.lit(0).cast(d)
    high = F.coalesce(number(first), F.lit(str(-4 * 10 ** 18)).cast(d))
    return (high * F.lit(str(2 * 10 ** 19)).cast(d) + low).cast(d)


def latest_per_device(enriched: DataFrame) -> DataFrame:
    """Newest enriched row per (env, tenant, device) by event time, then humidity_seq."""
    return latest_by(enriched, ["env", "tenant", "device_id"], ["measurement_event_ts", "humidity_seq"])


def latest_state_view(enriched: DataFrame, written_at: Column | None = None) -> DataFrame:
    """The device-state view keyed by ``redis_key`` (one row per key), with ``written_at``:
    when the row was last written (default: its enrichment stamp)."""
    stamp = written_at if written_at is not None else F.timestamp_millis(F.col("enriched_processing_ts_ms"))
    latest = latest_by(enriched, ["redis_key"], ["measurement_event_ts", "humidity_seq"])
    return latest.withColumn("written_at", stamp)


def view_ttl(view: DataFrame, as_of: Column, ttl_seconds: int = KEY_TTL_SECONDS,
             written_col: str = "written_at") -> DataFrame:
    """Keys still alive at ``as_of``: written less than ``ttl_seconds`` ago (a key written
    exactly ``ttl_seconds`` before ``as_of`` has expired)."""
    return view.filter(F.col(written_col) > as_of - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))
