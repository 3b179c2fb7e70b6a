"""Time-bucketed device metrics and end-to-end latency statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.constants import BUCKET_UNITS
from fieldpulse.functions.parsing import event_time

TS = "measurement_event_ts"


def filter_device_range(df: DataFrame, env: str, tenant: str, device_id: str,
                        from_ts: Column, to_ts: Column) -> DataFrame:
    """``env = ? AND tenant = ? AND device_id = ? AND ts BETWEEN from AND to`` (inclusive).
    Plain column predicates, so they reach the Parquet scan (and, on the history table,
    prune ``event_date`` partitions – see sources.history)."""
    return df.filter((F.col("env") == env) & (F.col("tenant") == tenant)
                     & (F.col("device_id") == device_id) & F.col(TS).between(from_ts, to_ts))


def average(column: str) -> Column:
    """Mean of a double column, the same whatever order its rows are added in. A value is cut into multiples of
    2^-10, of 2^-30 and a rest, each of which adds up without rounding (readings below 2^20, up to 2^23 rows
    a group; beyond that the last bits may follow the order, as with ``avg``)."""
    v = F.col(column)
    coarse = F.when(F.abs(v) < F.lit(2.0 ** 20), F.rint(v * F.lit(2.0 ** 10)) / F.lit(2.0 ** 10)).otherwise(F.lit(0.0))
    fine = F.when(F.abs(v - coarse) < F.lit(1.0), F.rint((v - coarse) * F.lit(2.0 ** 30)) / F.lit(2.0 ** 30)).otherwise(F.lit(0.0))
    return (F.sum(coarse) + F.sum(fine) + F.sum(v - coarse - fine)) / F.nullif(F.count(v), F.lit(0))


def metrics_by_bucket(enriched: DataFrame, bucket: str = "HOUR",
                      group_cols: tuple[str, ...] = (), ordered: bool = False) -> DataFrame:
    """Per ``date_trunc(bucket, ts)`` (hour / day / week, weeks start Monday): average
    temperature, average humidity, reading count, online count, offline count. A null
    ``online`` counts in neither. ``ordered`` sorts by bucket start (what one device's chart
    needs); a fleet-wide table skips the global sort (a sampling pass + range shuffle)."""
    unit = BUCKET_UNITS[bucket.upper()]
    online = F.col("online")
    out = (enriched.groupBy(*group_cols, F.date_trunc(unit, F.col(TS)).alias("bucket"))
            .agg(average("temperature").alias("tAvg"),
                 average("humidity").alias("hAvg"),
                 F.count("device_id").alias("totalCount"),
                 F.count_if(online).alias("okCount"),
                 F.count_if(~online).alias("errorCount")))
    return out.orderBy(*group_cols, "bucket") if ordered else out


# ---------------------------------------------------------------------------------------
# latency statistics

LATENCIES = ("create_to_normalized", "create_to_measurement", "create_to_enriched",
             "create_to_postgres")
QUANTILES = {"p50": 0.50, "p95": 0.95}


def filter_prefix_complete(history: DataFrame, prefix: str = "") -> DataFrame:
    """``device_id LIKE '<prefix>%'`` and the six inputs of the latencies are not null."""
    df = history
    if prefix:
        df = df.filter(F.col("device_id").startswith(prefix))
    return df.dropna(subset=["humidity_event_time", "humidity_ingested_at", "temperature_ingested_at",
                             "measurement_processing_ts_ms", "enriched_processing_ts_ms",
                             "postgres_inserted_at"])


def latency_columns(history: DataFrame) -> DataFrame:
    """The four latencies (ms) of every stored row, from device creation time."""
    event_ms = F.unix_millis(event_time(F.col("humidity_event_time")))
    normalized = F.greatest("humidity_ingested_at", "temperature_ingested_at")
    return history.select(
        "*",
        (normalized - event_ms).alias("create_to_normalized"),
        (F.col("measurement_processing_ts_ms") - event_ms).alias("create_to_measurement"),
        (F.col("enriched_processing_ts_ms") - event_ms).alias("create_to_enriched"),
        (F.unix_millis("postgres_inserted_at") - event_ms).alias("create_to_postgres"),
    )


#: Bits of a value that a round of selection settles; a group's histogram has 2^16 entries at most.
DIGIT_BITS = 16


def _picked(hist: Column, rank: Column) -> Column:
    """The bin (a digit) that holds a rank (from 0) in a sorted histogram of ``(bin, c)``, and how many come before."""
    start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("bin"))
    return F.aggregate(hist, start, lambda acc, x: F.when(acc["bin"].isNotNull(), acc)
                       .when(acc["below"] + x["c"] > rank, F.struct(acc["below"].alias("below"), x["bin"].alias("bin")))
                       .otherwise(F.struct((acc["below"] + x["c"]).alias("below"), F.lit(None).cast("long").alias("bin"))))


def exact_stats(df: DataFrame, group_cols: list[str], metrics: tuple[str, ...],
                quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """count, mean and exact linear-interpolation quantiles (pandas' ``quantile``) of integer
    metrics per group, by radix selection: no group's values are ever brought together or sorted.

    A round counts values by their next ``DIGIT_BITS`` bits (a hash aggregate with map-side combine) and
    keeps, for each rank wanted, the digit that holds it; the next round counts within that digit alone.
    Values are taken from the least one, so the rounds follow from the span of the data: one for latencies
    within a minute, two up to seven weeks, four for any. One row (least and greatest value) is read on the
    driver to know it.
    """
    long = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("v")) for m in metrics
    ])).alias("x")).select(*group_cols, "x.metric", "x.v").filter(F.col("v").isNotNull())
    keys = [*group_cols, "metric"]
    cols = [F.col(m).cast("long") for m in metrics]
    span = df.agg(F.min(F.least(*cols) if len(cols) > 1 else cols[0]), F.max(F.greatest(*cols) if len(cols) > 1 else cols[0])).first()
    low, high = (0, 0) if span[0] is None else span
    near = high - low < 1 << 63
    bits = max(1, (high - low if near else (1 << 64) - 1).bit_length())
    sign = -(1 << 63)
    place = (F.col("v") - F.lit(low)) if near else F.col("v").bitwiseXOR(F.lit(sign).cast("long"))  # in order as an unsigned number
    long = long.withColumn("u", place)
    shift = DIGIT_BITS * (-(-bits // DIGIT_BITS) - 1)
    mask = F.lit((1 << DIGIT_BITS) - 1).cast("long")

    def digit(at: int) -> Column:
        return F.shiftrightunsigned("u", at).bitwiseAND(mask)

    def histogram(rows: DataFrame, by: list[str], *more: Column) -> DataFrame:
        counts = rows.groupBy(*by, "bin").agg(F.count("*").alias("c"), F.sum("v").alias("s"), *more)
        return counts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("bin", "c"))).alias("hist"), F.sum("c").alias("n"), F.sum("s").alias("s"), *more)

    per = histogram(long.withColumn("bin", digit(shift)), keys)
    places = {f"{name}_{end}": side((F.col("n") - 1) * F.lit(q)) for name, q in quantiles.items() for end, side in (("lo", F.floor), ("hi", F.ceil))}
    if shift == 0:  # one round settles all
        out = per.select(*keys, F.col("n").alias("samples"), (F.col("s") / F.col("n")).alias("mean"),
                         *[(_picked(F.col("hist"), rank)["bin"] + F.lit(low)).alias(w) for w, rank in places.items()])
    else:
        found = per.select(*keys, F.explode(F.array(*[F.struct(F.lit(w).alias("which"), rank.alias("rank"), _picked(F.col("hist"), rank).alias("at"))
                                                      for w, rank in places.items()])).alias("w"))
        ranks = found.select(*keys, "w.which", (F.col("w.rank") - F.col("w.at.below")).alias("rank"), F.col("w.at.bin").alias("prefix"))
        while shift:
            inside = long.withColumn("prefix", F.shiftrightunsigned("u", shift)).join(ranks, [*keys, "prefix"])
            shift -= DIGIT_BITS
            finer = histogram(inside.withColumn("bin", digit(shift)), [*keys, "which"], F.first("rank").alias("rank"), F.first("prefix").alias("prefix"))
            finer = finer.withColumn("at", _picked(F.col("hist"), F.col("rank")))
            ranks = finer.select(*keys, "which", (F.col("rank") - F.col("at.below")).alias("rank"),
                                 F.shiftleft("prefix", DIGIT_BITS).bitwiseOR(F.col("at.bin")).alias("prefix"))
        value = F.col("prefix") + F.lit(low) if near else F.col("prefix").bitwiseXOR(F.lit(sign).cast("long"))
        wide = ranks.groupBy(*keys).agg(*[F.max(F.when(F.col("which") == w, value)).alias(w) for w in places])
        out = per.select(*keys, F.col("n").alias("samples"), (F.col("s") / F.col("n")).alias("mean")).join(wide, keys)
    for name, q in quantiles.items():
        pos = (F.col("samples") - 1) * F.lit(q)
        out = out.withColumn(name, F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (pos - F.floor(pos)))
    return out.select(*keys, "samples", "mean", *quantiles)


def latency_stats(history: DataFrame, group_cols: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """samples and mean / p50 / p95 of the four latencies, one row per group, with the
    reference's column names (``mean_create_to_normalized_ms`` ...)."""
    lat = latency_columns(filter_prefix_complete(history, prefix))
    stats = exact_stats(lat, list(group_cols), LATENCIES)
    wide_aggs = [F.max("samples").alias("samples")]
    for m in LATENCIES:
        for stat in ("mean", *QUANTILES):
            wide_aggs.append(F.max(F.when(F.col("metric") == m, F.col(stat))).cast("double")
                             .alias(f"{stat}_{m}_ms"))
    if group_cols:
        return stats.groupBy(*group_cols).agg(*wide_aggs)
    # one row even without data: samples 0 and null statistics, like the reference's report
    return stats.agg(*wide_aggs).withColumn("samples", F.coalesce("samples", F.lit(0)).cast("long"))


def append_results(stats: DataFrame, path: str) -> None:
    """Accumulate result rows across benchmark runs (append mode, one folder of Parquet)."""
    stats.write.mode("append").parquet(path)
