"""Telemetry inputs derived from the driver's ``events`` table.

The reference ships no data, so every input is a Spark projection of ``events`` (it grows with
the table; nothing here is made up or capped). Mapping (see FIXTURES.md):

  k        = integer in props ('{"k": n}')
  device   = 'device-' || lpad(user_id, 5, '0')
  env      = 'prod';  tenant = 'tenant-' || (user_id % 3 + 1)
  ts       = events.ts truncated to milliseconds;  seq = event_id
  humidity      : event_type not in (error, signup); humidity = k
  temperature   : event_type in (click, purchase);   temperature = value / 10 - 10
  location dim  : event_type = signup; lat = 54.8433 + k/10000, lon = 83.0931 + k/5000
  state dim     : event_type = error;  rssi = k - 100, snr = k/5 - 10, battery = 100 - k/2,
                  online = (k % 2 = 0)

Clock columns are deterministic functions of the row (so results can be compared with an
oracle): a reading is ingested ``lag(kind)`` ms after its event time, the measurement join
stamps ``greatest(ingested) + 100``, enrichment ``+ 250`` more, the history insert ``+ 400``.

Raw device lines reproduce the devices' CSV text; by ``event_id % 20`` some are broken so the
dead-letter path is exercised: 3 drops the last field, 7 puts ``abc`` in field 2, 11 appends a
padding field, 13 and 17 break the integer field (``' 5'``, ``1.5``; for location: an empty
longitude, and a latitude with surrounding blanks, which Java accepts), 19 sends a time in another form
(a time or a year alone, an offset, a five-digit year, 30 February, words; or a good one with a space).
By ``event_id % 60``: 21 and 42 put ``inf`` and ``nan`` in field 2 of humidity, temperature and location, 24 ends the line with a line break, 28 begins it with the byte FF.
By ``event_id % 50 == 23`` the topic is a device-command topic that routing must ignore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.functions.parsing import iso_millis
from fieldpulse.session import ensure_utc, written

# Fixed fixture values.
LAG_MS = {"humidity": (5, 11), "temperature": (7, 13), "location": (3, 7), "state": (4, 9)}
MEASUREMENT_DELAY_MS = 100
ENRICH_DELAY_MS = 250
HISTORY_DELAY_MS = 400
KIND_OF_EVENT = {"humidity": ("click", "purchase", "view"), "temperature": ("click", "purchase"),
                 "location": ("signup",), "state": ("error",)}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_PLAN_CACHE: dict = {}


def memo_plan(fn):
    """Reuse the (lazy) DataFrame a fixture/flow function builds, per session and arguments.
    The plan is not re-analysed for each query; where the function writes a table (``flow``), the
    table is written once a session and arguments, and later changes of its input don't show."""
    def wrapper(spark, *args, **kw):
        key = (fn.__module__, fn.__qualname__, id(spark), args, tuple(sorted(kw.items())))
        hit = _PLAN_CACHE.get(key)
        if hit is None or hit[0] is not spark:
            hit = _PLAN_CACHE[key] = (spark, fn(spark, *args, **kw))
        return hit[1]
    wrapper.__name__, wrapper.__doc__, wrapper.__wrapped__ = fn.__name__, fn.__doc__, fn
    return wrapper


def forget() -> None:
    """Build plans and tables anew from here on."""
    _PLAN_CACHE.clear()
    _RAW_CACHE.clear()


@memo_plan
def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + the columns every fixture shares."""
    ensure_utc(spark)
    ev = load_table(spark, sf_dir, "events")
    ts = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    return ev.select(
        "event_id", "event_type", "value",
        F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"),
        F.concat(F.lit("device-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("device_id"),
        F.lit("prod").alias("env"),
        F.concat(F.lit("tenant-"), (F.col("user_id") % 3 + 1).cast("string")).alias("tenant"),
        ts.alias("event_ts"),
    ).withColumn("event_ms", F.unix_millis("event_ts"))


def ingest_ms(kind: str) -> Column:
    base, mod = LAG_MS[kind]
    return F.col("event_ms") + F.lit(base) + F.col("event_id") % F.lit(mod)


def device_topic(kind: str) -> Column:
    return F.concat_ws("/", "env", "tenant", F.lit("sensors"), "device_id", F.lit(kind))


def _kind_rows(ev: DataFrame, kind: str) -> DataFrame:
    return ev.filter(F.col("event_type").isin(*KIND_OF_EVENT[kind]))


@memo_plan
def typed_readings(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Clean typed records of one kind (+ env, tenant), as the normalizer would emit them."""
    ev = _kind_rows(base_events(spark, sf_dir), kind)
    common_head = [F.col("device_id").alias("deviceId"), iso_millis(F.col("event_ts")).alias("eventTime")]
    common_tail = [ingest_ms(kind).alias("ingestedAt"), device_topic(kind).alias("sourceTopic"),
                   "env", "tenant"]
    if kind == "humidity":
        values = [F.col("k").cast("double").alias("humidity"), F.col("event_id").alias("seq")]
    elif kind == "temperature":
        values = [(F.col("value") / 10.0 - 10.0).alias("temperature"), F.col("event_id").alias("seq")]
    elif kind == "location":
        values = [(F.lit(54.8433) + F.col("k") / 10000.0).alias("lat"),
                  (F.lit(83.0931) + F.col("k") / 5000.0).alias("lon")]
    elif kind == "state":
        values = [(F.col("k") - 100).cast("int").alias("rssi"),
                  (F.col("k") / 5.0 - 10.0).alias("snr"),
                  (F.lit(100.0) - F.col("k") / 2.0).alias("battery"),
                  (F.col("k") % 2 == 0).alias("online")]
    else:
        raise ValueError(kind)
    return ev.select(*common_head, *values, *common_tail)


def _line_fields(kind: str) -> list[Column]:
    """Clean CSV fields of one kind, as text."""
    # Fixed-precision text whose exact decimal value has no more digits than the format
    # shows, so every engine renders the same characters (no rounding ties).
    dev, t, k = F.col("device_id"), iso_millis(F.col("event_ts")), F.col("k")
    if kind == "humidity":
        return [dev, t, k.cast("string"), F.col("event_id").cast("string")]
    if kind == "temperature":
        return [dev, t, F.format_string("%.3f", F.col("value") / 10.0 - 10.0),
                F.col("event_id").cast("string")]
    if kind == "location":
        return [dev, t, F.format_string("%.6f", F.lit(54.8433) + k / 10000.0),
                F.format_string("%.6f", F.lit(83.0931) + k / 5000.0)]
    return [dev, t, (k - 100).cast("string"), F.format_string("%.2f", k / 5.0 - 10.0),
            F.format_string("%.1f", F.lit(100.0) - k / 2.0),
            F.when(k % 2 == 0, F.lit("True")).otherwise(F.lit("False"))]


def _bad_time() -> Column:
    """One time text in eight forms, in turn: seven that are no time, one that is (a space, no fraction)."""
    t, turn = iso_millis(F.col("event_ts")), F.col("event_id") / 20
    forms = [F.lit("not-a-time"), F.substring(t, 12, 8), F.concat(F.substring(t, 11, 6), F.lit("Z")), F.substring(t, 1, 4),
             F.concat(F.substring(t, 1, 23), F.lit("+05:00")), F.concat(F.lit("+1"), t), F.lit("2024-02-30T10:00:00.000Z"),
             F.concat(F.substring(t, 1, 10), F.lit(" "), F.substring(t, 12, 8))]
    return F.element_at(F.array(*forms), (F.floor(turn) % 8 + 1).cast("int"))


def _broken_line(kind: str) -> Column:
    """The CSV text with the documented breakages, built from one fields array (one
    per-field edit each) so the expression stays small."""
    f = _line_fields(kind)
    n = len(f)
    r = F.col("event_id") % 20
    int_idx = 2 if kind == "state" else 3  # the field that carries an integer
    edits = {}
    edits.setdefault(2, []).append((r == 7, F.lit("abc")))
    edits.setdefault(1, []).append((r == 19, _bad_time()))
    s = F.col("event_id") % 60
    if kind != "state":
        edits.setdefault(2, []).append((s == 21, F.lit("inf")))
        edits.setdefault(2, []).append((s == 42, F.lit("nan")))
    edits.setdefault(n - 1, []).append((s == 24, F.concat(f[n - 1], F.lit("\n"))))
    if kind == "location":
        edits.setdefault(3, []).append((r == 13, F.lit("")))
        edits.setdefault(2, []).append((r == 17, F.concat(F.lit(" "), f[2], F.lit(" "))))
    else:
        edits.setdefault(int_idx, []).append((r == 13, F.lit(" 5")))
        edits.setdefault(int_idx, []).append((r == 17, F.lit("1.5")))
    fields = []
    for i in range(n):
        col = f[i]
        for cond, value in reversed(edits.get(i, [])):
            col = F.when(cond, value).otherwise(col)
        fields.append(col)
    arr = F.array(*fields)
    arr = F.when(r == 3, F.slice(arr, 1, n - 1)).when(r == 11, F.concat(arr, F.array(F.lit("XXXX")))) \
        .otherwise(arr)
    return F.array_join(arr, ",")


_RAW_CACHE: dict = {}


def raw_messages(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The raw device feed: one row per message, shaped like the Kafka source
    ``(key binary, value binary, topic string, timestamp timestamp)``.

    With ``materialize`` the feed is written once per session as a Parquet table in the shared
    folder and read from there, so – like a real topic or file source – it is an opaque input:
    filters on parsed fields stop at it instead of inlining the line-building expression.
    """
    if materialize:
        key = (id(spark), sf_dir)
        if key not in _RAW_CACHE:
            _RAW_CACHE[key] = written(raw_messages(spark, sf_dir, materialize=False), "raw")
        return _RAW_CACHE[key]
    ev = base_events(spark, sf_dir)
    parts = []
    for kind in ("humidity", "temperature", "location", "state"):
        rows = _kind_rows(ev, kind)
        topic = F.when(F.col("event_id") % 50 == 23,
                       F.concat_ws("/", "env", "tenant", F.lit("devices"), "device_id", F.lit(kind))
                       ).otherwise(device_topic(kind))
        parts.append(rows.select(
            F.col("device_id").cast("binary").alias("key"),
            F.when(F.col("event_id") % 60 == 28, F.concat(F.lit(b"\xff"), _broken_line(kind).cast("binary")))
            .otherwise(_broken_line(kind).cast("binary")).alias("value"),
            topic.alias("topic"),
            F.timestamp_millis(ingest_ms(kind)).alias("timestamp"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fixture_measurement_clock() -> Column:
    """Deterministic stand-in for the join's processing stamp (used after the join)."""
    return F.greatest("humidity_ingested_at", "temperature_ingested_at") + F.lit(MEASUREMENT_DELAY_MS)


def fixture_enrich_clock() -> Column:
    return F.col("measurement_processing_ts_ms") + F.lit(ENRICH_DELAY_MS)


def fixture_history_clock() -> Column:
    return F.timestamp_millis(F.col("enriched_processing_ts_ms") + F.lit(HISTORY_DELAY_MS))
