"""Normalizer fidelity rules on hand-made raw lines."""

from pyspark.sql import functions as F

from fieldpulse.operators.normalize import error_records, ok_records, parse_readings
from fieldpulse.sources.topics import route_by_topic

TOPIC = "prod/tenant-1/sensors/dev-1/{}"
T = "2024-01-05T10:00:00.123Z"


def raw(spark, kind, lines):
    data = [(None if v is None else bytearray(v.encode()), TOPIC.format(kind)) for v in lines]
    df = spark.createDataFrame(data, "value binary, topic string")
    return route_by_topic(df.withColumn("key", F.lit(None).cast("binary"))
                          .withColumn("timestamp", F.lit(None).cast("timestamp")))


def parse(spark, kind, lines):
    return parse_readings(raw(spark, kind, lines), kind, ingest_ms=F.lit(1000))


def errors_by_payload(df):
    return {r.rawPayload: r.errorMessage for r in error_records(df).collect()}


def test_humidity_ok_and_field_count(spark):
    df = parse(spark, "humidity", [f"d1,{T},61.2,42", f"d1,{T},61.2", f"d1,{T},61.2,42,XXXX", f"d1,{T},1,2,,"])
    ok = ok_records(df, "humidity").collect()
    assert [(r.deviceId, r.humidity, r.seq, r.ingestedAt, r.env, r.tenant) for r in ok] == \
        [("d1", 61.2, 42, 1000, "prod", "tenant-1")]
    err = errors_by_payload(df)
    assert err[f"d1,{T},61.2"] == "Expected 4 fields, got 3"
    assert err[f"d1,{T},61.2,42,XXXX"] == "Expected 4 fields, got 5"
    assert err[f"d1,{T},1,2,,"] == "Expected 4 fields, got 6"  # trailing empties count


def test_integers_are_strict(spark):
    lines = [f"d,{T},1.0,{v}" for v in (" 5", "1.5", "99999999999999999999", "+7", "-3", "")]
    df = parse(spark, "humidity", lines)
    ok = sorted(r.seq for r in ok_records(df, "humidity").collect())
    assert ok == [-3, 7]
    err = errors_by_payload(df)
    assert err[f"d,{T},1.0, 5"] == 'For input string: " 5"'
    assert err[f"d,{T},1.0,1.5"] == 'For input string: "1.5"'
    assert err[f"d,{T},1.0,99999999999999999999"] == 'For input string: "99999999999999999999"'
    assert err[f"d,{T},1.0,"] == 'For input string: ""'


def test_doubles_follow_java(spark):
    lines = [f"d,{T},{v},1" for v in ("NaN", "5f", " 6.5 ", "abc", "", "  ")]
    df = parse(spark, "humidity", lines)
    vals = {r.humidity for r in ok_records(df, "humidity").collect()}
    assert 5.0 in vals and 6.5 in vals and any(v != v for v in vals)  # NaN parsed
    err = errors_by_payload(df)
    assert err[f"d,{T},abc,1"] == 'For input string: "abc"'
    assert err[f"d,{T},,1"] == "empty String"
    assert err[f"d,{T},  ,1"] == "empty String"


def test_booleans_never_fail(spark):
    vals = ["True", "TRUE", "true", "yes", "", "1", "False"]
    df = parse(spark, "state", [f"d{i},{T},-71,4.2,98.5,{v}" for i, v in enumerate(vals)])
    got = {r.deviceId: r.online for r in ok_records(df, "state").collect()}
    assert got == {"d0": True, "d1": True, "d2": True, "d3": False, "d4": False, "d5": False, "d6": False}


def test_state_int_overflow_and_order_of_errors(spark):
    df = parse(spark, "state", [f"d,{T},99999999999,abc,1,true", f"d,{T},-71,abc,zz,true"])
    err = errors_by_payload(df)
    assert err[f"d,{T},99999999999,abc,1,true"] == 'For input string: "99999999999"'
    assert err[f"d,{T},-71,abc,zz,true"] == 'For input string: "abc"'  # first failing field


def test_no_validation_of_id_bad_time_and_null_payload(spark):
    df = parse(spark, "location", [f",{T},54.8,83.0", "d,not-a-time,54.8,83.0", None])
    ok = ok_records(df, "location").collect()
    assert [(r.deviceId, r.lat) for r in ok] == [("", 54.8)]
    err = error_records(df).collect()
    msgs = sorted((r.rawPayload or "<null>", r.errorMessage) for r in err)
    assert msgs == [("<null>", "null payload"), ("d,not-a-time,54.8,83.0", 'Invalid event time: "not-a-time"')]


def test_event_time_millis(spark):
    df = parse(spark, "humidity", ["d,2024-01-05T10:00:00.123Z,1,1", "d,2024-01-05T10:00:00Z,1,2"])
    got = {r.seq: r.event_ts.isoformat() for r in df.collect()}
    assert got == {1: "2024-01-05T10:00:00.123000", 2: "2024-01-05T10:00:00"}


def test_route_by_topic(spark):
    topics = ["prod/t1/sensors/d1/humidity", "prod/t1/devices/d1/humidity", "prod/t1/sensors/d1/other",
              "a/b/sensors/c/state/extra", "//sensors//location", "prod/t1/sensors/d1"]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    got = {r.topic: (r.env, r.tenant, r.topic_device, r.kind) for r in route_by_topic(df).collect()}
    assert got["prod/t1/sensors/d1/humidity"] == ("prod", "t1", "d1", "humidity")
    assert got["//sensors//location"] == ("", "", "", "location")  # '+' matches an empty level
    for t in topics[1:4] + topics[5:]:
        assert got[t] == (None, None, None, None)


def test_read_raw_files_batch_and_stream(spark, tmp_path):
    from conftest import SF_SMALL
    from fieldpulse.sources import fixtures as FX
    from fieldpulse.sources.topics import read_raw_files
    path = str(tmp_path / "raw")
    FX.raw_messages(spark, SF_SMALL).write.parquet(path)
    batch = read_raw_files(spark, path)
    assert batch.columns == ["key", "value", "topic", "timestamp"]
    assert batch.count() == FX.raw_messages(spark, SF_SMALL).count()
    stream = read_raw_files(spark, path, stream=True)
    assert stream.isStreaming and stream.columns == batch.columns
    q = (route_by_topic(stream).writeStream.format("memory").queryName("raw_files")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ckpt")).start())
    q.awaitTermination()
    assert spark.table("raw_files").filter("kind IS NOT NULL").count() == \
        route_by_topic(batch).filter("kind IS NOT NULL").count()


def test_java_words_line_breaks_and_bad_bytes(spark):
    lines = [b"d,2024-01-05T10:00:00.000Z,%s,%s" % v for v in ((b"inf", b"1"), (b"NaN", b"2"), (b"nan", b"3"), (b"-Infinity", b"4"), (b"infinity", b"5"),
                                                               (b"7.5\n", b"6"), (b"1", b"7\n"), (b"+NaN ", b"8"), (b"5f", b"9"))]
    lines += [b"\xffd,2024-01-05T10:00:00.000Z,1,10", b"d,2024-01-05T10:00:00.000Z,\xff,11", b"d,2024-01-05T10:00:00.000Z,1,\xff", b"d,\xff,1,12"]
    df = parse_readings(spark.createDataFrame([(b, "t") for b in lines], "value binary, topic string"), "humidity", ingest_ms=F.lit(0))
    ok = {r.seq: (r.deviceId, str(r.humidity)) for r in ok_records(df, "humidity").collect()}
    assert ok == {2: ("d", "nan"), 4: ("d", "-inf"), 6: ("d", "7.5"), 8: ("d", "nan"), 9: ("d", "5.0"), 10: ("\ufffdd", "1.0")}
    errors = sorted(r.errorMessage for r in error_records(df).collect())
    assert errors == sorted(['For input string: "inf"', 'For input string: "nan"', 'For input string: "infinity"', 'For input string: "7\n"',
                             'For input string: "\ufffd"', 'For input string: "\ufffd"', 'Invalid event time: "\ufffd"'])


def test_event_time_takes_whole_dates_and_times_only(spark):
    """Nothing that depends on the day it is read, no offsets, no dates that there aren't."""
    good = {"2024-01-05T10:00:00.123Z": "2024-01-05 10:00:00.123", "2024-01-05 10:00:00": "2024-01-05 10:00:00",
            "2024-01-05T10:00:00.1234567": "2024-01-05 10:00:00.123", "2024-02-29T23:59:59Z": "2024-02-29 23:59:59"}
    bad = ["10:00:00", "T10:00Z", "T10:00:00Z", "2024", "2024-01", "2024-01-05", "2024-01-05T10:00Z", "2024-01-05T10:00:00+05:00", "+12024-01-05T10:00:00Z",
           "12024-01-05T10:00:00Z", "2024-02-30T10:00:00Z", "2024-13-01T10:00:00Z", "2024-01-05T24:00:00Z", "2024-01-05T10:00:00.Z", "2024-01-05T10:00:00Z\n",
           " 2024-01-05T10:00:00Z", "2024-01-05T10:00:00 UTC", "epoch", "now", "", "not-a-time"]
    from fieldpulse.functions.parsing import event_time
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None]], "t string").select("t", event_time(F.col("t")).cast("string").alias("ts"))
    assert {r.t: r.ts for r in df.collect()} == {**good, **dict.fromkeys(bad), None: None}
    err = errors_by_payload(parse(spark, "humidity", [f"d,{t},1.0,1" for t in ("10:00:00", "2024", "2024-01-05T10:00:00+05:00")]))
    assert err["d,2024,1.0,1"] == 'Invalid event time: "2024"' and len(err) == 3
