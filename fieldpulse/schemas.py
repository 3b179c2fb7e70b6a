"""Explicit schemas for every record type (no inference anywhere)."""

from pyspark.sql import types as T

S, D, L, I, B, TS = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                     T.BooleanType(), T.TimestampType())


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Raw message as it comes off a topic (the Kafka source's shape, minus partition/offset).
RAW = _struct(("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", S), ("timestamp", TS))

HUMIDITY = _struct(("deviceId", S), ("eventTime", S), ("humidity", D), ("seq", L),
                   ("ingestedAt", L), ("sourceTopic", S))
TEMPERATURE = _struct(("deviceId", S), ("eventTime", S), ("temperature", D), ("seq", L),
                      ("ingestedAt", L), ("sourceTopic", S))
LOCATION = _struct(("deviceId", S), ("eventTime", S), ("lat", D), ("lon", D),
                   ("ingestedAt", L), ("sourceTopic", S))
STATE = _struct(("deviceId", S), ("eventTime", S), ("rssi", I), ("snr", D), ("battery", D),
                ("online", B), ("ingestedAt", L), ("sourceTopic", S))
PARSE_ERROR = _struct(("sourceTopic", S), ("rawPayload", S), ("errorMessage", S), ("failedAt", L))

TYPED = {"humidity": HUMIDITY, "temperature": TEMPERATURE, "location": LOCATION, "state": STATE}

MEASUREMENT = _struct(
    ("device_id", S), ("env", S), ("tenant", S),
    ("humidity", D), ("temperature", D),
    ("humidity_seq", L), ("temperature_seq", L),
    ("humidity_event_time", S), ("temperature_event_time", S),
    ("humidity_ingested_at", L), ("temperature_ingested_at", L),
    ("measurement_event_ts", TS), ("measurement_processing_ts_ms", L),
)

ENRICHED = _struct(
    ("device_id", S), ("env", S), ("tenant", S),
    ("lat", D), ("lon", D), ("humidity", D), ("temperature", D),
    ("humidity_seq", L), ("temperature_seq", L),
    ("humidity_event_time", S), ("temperature_event_time", S),
    ("state_event_time", S), ("location_event_time", S),
    ("humidity_ingested_at", L), ("temperature_ingested_at", L),
    ("state_ingested_at", L), ("location_ingested_at", L),
    ("measurement_event_ts", TS), ("measurement_processing_ts_ms", L),
    ("enriched_processing_ts_ms", L),
    ("rssi", I), ("snr", D), ("battery", D), ("online", B),
    ("redis_key", S),
)
ENRICHED_COLUMNS = [f.name for f in ENRICHED.fields]

RECENT_SUMMARY = _struct(
    ("redis_key", S), ("env", S), ("tenantId", S),
    ("window_start", TS), ("window_end", TS),
    ("windowSeconds", L), ("totalDevices", L), ("onlineDevices", L), ("offlineDevices", L),
    ("avgTemp", D), ("avgHumidity", D),
    ("minEventTs", TS), ("maxEventTs", TS),
    ("minMeasurementProcessingTsMs", L), ("maxMeasurementProcessingTsMs", L),
    ("minEnrichedProcessingTsMs", L), ("maxEnrichedProcessingTsMs", L),
)
RECENT_SUMMARY_COLUMNS = [f.name for f in RECENT_SUMMARY.fields]

LOW_HUMIDITY_STREAK = _struct(
    ("redis_key", S), ("env", S), ("tenantId", S), ("device_id", S), ("threshold", D),
    ("last_event_ts", TS), ("last_ok_event_ts", TS), ("streak_days", D), ("last_humidity", D),
    ("last_measurement_processing_ts_ms", L), ("last_enriched_processing_ts_ms", L),
    ("last_humidity_ingested_at", L),
)
LOW_HUMIDITY_STREAK_COLUMNS = [f.name for f in LOW_HUMIDITY_STREAK.fields]
