"""Column builders for turning CSV device lines into typed values.

Everything here is a JVM-side expression (no Python UDF), so parsing stays inside whole-stage
codegen. The numeric rules follow the reference parser's Java semantics:

* integers are strict: optional sign and digits only, no spaces, no decimals; overflow fails;
* doubles accept what ``Double.parseDouble`` accepts: ``try_cast`` reads the same numbers, but also
  words that Java refuses (``inf``, ``nan``), so words are matched first;
* booleans never fail: only a case-insensitive ``true`` is true.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's number-format messages, and the ISO time layout the devices send.
INPUT_STRING_MESSAGE = 'For input string: "{}"'
EMPTY_DOUBLE_MESSAGE = "empty String"
FIELD_COUNT_MESSAGE = "Expected {} fields, got "
NULL_PAYLOAD_MESSAGE = "null payload"
BAD_TIME_MESSAGE = 'Invalid event time: "{}"'
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# \A and \z: ``$`` would also match before a final line break, which Java's parsers refuse
_STRICT_INT = r"\A[+-]?[0-9]+\z"
_DATE_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?Z?\z"
_DOUBLE_WORD = r"(?i)\A[+-]?(inf|infinity|nan)\z"
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def decode_utf8(col: Column) -> Column:
    """Bytes -> string; malformed bytes become U+FFFD, so no record can stop a job."""
    return F.make_valid_utf8(col.cast("string"))


def split_fields(text: Column) -> Column:
    """Split on commas keeping trailing empty fields ('a,b,,' has 4 fields)."""
    return F.split(text, ",", -1)


def strict_long(field: Column) -> Column:
    return F.when(field.rlike(_STRICT_INT), field.try_cast("bigint"))


def strict_int(field: Column) -> Column:
    return F.when(field.rlike(_STRICT_INT), field.try_cast("int"))


def java_double(field: Column) -> Column:
    word = java_trim(field)
    special = (F.when(word.rlike(r"\A[+-]?NaN\z"), F.lit(float("nan")))
               .when(word.isin("Infinity", "+Infinity"), F.lit(float("inf")))
               .when(word == "-Infinity", F.lit(float("-inf"))))
    return F.when(word.rlike(_DOUBLE_WORD), special).otherwise(field.try_cast("double"))


def java_bool(field: Column) -> Column:
    return F.lower(field) == F.lit("true")


def java_trim(field: Column) -> Column:
    return F.regexp_replace(field, _JAVA_TRIM, "")


def integer_error(field: Column, parsed: Column) -> Column:
    """Message of a failed strict integer parse, null when it parsed."""
    return F.when(parsed.isNull(), F.concat(F.lit('For input string: "'), field, F.lit('"')))


def double_error(field: Column, parsed: Column) -> Column:
    trimmed = java_trim(field)
    return F.when(parsed.isNull(),
                  F.when(trimmed == "", F.lit(EMPTY_DOUBLE_MESSAGE))
                  .otherwise(F.concat(F.lit('For input string: "'), trimmed, F.lit('"'))))


def event_time(text: Column) -> Column:
    """ISO text -> TIMESTAMP(3): drop 'T' and 'Z', cast, keep millisecond precision.

    Only a whole date and time is one. Spark's own cast also takes a time without a date (as today), a
    year or a month alone, an offset and a year of five digits, none of which the reference's cast reads.
    """
    cleaned = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return F.when(text.rlike(_DATE_TIME), F.date_trunc("millisecond", F.try_to_timestamp(cleaned)))


def iso_millis(ts: Column) -> Column:
    """Timestamp -> device time text, e.g. 2024-01-05T10:00:00.123Z."""
    return F.date_format(ts, ISO_MILLIS_FORMAT)
