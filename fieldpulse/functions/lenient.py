"""Lenient decoders for values read back from the key-value view (string maps).

Blank or malformed text never raises: it becomes null, or 0 for ``lenient_int``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse.constants import BOOL_FALSE_WORDS, BOOL_TRUE_WORDS, SECONDS_CUTOFF
from fieldpulse.functions.parsing import java_double, java_trim, strict_int, strict_long


_ISO_DATE_TIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?\z"


def _blank(v: Column) -> Column:
    return v.isNull() | (java_trim(v) == "")


def lenient_int_or_null(v: Column) -> Column:
    return F.when(~_blank(v), strict_int(v))


def lenient_int(v: Column) -> Column:
    return F.coalesce(lenient_int_or_null(v), F.lit(0))


def lenient_long_or_null(v: Column) -> Column:
    return F.when(~_blank(v), strict_long(v))


def lenient_double_or_null(v: Column) -> Column:
    return F.when(~_blank(v), java_double(v))


def lenient_bool_or_null(v: Column) -> Column:
    low = F.lower(v)
    return (F.when(_blank(v), F.lit(None).cast("boolean"))
            .when(low.isin(*BOOL_TRUE_WORDS), F.lit(True))
            .when(low.isin(*BOOL_FALSE_WORDS), F.lit(False)))


def lenient_ts_millis(v: Column) -> Column:
    """Epoch millis from: an integer (below the cut-off it is seconds), an ISO instant
    ('...Z' or with offset), or a zone-less ISO local date-time read as UTC."""
    n = strict_long(v)
    from_number = F.when(n < F.lit(SECONDS_CUTOFF), n * 1000).otherwise(n)
    # Java's ISO parsers: 'T' separator required; seconds and fraction optional
    text = F.when(n.isNull() & v.rlike(_ISO_DATE_TIME), v)
    iso = F.unix_millis(F.try_to_timestamp(text))
    return F.when(~_blank(v), F.coalesce(from_number, iso))
