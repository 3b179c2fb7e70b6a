"""Wall-clock stamps and relative time ranges.

Every operator that stamps a time takes the stamp as a Column parameter, so tests and the
oracle comparison can pass a deterministic expression; the default is the query's
``current_timestamp()``, which Spark evaluates once per query / micro-batch (not per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse.constants import RANGE_BACK


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def whole_seconds(ms: Column) -> Column:
    """Epoch ms without the fraction of the second."""
    return F.floor(ms / F.lit(1000)) * F.lit(1000)


def processing_ms(second_resolution: bool = False, at_ms: Column | None = None) -> Column:
    """Processing stamp in epoch ms (default: now). ``second_resolution=True`` reproduces the
    reference's ``UNIX_TIMESTAMP() * 1000`` (drops the fraction of the second, which is why its
    create->measurement latencies come out negative)."""
    ms = at_ms if at_ms is not None else now_ms()
    return whole_seconds(ms) if second_resolution else ms


def range_back(as_of: Column, bucket: str) -> Column:
    """Start of the default look-back range ending at ``as_of`` for a metrics bucket."""
    return as_of - F.expr(f"INTERVAL {RANGE_BACK[bucket.upper()]}")


def greatest_nonneg(*cols: Column) -> Column:
    """max(0, c1, c2, ...) skipping nulls; 0 when all are null."""
    return F.greatest(F.lit(0).cast("long"), *[F.coalesce(c, F.lit(0).cast("long")) for c in cols])
