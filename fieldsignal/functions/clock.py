"""Time-zone-free arithmetic on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the column's own wall clock, as LONG."""
    minutes = F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    seconds = F.date_part(F.lit("SECOND"), ts)
    return minutes * (60 * MICROS_PER_SECOND) + (seconds * MICROS_PER_SECOND).cast("long")
