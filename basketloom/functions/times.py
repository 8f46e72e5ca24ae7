"""Timestamp arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = F.hour(ts) * 60 + F.minute(ts)
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (days * DAY_MICROS + minutes.cast("bigint") * 60_000_000
            + (seconds * 1_000_000).cast("bigint"))


def time_digits(ts: Column) -> list[Column]:
    """Day, minute of day and second: each level has a small, fixed number of values."""
    return [ts.cast("date"), F.hour(ts) * 60 + F.minute(ts), F.date_part(F.lit("SECOND"), ts)]


def instant(value) -> Column:
    """A zone-less timestamp literal (going through text keeps it free of any zone)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
