"""Calendar parts of zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(c: Column | str) -> Column:
    """ISO text to ``timestamp_ntz``; unreadable text is NULL under ANSI too."""
    text = F.col(c) if isinstance(c, str) else c
    return text.try_cast("timestamp_ntz")


def truncate_hour(ts: Column) -> Column:
    """Start of the hour, built from parts so that the session zone plays no role."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )
