"""Time scalars (F1-F3, F8).  All are built-in column expressions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoleaf.functions._util import as_col

SECONDS_PER_DAY = 86400


def as_timestamp(ts) -> Column:
    """Normalise TIMESTAMP_NTZ / strings to session-zone TIMESTAMP (trap T1)."""
    return as_col(ts).cast("timestamp")


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds, floored (the window order key of the reference)."""
    return F.unix_seconds(as_timestamp(ts))


def to_date(value) -> Column:
    return F.to_date(as_col(value))


def day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(as_timestamp(ts))


def day_stamp(ts, offset_hours: int = -5) -> Column:
    """``yyyyMMdd`` of ``ts`` at a fixed UTC offset, no daylight saving (F8).

    ``ts`` is read as UTC wall-clock time; the session zone does not matter
    because the shift is applied to the zone-free value.
    """
    shifted = F.timestamp_add("HOUR", F.lit(offset_hours), as_col(ts).cast("timestamp_ntz"))
    return F.date_format(shifted, "yyyyMMdd")
