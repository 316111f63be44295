"""Flag, ratio and threshold scalars (P3, P4, P8, A2 helper)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoleaf.functions._util import as_col


def flag01(flag) -> Column:
    """TRUE -> 1, FALSE or NULL -> 0 (int)."""
    return F.when(as_col(flag) == F.lit(True), F.lit(1)).otherwise(F.lit(0))


def ratio(numerator, denominator) -> Column:
    """Plain double division; NULL numerator stays NULL, zero divisor gives NULL."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def threshold(score, cut: float = 0.2) -> Column:
    """score >= cut -> TRUE, otherwise (including NULL) FALSE."""
    return F.when(as_col(score) >= F.lit(cut), F.lit(True)).otherwise(F.lit(False))
