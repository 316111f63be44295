"""String scalars used for naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoleaf.functions._util import as_col


def clean_user_name(name) -> Column:
    """lower-case, cut at the first '@', '.' -> '_' (names of per-user databases)."""
    local = F.split(F.lower(as_col(name)), "@").getItem(0)
    return F.replace(local, F.lit("."), F.lit("_"))


def current_user_name() -> Column:
    return clean_user_name(F.current_user())
