"""On-demand features computed from request context.

``distance`` between the user's location and the destination, with NULL
coordinates filled by medians for the distance only (the four coordinate
columns themselves stay as they are and remain model inputs).  Medians are
either given (``fit`` mode: training medians reused at scoring time, no
train/serve skew) or computed over the batch passed in (``batch`` mode, as the
reference does).  Everything is SQL (no Python worker).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoleaf.functions.geo import (distance_select_sql, geodesic_miles_sql, haversine_miles_sql,
                                     with_distance)
from chronoleaf.operators.stats import exact_medians

# The location columns of the reference's model input
LOCATION_COLUMNS = ("user_longitude", "user_latitude", "longitude", "latitude")


def _lit(v) -> str:
    if isinstance(v, str):  # already an SQL expression
        return f"CAST({v} AS DOUBLE)"
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({float(v)!r} AS DOUBLE)"


def distance_sql(medians: dict, method: str = "geodesic", strict: bool = False) -> str:
    """One Spark SQL expression of the median-filled distance; add_distance() is the fast form."""
    f = _filled(medians)
    fn = geodesic_miles_sql if method == "geodesic" else haversine_miles_sql
    body = fn(f["user_latitude"], f["user_longitude"], f["latitude"], f["longitude"])
    return _guard(f, body, strict)


def location_medians(df: DataFrame) -> dict:
    return exact_medians(df, list(LOCATION_COLUMNS))


def _filled(medians: dict) -> dict:
    return {c: f"coalesce(CAST({c} AS DOUBLE), {_lit(medians.get(c))})" for c in LOCATION_COLUMNS}


def _guard(filled: dict, raw: str, strict: bool) -> str:
    valid = f"abs({filled['user_latitude']}) <= 90 AND abs({filled['latitude']}) <= 90"
    bad = "raise_error('latitude outside [-90, 90]')" if strict else "CAST(NULL AS DOUBLE)"
    return f"CASE WHEN {valid} THEN {raw} WHEN ({valid}) IS NULL THEN CAST(NULL AS DOUBLE) ELSE {bad} END"


def add_distance(df: DataFrame, medians: dict | None = None, *, method: str = "geodesic",
                 strict: bool = False, name: str = "distance") -> DataFrame:
    """Append the median-filled distance, computed in stages (each intermediate once)."""
    if medians is None:
        medians = location_medians(df)
    f = _filled(medians)
    out = with_distance(df, f["user_latitude"], f["user_longitude"], f["latitude"], f["longitude"],
                        out="__raw_distance", method=method)
    return out.withColumn(name, F.expr(_guard(f, "__raw_distance", strict))).drop("__raw_distance")


def distance_transform_sql(medians: dict, method: str = "geodesic", strict: bool = False,
                           name: str = "distance", source: str = "__THIS__") -> str:
    """The same as SQL over ``source`` (for a saved ``SQLTransformer``)."""
    f = _filled(medians)
    inner = distance_select_sql(f["user_latitude"], f["user_longitude"], f["latitude"],
                                f["longitude"], "__raw_distance", method, source)
    return f"SELECT *, {_guard(f, '__raw_distance', strict)} AS {name} FROM ({inner})"
