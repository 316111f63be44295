"""The reference's two batch feature groups.

Both are one rolling pass over the purchase log: a single shuffle by the
feature key, all window lengths computed together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoleaf.functions.flags import flag01
from chronoleaf.functions.time import SECONDS_PER_DAY, day_of_week
from chronoleaf.operators.rolling import rolling_aggregate, rolling_count, rolling_sum

# Fixed values of the reference's feature definitions
WEEK_SECONDS = 7 * SECONDS_PER_DAY
SIX_MONTHS_SECONDS = 6 * 30 * SECONDS_PER_DAY


def user_features(log: DataFrame, *, strategy: str = "events",
                  bucket_seconds: int | None = None, exclude_current: bool = False) -> DataFrame:
    """user_id, ts, mean_price_7d, last_6m_purchases, day_of_week."""
    src = log.select("user_id", "ts", "price",
                     flag01("purchased").alias("tickets_purchased"))
    rolled = rolling_aggregate(
        src, ["user_id"], "ts",
        [rolling_sum("lookedup_price_7d_rolling_sum", "price", WEEK_SECONDS, exclude_current=exclude_current),
         rolling_count("lookups_7d_rolling_sum", WEEK_SECONDS, exclude_current=exclude_current),
         rolling_sum("last_6m_purchases", "tickets_purchased", SIX_MONTHS_SECONDS, exclude_current=exclude_current)],
        strategy=strategy, bucket_seconds=bucket_seconds)
    return rolled.select(
        "user_id", "ts",
        (F.col("lookedup_price_7d_rolling_sum") / F.nullif(F.col("lookups_7d_rolling_sum"), F.lit(0)))
        .alias("mean_price_7d"),
        "last_6m_purchases",
        day_of_week("ts").alias("day_of_week"),
    )


def destination_features(log: DataFrame, *, strategy: str = "events",
                         bucket_seconds: int | None = None, exclude_current: bool = False) -> DataFrame:
    """destination_id, ts, sum_clicks_7d, sum_impressions_7d; with ``exclude_current`` a row's own click and impression
    do not reach its features (no click before: NULL)."""
    src = log.select("destination_id", "ts", flag01("clicked").alias("clicked"))
    rolled = rolling_aggregate(
        src, ["destination_id"], "ts",
        [rolling_sum("sum_clicks_7d", "clicked", WEEK_SECONDS, exclude_current=exclude_current),
         rolling_count("sum_impressions_7d", WEEK_SECONDS, exclude_current=exclude_current)],
        strategy=strategy, bucket_seconds=bucket_seconds)
    return rolled.select("destination_id", "ts", "sum_clicks_7d", "sum_impressions_7d")
