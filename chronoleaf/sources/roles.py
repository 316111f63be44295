"""Map the driver tables onto the reference's data roles.

No travel data ships with the build, so the purchase log, destination
dimension, availability log and request batches are derived by Spark from the
``events`` and ``nation`` tables.  Every role is a lazy DataFrame over the
whole table: its work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.functions.time import to_date

# Fixed values of the role mapping
N_DESTINATIONS = 25
TRAIN_CUTOFF = "2024-01-23"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> purchase log: user_id, ts, destination_id, booking_date, price,
    purchased, clicked, user_latitude, user_longitude (+ event_id as row id)."""
    e = table(spark, sf_dir, "events")
    no_location = (F.col("user_id") % 11) == 0
    return e.select(
        F.col("event_id"),
        F.col("user_id"),
        F.col("ts"),
        (F.col("event_id") % N_DESTINATIONS).cast("int").alias("destination_id"),
        to_date("ts").alias("booking_date"),
        F.col("value").alias("price"),
        (F.col("event_type") == "purchase").alias("purchased"),
        (F.col("event_type") == "click").alias("clicked"),
        F.when(~no_location, ((F.col("user_id") * 13) % 100 - 50).cast("double"))
        .alias("user_latitude"),
        F.when(~no_location, ((F.col("user_id") * 29) % 300 - 150).cast("double"))
        .alias("user_longitude"),
    )


def destination_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> destination dimension: destination_id, name, price, latitude, longitude."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.cast("int").alias("destination_id"),
        F.col("n_name").alias("name"),
        (F.lit(100) + k).cast("int").alias("price"),
        ((k * 37) % 120 - 55).cast("double").alias("latitude"),
        ((k * 83) % 340 - 170).cast("double").alias("longitude"),
    )


def availability_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'view' events -> availability log rows (the streaming source's content)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    dest = (F.col("event_id") % N_DESTINATIONS).cast("int")
    return e.select(
        F.col("ts").cast("timestamp").alias("event_ts"),
        dest.alias("destination_id"),
        F.concat(F.lit("NATION_"), dest.cast("string")).alias("name"),
        to_date("ts").alias("booking_date"),
        F.col("value").cast("double").alias("price"),
        F.get_json_object("props", "$.k").cast("int").alias("availability"),
    )


def training_labels(log: DataFrame) -> DataFrame:
    """Label rows: the purchase log before the cut-off (P5)."""
    from chronoleaf.operators.split import time_split
    before, _after = time_split(log, "ts", TRAIN_CUTOFF)
    return before


def requests(log: DataFrame) -> DataFrame:
    """Request records: keys and context only, no ts, no price."""
    return log.select("event_id", "user_id", "booking_date", "destination_id",
                      "user_latitude", "user_longitude")
