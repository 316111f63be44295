"""Model: fit on a planted signal, score, version, round trip."""

import pytest
from pyspark.sql import functions as F

from chronoleaf.plans.model import ModelRegistry, OnDemandModel, scored_accuracy, threshold_predictions
from chronoleaf.session import scratch_dir


@pytest.fixture(scope="module")
def frame(spark):
    n = 4000
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        ((F.col("id") * 37) % 100).cast("double").alias("signal"),
        F.when(F.col("id") % 13 == 0, None).otherwise((F.col("id") * 7) % 50).cast("double").alias("noise"),
        (((F.col("id") * 13) % 100 - 50).cast("double")).alias("user_latitude"),
        (((F.col("id") * 29) % 300 - 150).cast("double")).alias("user_longitude"),
        (((F.col("id") * 3) % 120 - 55).cast("double")).alias("latitude"),
        (((F.col("id") * 83) % 340 - 170).cast("double")).alias("longitude"),
        (((F.col("id") * 37) % 100) >= 70).alias("purchased"))


def test_fit_beats_constant_and_round_trips(spark, frame):
    model = OnDemandModel(exclude=["event_id"]).fit(frame, "purchased")
    scored = model.transform(frame)
    assert dict(scored.dtypes)["prediction"] == "float"
    vals = scored.agg(F.min("prediction"), F.max("prediction")).first()
    assert 0.0 <= vals[0] <= vals[1] <= 1.0
    acc = scored_accuracy(scored, "purchased", 0.5).first().accuracy
    assert acc > 0.95  # planted signal; the constant guess is 0.70
    reg = ModelRegistry(spark, scratch_dir(spark, "models-test"))
    assert reg.log_model("m", model) == 1
    assert reg.log_model("m", model) == 2
    assert reg.latest_version("m") == 2
    walked = model.tree_walk(scored)
    assert walked.columns == [*scored.columns, "walked"] and walked.select("walked").distinct().count() > 1
    assert walked.where(F.abs(F.col("walked") - F.col("prediction")) > 1e-6).count() == 0
    again = reg.load("m").transform(frame)
    a = {r.event_id: r.prediction for r in scored.collect()}
    b = {r.event_id: r.prediction for r in again.collect()}
    assert a == b


def test_threshold_renames(spark):
    df = spark.createDataFrame([(0.2,), (0.1,)], "prediction double")
    out = threshold_predictions(df).collect()
    assert [(r.raw_prediction, r.prediction) for r in out] == [(0.2, True), (0.1, False)]
