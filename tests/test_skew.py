"""Hot keys: one key holds a third of all rows; it must be split, results unchanged."""

import pytest
from pyspark.sql import functions as F

from chronoleaf.functions.time import epoch_seconds
from chronoleaf.operators.asof import asof_join
from chronoleaf.operators.rolling import rolling_aggregate, rolling_count, rolling_sum
from chronoleaf.operators.skew import add_bucket, plan_buckets

N = 30_000
TARGET = 1_000


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 gets every third row; the rest spread over 2,000 keys; 30 days of time
    return spark.range(N).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919) % (30 * 86400)).alias("ts"),
        ((F.col("id") * 31) % 1000 / 100).alias("price"))


def test_hot_key_is_split_into_many_buckets(spark, skewed):
    base = skewed.withColumn("__s", epoch_seconds("ts"))
    plan = plan_buckets([base], ["k"], "__s", target_rows=TARGET)
    assert plan.mode == "heavy"
    heavy_keys = {r.k for r in plan.heavy.collect()}
    assert heavy_keys == {0}
    per_bucket = (add_bucket(base, plan, ["k"]).where("k = 0").groupBy("__b").count()
                  .agg(F.count("*").alias("buckets"), F.max("count").alias("largest")).first())
    assert per_bucket.buckets >= 8                 # 10,000 rows at ~1,000 per bucket
    assert per_bucket.largest <= 3 * TARGET
    # ordinary keys stay in one bucket each
    assert add_bucket(base, plan, ["k"]).where("k <> 0").select("__b").distinct().count() == 1


def test_rolling_with_split_hot_key_equals_window(spark, skewed):
    aggs = [rolling_sum("s", "price", 3 * 86400), rolling_count("n", 3 * 86400)]
    a = rolling_aggregate(skewed, ["k"], "ts", aggs, target_rows=TARGET)
    b = rolling_aggregate(skewed, ["k"], "ts", aggs, strategy="window")
    diff = a.select("i", "s", "n").exceptAll(b.select("i", "s", "n"))
    assert diff.count() == 0 and a.count() == N


def test_asof_with_split_hot_key_equals_window(spark, skewed):
    labels = skewed.select("i", "k", (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("ts"))
    feats = skewed.where(F.col("i") % 2 == 0).select("k", "ts", F.col("price").alias("f"))
    a = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], target_rows=TARGET)
    b = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], strategy="window")
    assert a.count() == N
    assert a.exceptAll(b).count() == 0


def test_sampled_detection_keeps_results_exact(spark, skewed, monkeypatch):
    # a 20 % sample decides the buckets; the answers must not depend on it
    import chronoleaf.operators.skew as skew
    monkeypatch.setattr(skew, "SAMPLE_ROWS", TARGET // 5)
    base = skewed.withColumn("__s", epoch_seconds("ts"))
    plan = plan_buckets([base], ["k"], "__s", target_rows=TARGET)
    assert plan.mode == "heavy" and {r.k for r in plan.heavy.collect()} == {0}
    aggs = [rolling_sum("s", "price", 3 * 86400), rolling_count("n", 3 * 86400)]
    a = rolling_aggregate(skewed, ["k"], "ts", aggs, target_rows=TARGET)
    b = rolling_aggregate(skewed, ["k"], "ts", aggs, strategy="window")
    assert a.count() == N and a.select("i", "s", "n").exceptAll(b.select("i", "s", "n")).count() == 0
    labels = skewed.select("i", "k", (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("ts"))
    feats = skewed.where(F.col("i") % 2 == 0).select("k", "ts", F.col("price").alias("f"))
    c = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], target_rows=TARGET)
    d = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], strategy="window")
    assert c.count() == N and c.exceptAll(d).count() == 0


@pytest.fixture(scope="module")
def uneven(spark):
    # one key; 90 % of its timed rows within an hour of a 300-day span, half of all rows without a time
    secs = F.when(F.col("id") % 10 == 0, (F.col("id") * 7919) % (300 * 86400)).otherwise(F.lit(8_000_000) + F.col("id") % 3600)
    return spark.range(40_000).select(
        F.col("id").alias("i"), F.lit(1).alias("k"),
        F.when(F.col("id") % 2 == 1, F.timestamp_seconds(F.lit(1704067200) + secs)).alias("ts"),
        ((F.col("id") * 31) % 1000 / 100).alias("price"))


@pytest.mark.parametrize("sampled", [10_000, 200])
def test_uneven_times_and_null_times_are_split(spark, uneven, monkeypatch, sampled):
    import chronoleaf.operators.skew as skew
    monkeypatch.setattr(skew, "SAMPLE_ROWS", sampled)
    base = uneven.withColumn("__s", epoch_seconds("ts"))
    plan = plan_buckets([base], ["k"], "__s", target_rows=TARGET)
    sizes = add_bucket(base, plan, ["k"], salt=F.xxhash64("i")).groupBy("__b").count().collect()
    assert max(r["count"] for r in sizes) <= 3 * TARGET and all(r["__b"] is not None for r in sizes)
    aggs = [rolling_sum("s", "price", 1800), rolling_count("n", 1800), rolling_count("np", 1800, value="price")]
    a = rolling_aggregate(uneven, ["k"], "ts", aggs, target_rows=TARGET)
    b = rolling_aggregate(uneven, ["k"], "ts", aggs, strategy="window")
    assert a.count() == 40_000 and a.exceptAll(b).count() == 0
    feats = uneven.where("i % 7 = 0").select("k", "ts", F.col("price").alias("f"), "i").withColumnRenamed("i", "j")
    c = asof_join(uneven, feats, "k", "k", "ts", "ts", ["f", "j"], target_rows=TARGET)
    d = asof_join(uneven, feats, "k", "k", "ts", "ts", ["f", "j"], strategy="window")
    assert c.count() == 40_000 and c.exceptAll(d).count() == 0
