"""Broadcast size checks: a side is broadcast only with proven row and byte bounds."""

import pytest
from pyspark.sql import functions as F

from chronoleaf.operators.lookup import (ROW_OVERHEAD_BYTES, broadcast_size, checked_broadcast,
                                         hot_keys, key_lookup)
from chronoleaf.session import scratch_dir


def _hinted(df) -> bool:
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_broadcast_size_counts_rows_and_string_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "é")], "k int, s string")
    n, size = broadcast_size(df)
    # per row: overhead + int (4 + null flag) + string slot (8); strings by UTF-8 length
    assert n == 3
    assert size == 3 * (ROW_OVERHEAD_BYTES + 5 + 8) + 3 + 2


def test_large_files_are_turned_away_unread(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).write.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size-check", "")
    assert not _hinted(checked_broadcast(spark.read.parquet(path), max_bytes=1000))
    jobs = tracker.getJobIdsForGroup("size-check")
    assert _hinted(checked_broadcast(spark.read.parquet(path)))
    assert len(tracker.getJobIdsForGroup("size-check")) > len(jobs)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_size_check_sends_one_row_per_task(spark):
    plan = spark.range(1000).agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Limit" not in plan


def test_checked_broadcast_needs_both_bounds(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert _hinted(checked_broadcast(df))
    assert not _hinted(checked_broadcast(df, max_bytes=50_000))   # ~100 KB of text
    assert not _hinted(checked_broadcast(df, max_rows=99))


def test_key_lookup_same_answer_either_way(spark):
    left = spark.range(50).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    a = key_lookup(left, right, "k", "k", ["f"])
    b = key_lookup(left, right, "k", "k", ["f"], broadcast_max_bytes=1)
    assert a.count() == 50 and a.exceptAll(b).count() == 0
    assert a.where("k >= 5").where(F.col("f").isNotNull()).count() == 0


def _requests(spark):
    """Half the rows have key 3, a tenth have none, a few have a key that the right side lacks."""
    n = F.col("id")
    return spark.range(0, 20_000, 1, 8).select(
        "id", F.when(n % 2 == 0, F.lit(3)).when(n % 10 == 1, F.lit(None)).otherwise(n % 977).alias("k"))


def test_hot_keys_are_found_and_null_counts_as_one(spark):
    left = _requests(spark)
    assert {r.k for r in hot_keys(left, ["k"], 1000).collect()} == {3, None}
    assert hot_keys(left, ["k"], 100_000) is None and hot_keys(left.limit(0), ["k"], 10) is None


@pytest.mark.parametrize("hot_rows", [1, 1000, 15_000])
def test_hot_keys_split_gives_the_same_rows(spark, hot_rows):
    left = _requests(spark)
    right = spark.range(900).select(F.col("id").cast("int").alias("k"), F.col("id").cast("string").alias("f"),
                                    F.when(F.col("id") != 3, F.lit(1.5)).alias("g"))
    want = key_lookup(left, right, "k", "k", rename={"f": "name"}, broadcast=True)
    got = key_lookup(left, right, "k", "k", rename={"f": "name"}, broadcast=False, hot_rows=hot_rows)
    assert got.columns == ["id", "k", "name", "g"] and got.dtypes == want.dtypes
    assert got.count() == 20_000 and got.exceptAll(want).count() == 0


def test_two_part_keys_with_a_hot_pair(spark):
    left = _requests(spark).withColumn("d", F.when(F.col("id") % 6 == 0, F.lit("x")))
    right = spark.createDataFrame([(3, "x", 1), (5, "x", 2)], "k long, d string, f int")
    want = key_lookup(left, right, ["k", "d"], ["k", "d"], broadcast=True)
    got = key_lookup(left, right, ["k", "d"], ["k", "d"], broadcast=False, hot_rows=1000)
    assert got.exceptAll(want).count() == 0 and got.where("f = 1").count() == want.where("f = 1").count() > 3000


def test_no_task_holds_a_hot_key(spark):
    left = _requests(spark)
    right = spark.range(977).select(F.col("id").alias("k"), F.col("id").alias("f"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def rows(hot_rows):
            out = key_lookup(left, right, "k", "k", broadcast=False, hot_rows=hot_rows)
            return sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        split, plain = rows(1000), rows(1_000_000)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert split[-1] <= 3 * split[len(split) // 2] and plain[-1] > 10_000 and sum(split) == sum(plain)


def test_published_snapshot_has_buckets_by_its_size(spark, monkeypatch):
    from chronoleaf.plans import catalog
    cat = catalog.FeatureCatalog(spark, database="sized_buckets", root=scratch_dir(spark, "catalog"))
    df = spark.range(4000).select(F.col("id").alias("k"), F.rand(1).alias("v"))
    cat.create_table("dim", "k", df=df)
    cat.publish_table("dim")
    assert "bucket" not in spark.sql(f"DESCRIBE EXTENDED {cat.qualified('dim__online_v1')}").toPandas()["col_name"].str.lower().to_string()
    monkeypatch.setattr(catalog, "BUCKET_BYTES", 1 << 14)
    cat.publish_table("dim")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {cat.qualified('dim__online_v2')}").collect()}
    assert 2 <= int(described["Num Buckets"]) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cat.read_online("dim").count() == 4000
