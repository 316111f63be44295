"""Feature tables, merge log, publish, streaming ingest/publish, lifecycle (S4-S10, T-a..T-f)."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronoleaf.plans.catalog import FeatureCatalog
from chronoleaf.session import delete_path, path_exists, scratch_dir
from chronoleaf.sources import files
from chronoleaf.streaming.control import drain, to_parquet

T0 = datetime(2024, 1, 10, 10, 0, 0)


def _cat(spark):
    return FeatureCatalog(spark, database=f"t_{uuid.uuid4().hex[:8]}", root=scratch_dir(spark, "t"))


def test_create_table_keys_comment_and_duplicates(spark):
    cat = _cat(spark)
    df = spark.createDataFrame([(1, T0, 2.0), (2, T0, 3.0)], "user_id long, ts timestamp, f double")
    info = cat.create_table("uf", ["user_id"], "ts", df=df, description="User Features")
    assert info.primary_keys == ("user_id",) and info.timestamp_key == "ts"
    assert info.description == "User Features"
    assert sorted(r.f for r in cat.read_table("uf").collect()) == [2.0, 3.0]
    assert "_ingest_ts" not in cat.read_table("uf").columns
    dup = spark.createDataFrame([(1, T0, 2.0), (1, T0, 3.0)], "user_id long, ts timestamp, f double")
    with pytest.raises(ValueError, match="duplicate"):
        cat.create_table("bad", ["user_id"], "ts", df=dup)
    assert not cat.exists("bad")
    cat.create_table("dedup", ["user_id"], "ts", df=dup, on_duplicate="any")
    assert cat.read_table("dedup").count() == 1


def test_create_from_schema_is_empty(spark):
    cat = _cat(spark)
    cat.create_table("avail", ["destination_id", "booking_date"], ["event_ts"],
                     schema=files.AVAILABILITY_SCHEMA)
    t = cat.read_table("avail")
    assert t.count() == 0 and t.columns == files.AVAILABILITY_SCHEMA.fieldNames()


def test_batch_merge_upserts_and_compacts(spark):
    cat = _cat(spark)
    df = spark.createDataFrame([(1, T0, 1.0), (2, T0, 2.0)], "k long, ts timestamp, f double")
    cat.create_table("t", "k", "ts", df=df)
    cat.write_table("t", spark.createDataFrame([(1, T0, 10.0), (3, T0, 3.0)], "k long, ts timestamp, f double"))
    got = {r.k: r.f for r in cat.read_table("t").collect()}
    assert got == {1: 10.0, 2: 2.0, 3: 3.0}
    cat.compact("t")
    assert {r.k: r.f for r in cat.read_table("t").collect()} == got
    assert cat.spark.table(cat.qualified("t")).count() == 3


def test_publish_latest_per_key(spark):
    cat = _cat(spark)
    df = spark.createDataFrame([(1, T0, 1.0), (1, datetime(2024, 1, 11), 5.0), (2, T0, 2.0)],
                               "k long, ts timestamp, f double")
    cat.create_table("t", "k", "ts", df=df)
    cat.publish_table("t")
    assert {r.k: r.f for r in cat.read_online("t").collect()} == {1: 5.0, 2: 2.0}


def _write_json(spark, rows, path):
    df = spark.createDataFrame(rows, files.AVAILABILITY_SCHEMA)
    files.write_json(df.coalesce(1), path, mode="append")


def test_stream_merge_late_file_and_resume(spark):
    """Late (older event_ts) file: history gains a row, the snapshot keeps the newer value;
    a restart on the same checkpoint reads nothing twice."""
    cat = _cat(spark)
    base = scratch_dir(spark, "stream-test")
    cat.create_table("avail", ["destination_id", "booking_date"], ["event_ts"],
                     schema=files.AVAILABILITY_SCHEMA)
    d = date(2024, 1, 20)
    _write_json(spark, [(datetime(2024, 1, 10, 12), 1, "N1", d, 10.0, 5)], f"{base}/src")
    src = lambda: files.availability_features(
        files.json_stream(spark, f"{base}/src/*.json", max_files_per_trigger=1))
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    _write_json(spark, [(datetime(2024, 1, 9, 12), 1, "N1", d, 9.0, 7)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))  # nothing new
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    assert cat.read_table("avail").count() == 2
    snap = cat.read_online("avail").collect()
    assert len(snap) == 1 and snap[0].availability == 5
    # rewrite of the same (key, time): the later write wins in history and snapshot
    _write_json(spark, [(datetime(2024, 1, 10, 12), 1, "N1", d, 11.0, 6)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    assert cat.read_table("avail").count() == 2
    assert cat.read_online("avail").first().availability == 6
    with pytest.raises(ValueError):
        cat.write_table("avail", spark.createDataFrame([], files.AVAILABILITY_SCHEMA))


def test_json_round_trip_keeps_microseconds(spark):
    base = scratch_dir(spark, "json-us")
    ts = datetime(2024, 1, 10, 12, 0, 0, 123456)
    _write_json(spark, [(ts, 1, "N1", date(2024, 1, 10), 1.0, 1)], base)
    q = to_parquet(files.json_stream(spark, f"{base}/*.json"), f"{base}-sink", f"{base}-ck")
    drain(q)
    got = spark.read.parquet(f"{base}-sink").select(F.col("event_ts").cast("timestamp_ntz")).first()[0]
    assert got == ts


def test_drain_continuous_trigger(spark):
    base = scratch_dir(spark, "drain")
    for i in range(3):
        _write_json(spark, [(datetime(2024, 1, 10, i), i, "N", date(2024, 1, 10), 1.0, i)], f"{base}/src")
    q = to_parquet(files.json_stream(spark, f"{base}/src/*.json", max_files_per_trigger=1),
                   f"{base}/sink", f"{base}/ck", trigger={"processingTime": "100 milliseconds"})
    drain(q)
    assert not q.isActive
    assert spark.read.parquet(f"{base}/sink").count() == 3


def test_lifecycle(spark):
    cat = _cat(spark)
    cat.create_table("t", "k", df=spark.createDataFrame([(1, 1.0)], "k long, f double"))
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY|not empty|NonEmpty"):
        cat.drop_database()
    loc = cat.location("t")
    assert path_exists(spark, loc)
    cat.drop_table("t")
    assert not cat.exists("t") and not path_exists(spark, loc)
    cat.drop_database()
    ck = scratch_dir(spark, "ck-delete")
    spark.range(3).write.parquet(ck)
    assert delete_path(spark, ck) and not path_exists(spark, ck)


def test_compact_online_folds_log_and_skips_old_files(spark):
    cat = _cat(spark)
    base = scratch_dir(spark, "compact-online")
    cat.create_table("avail", ["destination_id", "booking_date"], ["event_ts"],
                     schema=files.AVAILABILITY_SCHEMA)
    d = date(2024, 1, 20)
    src = lambda: files.availability_features(files.json_stream(spark, f"{base}/src/*.json"))
    _write_json(spark, [(datetime(2024, 1, 10, 12), 1, "N1", d, 10.0, 5),
                        (datetime(2024, 1, 10, 12), 2, "N2", d, 20.0, 8)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    cat.compact_online("avail")
    assert {r.destination_id: r.availability for r in cat.read_online("avail").collect()} == {1: 5, 2: 8}
    # newer value for key 1, a late (older) one for key 2, then a second compaction
    _write_json(spark, [(datetime(2024, 1, 11, 12), 1, "N1", d, 11.0, 6),
                        (datetime(2024, 1, 9, 12), 2, "N2", d, 19.0, 1)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    assert {r.destination_id: r.availability for r in cat.read_online("avail").collect()} == {1: 6, 2: 8}
    cat.compact_online("avail")
    view = cat.read_online("avail")
    assert {r.destination_id: r.availability for r in view.collect()} == {1: 6, 2: 8}
    plan = view._jdf.queryExecution().executedPlan().toString()
    # nothing published since the compaction: only the snapshot is scanned
    assert plan.count("FileScan") == 1 and "LeftAnti" not in plan


@pytest.mark.parametrize("per_trigger", [1, 3])
def test_stream_equals_batch_for_any_file_split(spark, per_trigger):
    base = scratch_dir(spark, "split")
    rows = [(datetime(2024, 1, 10, h), h % 3, f"N{h % 3}", date(2024, 1, 10 + h % 2), float(h), h)
            for h in range(12)]
    for i in range(0, 12, 2):
        _write_json(spark, rows[i:i + 2], f"{base}/src")
    q = to_parquet(files.json_stream(spark, f"{base}/src/*.json", max_files_per_trigger=per_trigger),
                   f"{base}/sink", f"{base}/ck")
    drain(q)
    streamed = spark.read.parquet(f"{base}/sink")
    batch = spark.read.schema(files.AVAILABILITY_SCHEMA).option(
        "timestampFormat", files.MICROS_TS_FORMAT).json(f"{base}/src/*.json")
    assert streamed.count() == 12
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_lookup_without_label_time_uses_latest_row(spark):
    from chronoleaf.plans.training import Lookup, create_training_set
    cat = _cat(spark)
    feats = spark.createDataFrame([(1, T0, 1.0), (1, datetime(2024, 1, 12), 2.0), (2, T0, 5.0)],
                                  "k long, ts timestamp, f double")
    cat.create_table("t", "k", "ts", df=feats)
    labels = spark.createDataFrame([(10, 1, True), (11, 2, False), (12, 3, True)],
                                   "id long, k long, y boolean")
    ts = create_training_set(cat, labels, [Lookup("t", "k")], exclude_columns=["k"], label="y")
    out = {r.id: r.f for r in ts.load_df().collect()}
    assert out == {10: 2.0, 11: 5.0, 12: None}
    assert ts.load_df().columns == ["id", "f", "y"]
    with pytest.raises(ValueError):
        create_training_set(cat, labels, [], label="missing")


def test_bucketed_snapshot_join_shuffles_only_requests(spark):
    from chronoleaf.operators.lookup import online_lookup
    cat = _cat(spark)
    feats = spark.range(200).select((F.col("id") % 50).alias("k"),
                                    F.timestamp_seconds(F.col("id") * 60).alias("ts"),
                                    F.col("id").cast("double").alias("f"))
    cat.create_table("t", "k", "ts", df=feats)
    cat.publish_table("t", buckets=4)
    reqs = spark.range(1000).select((F.col("id") % 60).alias("k"))
    # a snapshot too large to broadcast: force the sort-merge path
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = online_lookup(reqs, cat.read_online("t"), "k", "k", ["f"], broadcast=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan, plan
    assert plan.count("Exchange hashpartitioning") == 1, plan   # requests only
    got = {r.k: r.f for r in out.distinct().collect()}
    assert got[7] == 157.0 and got[55] is None and len(got) == 60


def test_published_dimension_writes_one_file_per_bucket(spark):
    import os
    cat = _cat(spark)
    df = spark.range(0, 5000, 1, 6).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    cat.create_table("dim", "k", df=df)
    cat.publish_table("dim", buckets=8)
    loc = cat.location("dim__online_v1").replace("file:", "")
    assert len([f for f in os.listdir(loc) if f.endswith(".parquet")]) == 8
    assert cat.read_online("dim").exceptAll(df).count() == 0


def test_compact_stream_table_and_fold_reads(spark):
    """Compaction of a stream-written feature table: reads before and after agree,
    and later writes fold in through a broadcast of the touched keys only."""
    cat = _cat(spark)
    base = scratch_dir(spark, "compact-stream")
    cat.create_table("avail", ["destination_id", "booking_date"], ["event_ts"],
                     schema=files.AVAILABILITY_SCHEMA)
    d = date(2024, 1, 20)
    src = lambda: files.availability_features(files.json_stream(spark, f"{base}/src/*.json"))
    rows = [(datetime(2024, 1, 10, h), h % 4, f"N{h % 4}", d, float(h), h) for h in range(12)]
    _write_json(spark, rows, f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    before = cat.read_table("avail")
    want = {(r.destination_id, r.event_ts): r.availability for r in before.collect()}
    cat.compact("avail")
    after = cat.read_table("avail")
    assert after.columns == before.columns
    assert {(r.destination_id, r.event_ts): r.availability for r in after.collect()} == want
    # rewrite one (key, time) and add a new one after the compaction
    _write_json(spark, [(datetime(2024, 1, 10, 3), 3, "N3", d, 3.0, 300),
                        (datetime(2024, 1, 10, 20), 0, "N0", d, 20.0, 20)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    want[(3, datetime(2024, 1, 10, 3))] = 300
    want[(0, datetime(2024, 1, 10, 20))] = 20
    view = cat.read_table("avail")
    assert {(r.destination_id, r.event_ts): r.availability for r in view.collect()} == want
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    log_files = {f for f in cat._raw("avail").inputFiles()}
    read = {f for f in view.inputFiles() if "__snap" not in f}
    assert read and read < log_files             # folded log files are not read again
    cat.compact("avail")
    assert {(r.destination_id, r.event_ts): r.availability
            for r in cat.read_table("avail").collect()} == want


def test_republish_keeps_readers_and_drops_old_versions(spark):
    cat = _cat(spark)
    cat.create_table("t", "k", df=spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("f")))
    cat.publish_table("t", buckets=2)
    held = cat.read_online("t")
    for f in (2, 3):
        cat.write_table("t", spark.range(100).select(F.col("id").alias("k"), F.lit(f).alias("f")))
        cat.publish_table("t", buckets=2)
        assert {r.f for r in cat.read_online("t").collect()} == {f}
    assert {r.f for r in held.collect()} == {1}            # opened two publishes ago
    cat.publish_table("t", buckets=2)
    assert not cat.exists("t__online_v1") and cat.exists("t__online_v2")
    cat.drop_table("t")
    assert not any(cat.exists(f"t__online_v{v}") for v in range(1, 6))


def test_create_table_latest_keeps_one_row_of_each_key(spark):
    cat = _cat(spark)
    df = spark.createDataFrame([(1, T0, 1.0, {"a": 1}), (1, T0, 3.0, {"a": 2}), (2, T0, 2.0, None)],
                               "k long, ts timestamp, f double, m map<string,int>")
    cat.create_table("t", "k", "ts", df=df, on_duplicate="latest")
    assert sorted((r.k, r.f, r.m) for r in cat.read_table("t").collect()) == [(1, 3.0, {"a": 2}), (2, 2.0, None)]


def test_compaction_reads_rows_of_a_clock_that_is_behind(spark):
    """A batch committed after the compaction counts although its rows are stamped before those folded."""
    cat = _cat(spark)
    base = scratch_dir(spark, "clock")
    cat.create_table("avail", ["destination_id", "booking_date"], ["event_ts"], schema=files.AVAILABILITY_SCHEMA)
    d = date(2024, 1, 20)
    src = lambda: files.availability_features(files.json_stream(spark, f"{base}/src/*.json"))
    _write_json(spark, [(datetime(2024, 1, 10, 1), 1, "N1", d, 1.0, 1)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    cat.compact("avail")
    cat.compact_online("avail")
    held = cat.read_table("avail")
    # the same stream, restarted on a driver whose clock is an hour behind
    _write_json(spark, [(datetime(2024, 1, 10, 2), 2, "N2", d, 2.0, 2)], f"{base}/src")
    hour_ago = F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    drain(src().withColumn("_ingest_ts", hour_ago).writeStream.format("parquet").outputMode("append")
          .option("checkpointLocation", f"{base}/ck").option("path", cat.location("avail"))
          .trigger(availableNow=True).start())
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    for read in (cat.read_table, cat.read_online, cat.snapshot):
        assert {r.destination_id for r in read("avail").collect()} == {1, 2}
    cat.compact("avail")
    cat.compact_online("avail")
    # folded log files can go; views opened before the last compaction still finish
    assert cat.remove_folded("avail") >= 2 and cat.remove_folded("avail", online=True) >= 2
    for read in (cat.read_table, cat.read_online, cat.snapshot):
        assert {r.destination_id for r in read("avail").collect()} == {1, 2}
    assert {r.destination_id for r in held.collect()} == {1}
    # and the stream goes on after that
    _write_json(spark, [(datetime(2024, 1, 10, 3), 3, "N3", d, 3.0, 3)], f"{base}/src")
    drain(cat.write_table("avail", src(), checkpoint_location=f"{base}/ck"))
    drain(cat.publish_table("avail", streaming=True, checkpoint_location=f"{base}/online"))
    for read in (cat.read_table, cat.read_online, cat.snapshot):
        assert {r.destination_id for r in read("avail").collect()} == {1, 2, 3}


def test_a_drain_of_an_endless_source_ends(spark, tmp_path):
    import time
    q = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load().writeStream.format("noop")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    t0 = time.monotonic()
    with pytest.raises(TimeoutError):
        drain(q, 3)
    assert time.monotonic() - t0 < 20 and not q.isActive


def test_csv_with_a_declared_schema_keeps_malformed_lines(spark, tmp_path):
    from chronoleaf.sources.files import LOCATION_SCHEMA, count_malformed, read_csv_checked
    (tmp_path / "a.csv").write_text("destination_id,name,price,latitude,longitude\n1,Rome,10,41.9,12.5\n2,Oslo,cheap,59.9,10.7\n"
                                    "x,Bonn,7,50.7,7.1\n3,,,,\n")
    df = read_csv_checked(spark, str(tmp_path), LOCATION_SCHEMA)
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted([(1, "Rome", 10, 41.9, 12.5, None), (2, "Oslo", None, 59.9, 10.7, "2,Oslo,cheap,59.9,10.7"),
                          (None, "Bonn", 7, 50.7, 7.1, "x,Bonn,7,50.7,7.1"), (3, None, None, None, None, None)], key=str)
    assert count_malformed(df) == (2, 2)
    with pytest.raises(ValueError):
        read_csv_checked(spark, str(tmp_path), LOCATION_SCHEMA, malformed="name")
