"""As-of lookup: exact hits, misses, NULL rows, composite keys, and a brute-force property test."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from chronoleaf.operators.asof import AsOf, asof_join, asof_lookups

T0 = datetime(2024, 1, 10, 10, 0, 0)
STRATEGIES = ["buckets", "window"]


def _labels(spark, rows):
    return spark.createDataFrame(rows, "id long, k long, ts timestamp")


def _feats(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp, f double, g double")


def _by_id(df):
    return {r.id: r for r in df.collect()}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_exact_hit_miss_and_null_newest(spark, strategy):
    labels = _labels(spark, [(1, 1, T0), (2, 1, T0 - timedelta(days=1)), (3, 1, T0 + timedelta(hours=5)),
                             (4, None, T0), (5, 1, None)])
    feats = _feats(spark, [(1, T0, 1.0, 10.0), (1, T0 + timedelta(hours=2), None, 20.0),
                           (None, T0, 99.0, 99.0), (1, None, 98.0, 98.0)])
    out = _by_id(asof_join(labels, feats, "k", "k", "ts", "ts", strategy=strategy))
    assert len(out) == 5
    assert (out[1].f, out[1].g) == (1.0, 10.0)          # exact time: inclusive
    assert (out[2].f, out[2].g) == (None, None)         # before the first feature row
    assert (out[3].f, out[3].g) == (None, 20.0)         # newest row's NULL stays NULL
    assert (out[4].f, out[4].g) == (None, None)         # NULL key never matches
    assert (out[5].f, out[5].g) == (None, None)         # NULL label time


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_composite_key_and_differing_time_names(spark, strategy):
    labels = spark.createDataFrame([(1, 1, "a", T0), (2, 1, "b", T0), (3, 2, "a", T0)],
                                   "id long, k long, d string, ts timestamp")
    feats = spark.createDataFrame([(1, "a", T0 - timedelta(days=3), 5), (1, "b", T0 + timedelta(seconds=1), 6),
                                   (2, "a", T0 - timedelta(days=40), 7)],
                                  "k long, d string, event_ts timestamp, availability int")
    out = _by_id(asof_join(labels, feats, ["k", "d"], ["k", "d"], "ts", "event_ts", ["availability"],
                           strategy=strategy, bucket_seconds=3600))
    assert out[1].availability == 5
    assert out[2].availability is None
    assert out[3].availability == 7


def test_collision_needs_rename(spark):
    labels = spark.createDataFrame([(1, 1, T0, 3.0)], "id long, k long, ts timestamp, f double")
    feats = _feats(spark, [(1, T0, 1.0, 10.0)])
    with pytest.raises(ValueError):
        asof_join(labels, feats, "k", "k", "ts", "ts", ["f"])
    out = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], rename={"f": "f_feat"}).first()
    assert out.f == 3.0 and out.f_feat == 1.0


@settings(max_examples=25, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 200)), min_size=0, max_size=25,
             unique=True),
    st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(0, 200)), min_size=1, max_size=25),
    st.sampled_from([(60, None), (86400, None), (None, 2), (None, 1_000_000)]),
)
def test_buckets_match_brute_force(spark, feat_rows, label_rows, bucketing):
    bucket, target = bucketing
    feats = [(k, T0 + timedelta(minutes=17 * m), float(m), None) for k, m in feat_rows]
    labels = [(i, k, T0 + timedelta(minutes=17 * m, seconds=i % 3)) for i, (k, m) in enumerate(label_rows)]
    out = _by_id(asof_join(_labels(spark, labels), spark.createDataFrame(
        feats, "k long, ts timestamp, f double, g double") if feats else _feats(spark, []),
        "k", "k", "ts", "ts", ["f"], bucket_seconds=bucket, target_rows=target or 1_000_000))
    for i, k, ts in labels:
        cands = [f for f in feats if f[0] == k and f[1] <= ts]
        want = max(cands, key=lambda f: f[1])[2] if cands else None
        assert out[i].f == want


def test_label_key_types_are_kept(spark):
    labels = spark.createDataFrame([(1, 1, T0)], "id long, k int, ts timestamp")
    feats = _feats(spark, [(1, T0, 1.0, 2.0)])  # k is long here
    out = asof_join(labels, feats, "k", "k", "ts", "ts", ["f"])
    assert dict(out.dtypes)["k"] == "int" and out.first().f == 1.0


@pytest.mark.parametrize("strategy,bucket", [("window", None), ("buckets", None), ("buckets", 60)])
def test_feature_rows_tied_on_time_resolve_deterministically(spark, strategy, bucket):
    # two feature rows share (key, time): the greatest payload wins, whatever the
    # arrival order; also across a bucket boundary (carry rows)
    t = T0 - timedelta(minutes=3)
    labels = _labels(spark, [(1, 1, T0), (2, 1, t)])
    for order in ([(1, t, 1.0, 9.0), (1, t, 2.0, 0.0)], [(1, t, 2.0, 0.0), (1, t, 1.0, 9.0)]):
        feats = _feats(spark, order).repartition(3)
        got = _by_id(asof_join(labels, feats, "k", "k", "ts", "ts", ["f", "g"], strategy=strategy,
                               bucket_seconds=bucket))
        assert (got[1].f, got[1].g) == (2.0, 0.0) and (got[2].f, got[2].g) == (2.0, 0.0)


@pytest.mark.parametrize("bucket", [None, 60])
def test_never_matching_labels_spread_and_stay_null(spark, bucket):
    # 300 label rows of key 1 without a time (plus NULL-key rows) cannot match:
    # they are spread over hash groups and keep NULL features; timed rows still match
    rows = [(i, 1, None) for i in range(300)] + [(1000 + i, None, T0) for i in range(50)] + \
        [(2000, 1, T0), (2001, 1, T0 - timedelta(days=2))]
    labels = _labels(spark, rows)
    feats = _feats(spark, [(1, T0 - timedelta(days=1), 5.0, 6.0), (None, T0, 7.0, 8.0)])
    got = _by_id(asof_join(labels, feats, "k", "k", "ts", "ts", ["f"], bucket_seconds=bucket))
    assert len(got) == len(rows)
    assert all(got[i].f is None for i in range(300)) and all(got[1000 + i].f is None for i in range(50))
    assert got[2000].f == 5.0 and got[2001].f is None


def test_keys_meet_in_their_wider_type(spark):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, t), (None, t)], "k int, ts timestamp")
    right = spark.createDataFrame([(2 ** 33, t, 5.0), (2 ** 32 + 1, t, 6.0), (1, t, 7.0)], "k long, ts timestamp, f double")
    out = asof_join(left, right, "k", "k", "ts", "ts", ["f"])
    assert out.schema["k"].dataType.simpleString() == "int"
    assert {(r.k, r.f) for r in out.collect()} == {(1, 7.0), (None, None)}
    days = left.selectExpr("DATE'2024-01-01' AS k", "ts").limit(1)
    times = spark.createDataFrame([(datetime(2024, 1, 1, 5), t, 1.0)], "k timestamp, ts timestamp, f double")
    assert asof_join(days, times, "k", "k", "ts", "ts", ["f"]).first().f is None


def _several(spark):
    labels = spark.createDataFrame(
        [(i, None if i % 17 == 0 else i % 3, None if i % 13 == 0 else "ab"[i % 2],
          None if i % 19 == 0 else T0 + timedelta(minutes=11 * i)) for i in range(120)],
        "id long, k int, d string, ts timestamp")
    one = spark.createDataFrame([(i % 4, T0 + timedelta(minutes=37 * (i // 2)), float(i), None if i % 5 else i)
                                 for i in range(60)], "k long, ts timestamp, f double, g long")
    two = spark.createDataFrame([(i % 3, T0 + timedelta(minutes=29 * i), f"x{i}") for i in range(50)],
                                "kk long, at timestamp, h string")
    deep = spark.createDataFrame([(i % 3, "ab"[i % 2] if i % 7 else None, T0 + timedelta(minutes=41 * i), i)
                                  for i in range(50)], "k long, d string, ts timestamp, n int")
    apart = spark.createDataFrame([("ab"[i % 2], T0 + timedelta(minutes=53 * i), i) for i in range(20)],
                                  "d string, ts timestamp, m int")
    return labels, [AsOf(one, "k", "k", "ts", "ts"), AsOf(deep, ["k", "d"], ["k", "d"], "ts", "ts", rename={"n": "left"}),
                    AsOf(apart, "d", "d", "ts", "ts"), AsOf(two, "k", "kk", "ts", "at", ["h"])]


@pytest.mark.parametrize("how", [{}, {"bucket_seconds": 3600}, {"target_rows": 5}, {"strategy": "window"}])
def test_several_lookups_in_one_pass_equal_one_after_another(spark, how):
    labels, lookups = _several(spark)
    want = labels
    for lk in lookups:
        want = asof_join(want, lk.right, lk.left_keys, lk.right_keys, lk.left_ts, lk.right_ts, lk.features,
                         rename=lk.rename, strategy="window")
    got = asof_lookups(labels, lookups, **how)
    assert got.columns == ["id", "k", "d", "ts", "f", "g", "left", "m", "h"] and got.dtypes == want.dtypes
    rows = sorted(got.collect())
    assert rows == sorted(want.collect()) and len(rows) == 120
    assert sum(r.left is not None for r in rows) > 20 and sum(r.h is not None for r in rows) > 50


def test_one_exchange_for_each_leading_key(spark):
    labels, lookups = _several(spark)
    plan = asof_lookups(labels, lookups)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2            # k and d
    assert plan.count("- Window [") == 3                           # k, (k, d) and d


def test_lookups_whose_keys_part_after_the_first(spark):
    labels, lookups = _several(spark)
    other = lookups[1].right.withColumnRenamed("n", "z").withColumnRenamed("d", "id").withColumn("id", F.lit(5))
    both = [lookups[1], AsOf(other, ["k", "id"], ["k", "id"], "ts", "ts")]
    got = asof_lookups(labels, both)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = asof_lookups(asof_lookups(labels, both[:1]), both[1:])
    assert sorted(got.collect()) == sorted(want.collect())


def test_wide_label_keys_keep_their_value(spark):
    labels = spark.createDataFrame([(2 ** 53 + 1, T0)], "k long, ts timestamp")
    feats = spark.createDataFrame([(float(2 ** 53), T0, 1)], "k double, ts timestamp, f int")
    assert asof_join(labels, feats, "k", "k", "ts", "ts").first().k == 2 ** 53 + 1
