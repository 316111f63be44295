"""Rolling windows: frame edges, peers, NULLs, and both strategies against a brute-force loop."""

import math
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoleaf.operators.rolling import rolling_aggregate, rolling_count, rolling_sum

T0 = datetime(2024, 1, 10, 10, 0, 0)
STRATEGIES = ["events", "window"]
SCHEMA = "k long, ts timestamp, price double, flag boolean"


def _run(spark, rows, strategy, bucket=3600, secs=604800):
    # the uniform bucket width exercises the carry rows of split keys
    df = spark.createDataFrame(rows, SCHEMA)
    out = rolling_aggregate(df, ["k"], "ts", [
        rolling_sum("s", "price", secs),
        rolling_count("n", secs),
        rolling_count("nn", secs, value="price"),
    ], strategy=strategy, bucket_seconds=bucket)
    return sorted(out.collect(), key=lambda r: (r.k is None, r.k, r.ts is None, r.ts, r.price))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_frame_edge_inclusive(spark, strategy):
    rows = [(1, T0, 1.0, True), (1, T0 + timedelta(seconds=604800), 2.0, True),
            (1, T0 + timedelta(seconds=604801), 4.0, True)]
    out = _run(spark, rows, strategy)
    assert [r.n for r in out] == [1, 2, 2]
    assert [r.s for r in out] == [1.0, 3.0, 6.0]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_same_second_peers(spark, strategy):
    rows = [(1, T0 + timedelta(milliseconds=100), 1.0, True),
            (1, T0 + timedelta(milliseconds=900), 2.0, True)]
    out = _run(spark, rows, strategy)
    assert [r.n for r in out] == [2, 2]
    assert [r.s for r in out] == [3.0, 3.0]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_price_counts_in_divisor(spark, strategy):
    rows = [(1, T0, 10.0, True), (1, T0 + timedelta(seconds=1), None, True)]
    out = _run(spark, rows, strategy)
    last = out[-1]
    assert last.s == 10.0 and last.n == 2 and last.nn == 1
    assert last.s / last.n == 5.0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_all_null_sum_is_null(spark, strategy):
    rows = [(1, T0, 5.0, True), (1, T0 + timedelta(days=9), None, True)]
    out = _run(spark, rows, strategy)
    assert out[-1].s is None and out[-1].n == 1


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_ts_peers_only_of_each_other(spark, strategy):
    rows = [(1, None, 1.0, True), (1, None, 2.0, True), (1, T0, 4.0, True)]
    out = _run(spark, rows, strategy)
    by_ts = {(r.ts, r.price): r for r in out}
    assert by_ts[(None, 1.0)].n == 2 and by_ts[(None, 1.0)].s == 3.0
    assert by_ts[(T0, 4.0)].n == 1 and by_ts[(T0, 4.0)].s == 4.0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_key_is_one_group(spark, strategy):
    rows = [(None, T0, 1.0, True), (None, T0 + timedelta(seconds=5), 2.0, True), (2, T0, 8.0, True)]
    out = _run(spark, rows, strategy)
    nulls = [r for r in out if r.k is None]
    assert [r.n for r in nulls] == [1, 2]


def _brute(rows, secs):
    out = {}
    for i, (k, ts, price, _f) in enumerate(rows):
        win = [r for r in rows if r[0] == k and (
            (ts is None and r[1] is None) or
            (ts is not None and r[1] is not None and
             int(ts.timestamp()) - secs <= int(r[1].timestamp()) <= int(ts.timestamp())))]
        vals = [r[2] for r in win if r[2] is not None]
        out[i] = (round(sum(vals), 2) if vals else None, len(win))
    return out


row_strategy = st.tuples(
    st.sampled_from([1, 2, None]),
    st.one_of(st.none(), st.integers(0, 40).map(lambda h: T0 + timedelta(hours=h * 7, seconds=h))),
    st.one_of(st.none(), st.integers(0, 500).map(lambda c: c / 100)),
    st.booleans())


# (uniform bucket width, heavy-key threshold): uniform buckets for every key,
# data-driven split of keys above a tiny threshold, or one bucket per key
BUCKETINGS = [(600, None), (86400, None), (None, 3), (None, 1_000_000)]


@settings(max_examples=30, deadline=None)
@given(st.lists(row_strategy, min_size=1, max_size=30), st.sampled_from(BUCKETINGS))
def test_events_strategy_matches_brute_force(spark, rows, bucketing):
    secs = 2 * 86400
    bucket, target = bucketing
    rows = [(k, ts, p, f) for k, ts, p, f in rows]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i long, k long, ts timestamp, price double, flag boolean")
    out = rolling_aggregate(df, ["k"], "ts", [rolling_sum("s", "price", secs),
                                              rolling_count("n", secs)],
                            strategy="events", bucket_seconds=bucket,
                            target_rows=target or 1_000_000).collect()
    expect = _brute(rows, secs)
    for r in out:
        s, n = expect[r.i]
        assert r.n == n
        assert (r.s is None and s is None) or abs(r.s - s) < 1e-9


VALUES = [(1e-7, 1e-7), (2.004, 2.004), (1e13, 0.001), (1e25, -1e25, 3.0), (1 / 7, 1 / 7, -2 / 7), (0.1, 0.2),
          (float("nan"), 1.0), (float("inf"), 1.0), (float("inf"), float("-inf")), (float("-inf"), None), (1e-25, 2e-25)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_sums_round_nothing_away(spark, strategy):
    from fractions import Fraction
    rows = [(k, T0 + timedelta(seconds=i), v, True) for k, vs in enumerate(VALUES) for i, v in enumerate(vs)]
    out = {(r.k, r.ts): r.s for r in _run(spark, rows, strategy)}
    for k, vs in enumerate(VALUES):
        got = out[k, T0 + timedelta(seconds=len(vs) - 1)]
        known = [v for v in vs if v is not None]
        want = sum(known)
        if math.isnan(want) or math.isinf(want):
            assert str(got) == str(want)
        else:
            exact = float(sum(map(Fraction, known)))
            assert abs(got - exact) <= max(1e-15 * max(abs(v) for v in known), 1e-36)   # the finest place


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_special_values_leave_the_window(spark, strategy):
    day = 86400
    rows = [(1, T0, float("nan"), True), (1, T0 + timedelta(days=3), float("inf"), True), (1, T0 + timedelta(days=6), 0.3, True)]
    out = _run(spark, rows, strategy, secs=2 * day)
    assert math.isnan(out[0].s) and out[1].s == float("inf") and out[2].s == 0.3


HUGE = [[1e28, -1e28, 1e-30], [1e300, 1e-300, -1e300], [5e-324, 1.5e308], [1e-30, 2.5], [0.0, -0.0], [0.1] * 7]


@pytest.mark.parametrize("strategy, bucket, target", [("window", None, 9), ("events", 2, 9)])
def test_values_of_any_size_add_up(spark, strategy, bucket, target):
    """Sums of doubles of the whole range, also where one key's values lie far apart and another's do not."""
    from fractions import Fraction
    rows = [(k, T0 + timedelta(seconds=i), v, True) for k, vs in enumerate(HUGE) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = rolling_aggregate(df, ["k"], "ts", [rolling_sum("s", "price", 3600)], strategy=strategy,
                            bucket_seconds=bucket, target_rows=target).collect()
    assert len(out) == len(rows)
    for r in out:
        seen = HUGE[r.k][:int((r.ts - T0).total_seconds()) + 1]
        exact = float(sum(map(Fraction, seen)))
        assert abs(r.s - exact) <= 2.3e-16 * abs(exact), (seen, r.s, exact)


@pytest.mark.parametrize("kind, value", [("decimal(10,2)", "99999999.00"), ("double", "9e11"), ("double", "-9007199254740990"), ("double", "-0.07"), ("decimal(38,2)", "9" * 30 + ".25"),
                                         ("float", "3e38"), ("long", "4611686018427387")])
@pytest.mark.parametrize("bucket, target", [(None, 1_000_000), (3600, 1_000_000), (None, 50)])
def test_sums_of_split_keys_equal_the_plain_window(spark, kind, value, bucket, target):
    from pyspark.sql import Window
    df = (spark.range(400).selectExpr("1 AS k", "timestamp_seconds(1700000000 + id * 60) AS ts", f"CAST('{value}' AS {kind}) AS price"))
    out = rolling_aggregate(df, ["k"], "ts", [rolling_sum("s", "price", 86400 * 9)], bucket_seconds=bucket, target_rows=target)
    w = Window.partitionBy("k").orderBy(F.unix_seconds("ts")).rangeBetween(-86400 * 9, 0)
    plain = df.withColumn("s", F.sum("price").over(w))
    assert out.schema["s"].dataType == plain.schema["s"].dataType
    pairs = zip(out.orderBy("ts").collect(), plain.orderBy("ts").collect())
    if kind in ("double", "float"):
        assert all(a.s == pytest.approx(b.s, rel=1e-13) for a, b in pairs)
    else:
        assert all(a.s == b.s for a, b in pairs)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.one_of(
    st.none(), st.floats(-1e6, 1e6), st.tuples(st.floats(-1, 1), st.integers(-150, 150)).map(lambda p: math.ldexp(*p)))),
    min_size=1, max_size=30), st.sampled_from(BUCKETINGS))
def test_sums_over_all_magnitudes(spark, rows, bucketing):
    from fractions import Fraction
    df = spark.createDataFrame([(i, k, T0 + timedelta(hours=h), v) for i, (k, h, v) in enumerate(rows)],
                               "i long, k long, ts timestamp, price double")
    out = rolling_aggregate(df, ["k"], "ts", [rolling_sum("s", "price", 10 * 3600)],
                            bucket_seconds=bucketing[0], target_rows=bucketing[1] or 1_000_000).collect()
    assert len(out) == len(rows)
    for r in out:
        k, h, _ = rows[r.i]
        seen = [v for a, b, v in rows if a == k and h - 10 <= b <= h and v is not None]
        if not seen:
            assert r.s is None
        else:
            exact = float(sum(map(Fraction, seen)))
            assert abs(r.s - exact) <= 2.3e-16 * abs(exact)


@pytest.mark.parametrize("strategy, bucket, target", [("window", None, 9), ("events", None, 1_000_000), ("events", 3, 9), ("events", None, 2)])
def test_frames_without_the_row_itself(spark, strategy, bucket, target):
    """All earlier rows and the same-second peers, less the row; nothing left gives NULL sums and zero counts."""
    rows = [(1, T0, 1.5, True), (1, T0, 2.5, True), (1, T0 + timedelta(seconds=5), None, True),
            (1, T0 + timedelta(seconds=20), 8.25, True), (2, T0, 4.0, True), (3, None, 1.0, True), (3, None, 2.0, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + SCHEMA)
    out = rolling_aggregate(df, ["k"], "ts", [
        rolling_sum("s", "price", 10, exclude_current=True), rolling_sum("d", F.col("price").cast("decimal(5,2)"), 10, exclude_current=True),
        rolling_count("n", 10, exclude_current=True), rolling_count("nn", 10, value="price", exclude_current=True),
        rolling_sum("whole", "price", 10)], strategy=strategy, bucket_seconds=bucket, target_rows=target)
    got = {r.i: (r.s, None if r.d is None else float(r.d), r.n, r.nn, r.whole) for r in out.collect()}
    assert got == {0: (2.5, 2.5, 1, 1, 4.0), 1: (1.5, 1.5, 1, 1, 4.0), 2: (4.0, 4.0, 2, 2, 4.0), 3: (None, None, 0, 0, 8.25),
                   4: (None, None, 0, 0, 4.0), 5: (2.0, 2.0, 1, 1, 3.0), 6: (1.0, 1.0, 1, 1, 3.0)}


def test_a_rows_own_click_does_not_reach_its_features(spark):
    from chronoleaf.plans.features import destination_features
    log = spark.createDataFrame([(7, T0, True), (7, T0 + timedelta(hours=1), False), (8, T0, True)],
                                "destination_id int, ts timestamp, clicked boolean")
    out = destination_features(log, exclude_current=True).collect()
    got = {(r.destination_id, r.ts): (r.sum_clicks_7d, r.sum_impressions_7d) for r in out}
    assert got == {(7, T0): (None, 0), (7, T0 + timedelta(hours=1)): (1, 1), (8, T0): (None, 0)}
    flipped = destination_features(log.withColumn("clicked", ~F.col("clicked")), exclude_current=True).collect()
    assert {r.sum_clicks_7d for r in flipped if r.ts == T0} == {None}


def test_bucket_totals_carry_their_digits_up(spark):
    """Digits of a bucket's total stay small whatever the number of rows, so any number of buckets adds up."""
    from chronoleaf.operators.rolling import Limbs
    x = Limbs(-60, 3, odd=False, nulls=False)
    row = spark.sql("SELECT 8000000000000000000L AS a, -7000000000000000000L AS b, 3L AS c").select(
        *[c.alias(n) for c, n in zip(x.normal([F.col(c) for c in "abc"]), "abc")]).first()
    assert 0 <= row.a < 2 ** 30 and 0 <= row.b < 2 ** 34
    assert row.a + (row.b << 30) + (row.c << 60) == 8 * 10 ** 18 - (7 * 10 ** 18 << 30) + (3 << 60)


def test_keys_may_have_any_plain_name(spark):
    df = spark.createDataFrame([(1, 2, 3, T0, 1.5), (1, 2, 3, T0, 2.5)], "p int, at int, entry int, ts timestamp, price double")
    out = rolling_aggregate(df, ["p", "at", "entry"], "ts", [rolling_sum("s", "price", 10)])
    assert [r.s for r in out.collect()] == [4.0, 4.0]


def test_plan_has_no_python_and_one_main_window(spark):
    from chronoleaf.plans.features import user_features
    from chronoleaf.sources.roles import purchase_log
    plan = user_features(purchase_log(spark, "/root/testdata/sf0.001"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Generate explode" in plan
    # ordinary keys: one shuffle, one sort, one running window for all three features
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1
