"""Scalars, flags, thresholds, splits, distance, medians and accuracy."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronoleaf.functions import day_of_week, day_stamp, epoch_seconds, flag01, threshold
from chronoleaf.functions.geo import geodesic_miles, haversine_miles, with_distance
from chronoleaf.functions.strings import clean_user_name
from chronoleaf.operators.split import hash_split, time_split
from chronoleaf.operators.stats import accuracy, duplicate_keys, exact_medians, fill_median, key_value, ordered_key
from chronoleaf.session import materialize
from chronoleaf.plans.ondemand import add_distance


def test_flag_null_is_zero(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "f boolean")
    assert [r[0] for r in df.select(flag01("f")).collect()] == [0, 1, 0]


def test_threshold_edges(spark):
    df = spark.createDataFrame([(0.2,), (0.1999,), (None,)], "p double")
    assert [r[0] for r in df.select(threshold("p", 0.2)).collect()] == [True, False, False]


def test_time_scalars(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 3, 30, 0, 900000),)], "ts timestamp_ntz")
    r = df.select(day_of_week("ts").alias("d"), epoch_seconds("ts").alias("e"),
                  day_stamp("ts").alias("s")).first()
    assert r.d == 1  # Sunday
    assert r.e == 1704598200
    assert r.s == "20240106"  # 03:30 UTC is the previous day at UTC-5


def test_clean_user_name(spark):
    df = spark.createDataFrame([("First.Last@Example.com",)], "n string")
    assert df.select(clean_user_name("n")).first()[0] == "first_last"


def test_time_split_pushes_down_and_drops_null(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)), (3, None)],
                               "id long, ts timestamp_ntz")
    before, after = time_split(df, "ts", "2024-01-23")
    assert [r.id for r in before.collect()] == [1]
    assert [r.id for r in after.collect()] == [2]
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = time_split(log, "ts", "2024-01-23")[0]._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts" in plan


def test_hash_split_is_stable_and_disjoint(spark):
    df = spark.range(2000).withColumnRenamed("id", "event_id")
    a, b = hash_split(df, "event_id")
    a2, _ = hash_split(df.repartition(7), "event_id")
    ids_a = {r[0] for r in a.collect()}
    assert ids_a == {r[0] for r in a2.collect()}
    assert not ids_a & {r[0] for r in b.collect()}
    assert 0.7 < len(ids_a) / 2000 < 0.8


def test_distance_edges(spark):
    df = spark.createDataFrame([(40.0, -74.0, 40.0, -74.0), (0.0, 0.0, 0.0, 179.9),
                                (40.71277, -74.005974, 37.77493, -122.41942),
                                (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    rows = df.select(geodesic_miles("a", "b", "c", "d").alias("g"),
                     haversine_miles("a", "b", "c", "d").alias("h")).collect()
    assert rows[0].g == 0.0
    assert rows[1].g is not None and 12000 < rows[1].g < 12500
    # New York - San Francisco: ~2,571 miles on the ellipsoid
    assert abs(rows[2].g - 2571.0) < 5.0 and abs(rows[2].h - rows[2].g) / rows[2].g < 0.006
    assert rows[3].g is None


# published solutions of the inverse problem on WGS-84 (degrees, metres), antipodal and nearly antipodal ones included
GEODESICS = [((0, 0, 0, 180), 20003931.4586), ((30, 0, -30, 180), 20003931.4586), ((90, 0, -90, 0), 20003931.4586),
             ((0, 0, .5, 179.5), 19936288.579), ((0, 0, .5, 179.7), 19944127.421), ((0, 0, 0, 1), 111319.491),
             ((-41.32, 174.81, 40.96, -5.5), 19959679.267), ((40.6, -73.8, 51.6, -.5), 5551759.4),
             ((-37.95103342, 144.42486789, -37.65282114, 143.92649554), 54972.271), ((10, 20, 10, 380), 0), ((0, 5, 0, 5), 0)]


def test_geodesic_gives_published_lengths(spark):
    df = spark.createDataFrame([(*map(float, p), float(m)) for p, m in GEODESICS], "a double, b double, c double, d double, m double")
    out = with_distance(df, "a", "b", "c", "d", "far").withColumn("one", geodesic_miles("a", "b", "c", "d")).collect()
    for r in out:
        assert r.far * 1609.344 == pytest.approx(r.m, rel=1e-9, abs=1e-3), r
        assert r.one * 1609.344 == pytest.approx(r.m, rel=1e-9, abs=1e-3), r


def test_geodesic_is_symmetric_and_keeps_to_the_triangle(spark):
    """Random pairs, most of them nearly antipodal: both directions agree, and so do the two forms; a way over a third
    point is never shorter."""
    import random
    rng = random.Random(5)
    pts = []
    for _ in range(300):
        a, b = rng.uniform(-90, 90), rng.uniform(-180, 180)
        pts.append((a, b, max(-90.0, min(90.0, -a + rng.uniform(-1, 1))), b + 180 + rng.uniform(-1, 1), rng.uniform(-90, 90), rng.uniform(-180, 180)))
    df = spark.createDataFrame(pts, "a double, b double, c double, d double, e double, f double")
    for out, ends in (("ac", "abcd"), ("ca", "cdab"), ("ae", "abef"), ("ec", "efcd")):
        df = with_distance(df, *ends, out)
    for r in df.withColumn("one", geodesic_miles("a", "b", "c", "d")).collect():
        assert r.ac == pytest.approx(r.ca, rel=1e-10) == pytest.approx(r.one, rel=1e-10)
        assert r.ac <= (r.ae + r.ec) * (1 + 1e-10)


def test_a_filter_on_the_distance_stops_at_it(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 9.0)], "a double, b double, c double, d double")
    near = with_distance(df, "a", "b", "c", "d").where("distance < 100")
    assert near.count() == 1
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rint(") <= 4


def test_geodesic_close_to_vincenty(spark):
    import random
    random.seed(3)
    pts = [(random.uniform(-60, 70), random.uniform(-180, 180), random.uniform(-60, 70),
            random.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geodesic_miles("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(pts, got):
        v = _vincenty_miles(a, b, c, d)
        if v is None or v > 11000:
            continue
        assert abs(g - v) / max(v, 1e-9) < 1e-9


def _vincenty_miles(lat1, lon1, lat2, lon2):
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    L = math.radians(lon2 - lon1)
    U1, U2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(cosU2 * sl, cosU1 * sinU2 - sinU1 * cosU2 * cl)
        if ss == 0:
            return 0.0
        cs = sinU1 * sinU2 + cosU1 * cosU2 * cl
        sig = math.atan2(ss, cs)
        sa = cosU1 * cosU2 * sl / ss
        c2a = 1 - sa * sa
        c2sm = cs - 2 * sinU1 * sinU2 / c2a if c2a else 0.0
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev = lam
        lam = L + (1 - C) * f * sa * (sig + C * ss * (c2sm + C * cs * (-1 + 2 * c2sm * c2sm)))
        if abs(lam - prev) < 1e-12:
            break
    else:
        return None
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * ss * (c2sm + B / 4 * (cs * (-1 + 2 * c2sm * c2sm) - B / 6 * c2sm * (-3 + 4 * ss * ss) * (-3 + 4 * c2sm * c2sm)))
    return b * A * (sig - ds) / 1609.344


def test_median_skips_null_and_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,), (4.0,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 3.0}


@pytest.mark.parametrize("n", [999, 1000, 4001])
def test_median_narrowing_equals_spark_median(spark, n):
    df = spark.range(n).select((((F.col("id") * 7919) % 1009) / 7.0).alias("x"))
    want = df.agg(F.median("x")).first()[0]
    got = exact_medians(df, ["x"], local_limit=50)["x"]
    assert got == pytest.approx(want, abs=1e-12)


def test_median_narrowing_with_heavy_duplicates(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0))
                                  .otherwise(F.col("id").cast("double")).alias("x"))
    want = df.agg(F.median("x")).first()[0]
    assert exact_medians(df, ["x"], local_limit=20)["x"] == pytest.approx(want)


def test_ordered_keys_keep_the_order_and_every_bit(spark):
    import struct
    values = sorted({0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1.0, -1.0, 2.0,
                     1.9999999999999998, 0.9999999999999999, 8.0, 7.999999999999999, 1000.0, 1024.0, 0.1, -0.1, 3e-310, float("inf"),
                     float("-inf"), *[math.ldexp(1.0, e) for e in range(-1074, 1024, 7)], *[math.nextafter(2.0 ** e, 0) for e in range(-1000, 1000, 9)]})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    keys = [r.k for r in df.select("i", ordered_key(F.col("v")).alias("k")).orderBy("i").collect()]
    assert keys == sorted(set(keys))
    assert [key_value(k) for k in keys] == values
    assert keys[values.index(1.0)] == struct.unpack("<q", struct.pack("<d", 1.0))[0]
    odd = spark.createDataFrame([(-0.0,), (float("nan"),), (None,)], "v double").select(ordered_key(F.col("v")).alias("k")).collect()
    assert [r.k for r in odd] == [0, 2 ** 63 - 1, None]


def test_medians_of_all_columns_in_four_passes(spark, monkeypatch):
    import random
    from chronoleaf.operators import stats
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1) * 10 ** rng.randrange(-300, 300), float(rng.randrange(3)), rng.choice([None, -1.5, 2.5]), None,
             rng.choice([float("inf"), -1.0])) for _ in range(301)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    cols = list("abcde")
    want = df.agg(*[F.median(c).alias(c) for c in cols]).first().asDict()
    written = []
    monkeypatch.setattr(stats, "materialize", lambda d, name: written.append(name) or materialize(d, name))
    assert exact_medians(df, cols, local_limit=10) == want
    assert exact_medians(df.limit(300), cols[:3], local_limit=10) == df.limit(300).agg(*[F.median(c).alias(c) for c in cols[:3]]).first().asDict()
    assert written == ["median-keys"] * 2


def test_distance_fills_null_coordinates_with_medians(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0), (None, 3.0, 1.0, 1.0), (5.0, 5.0, 1.0, 1.0)],
                               "user_latitude double, user_longitude double, latitude double, longitude double")
    out = add_distance(df).collect()
    assert out[1].user_latitude is None          # the column itself is not filled
    assert out[1].distance is not None and out[0].distance == 0.0


def test_fill_median_and_accuracy(spark):
    df = spark.createDataFrame([(1.0, True, True), (None, False, True), (3.0, True, None)],
                               "x double, y boolean, p boolean")
    assert [r.x for r in fill_median(df, ["x"]).collect()] == [1.0, 2.0, 3.0]
    assert accuracy(df, "y", "p").first().accuracy == pytest.approx(1 / 3)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, d string")
    assert [(r.k, r.n) for r in duplicate_keys(df, ["k", "d"]).collect()] == [(1, 2)]
