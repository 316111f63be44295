"""Registered queries: one per operator of the inventory, each paired (where the
semantics are SQL-expressible) with an equivalent DuckDB SQL oracle.

Every query reads the driver tables (``events``, ``nation``, ``customer``) in
full through the data roles of :mod:`chronoleaf.sources.roles`; scratch tables,
files and checkpoints go below the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.functions.flags import flag01
from chronoleaf.functions.geo import geodesic_miles_sql, haversine_miles_sql, with_distance
from chronoleaf.functions.strings import clean_user_name
from chronoleaf.functions.time import day_of_week, day_stamp, epoch_seconds
from chronoleaf.operators.asof import asof_join
from chronoleaf.operators.lookup import key_lookup, static_lookup
from chronoleaf.operators.rolling import rolling_aggregate, rolling_count, rolling_sum
from chronoleaf.operators.split import hash_split, time_split
from chronoleaf.operators.stats import accuracy_col, duplicate_keys, exact_medians, fill_with
from chronoleaf.plans.catalog import FeatureCatalog
from chronoleaf.plans.features import (SIX_MONTHS_SECONDS, WEEK_SECONDS,
                                       destination_features, user_features)
from chronoleaf.plans.model import ModelRegistry, OnDemandModel, threshold_predictions
from chronoleaf.plans.ondemand import LOCATION_COLUMNS, add_distance
from chronoleaf.plans.training import Lookup, create_training_set
from chronoleaf.session import materialize, scratch_dir
from chronoleaf.sources import files, roles
from chronoleaf.sources.roles import TRAIN_CUTOFF
from chronoleaf.streaming.control import drain, to_parquet
from chronoleaf.streaming.lookup import lookup_waves

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _prep(spark: SparkSession) -> None:
    # event times are UTC wall-clock; pin the zone so whole-second keys agree
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _ntz(df: DataFrame, *cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---------------------------------------------------------------- SQL building blocks
LOG_CTE = """log AS (
  SELECT event_id, user_id, ts,
         CAST(event_id % 25 AS INTEGER) AS destination_id,
         CAST(ts AS DATE) AS booking_date,
         value AS price,
         event_type = 'purchase' AS purchased,
         event_type = 'click' AS clicked,
         CASE WHEN user_id % 11 <> 0 THEN CAST((user_id * 13) % 100 - 50 AS DOUBLE) END AS user_latitude,
         CASE WHEN user_id % 11 <> 0 THEN CAST((user_id * 29) % 300 - 150 AS DOUBLE) END AS user_longitude
  FROM events)"""

LOC_CTE = """loc AS (
  SELECT CAST(n_nationkey AS INTEGER) AS destination_id, n_name AS name,
         CAST(100 + n_nationkey AS INTEGER) AS price,
         CAST((n_nationkey * 37) % 120 - 55 AS DOUBLE) AS latitude,
         CAST((n_nationkey * 83) % 340 - 170 AS DOUBLE) AS longitude
  FROM nation)"""

AVAIL_CTE = """avail AS (
  SELECT ts AS event_ts, CAST(event_id % 25 AS INTEGER) AS destination_id,
         'NATION_' || CAST(event_id % 25 AS VARCHAR) AS name,
         CAST(ts AS DATE) AS booking_date, CAST(value AS DOUBLE) AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS availability
  FROM events WHERE event_type = 'view')"""

SECS = "epoch_us(ts) // 1000000"

UF_CTE = f"""uf AS (
  SELECT user_id, ts,
         CAST(sum(CAST(price AS DECIMAL(18,2))) OVER w7 AS DOUBLE) / count(*) OVER w7 AS mean_price_7d,
         CAST(sum(CASE WHEN purchased THEN 1 ELSE 0 END) OVER w180 AS BIGINT) AS last_6m_purchases,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week
  FROM (SELECT *, {SECS} AS s FROM log)
  WINDOW w7 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
         w180 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 15552000 PRECEDING AND CURRENT ROW))"""

DF_CTE = f"""dfeat AS (
  SELECT destination_id, ts,
         CAST(sum(CASE WHEN clicked THEN 1 ELSE 0 END) OVER w7 AS BIGINT) AS sum_clicks_7d,
         CAST(count(*) OVER w7 AS BIGINT) AS sum_impressions_7d
  FROM (SELECT *, {SECS} AS s FROM log)
  WINDOW w7 AS (PARTITION BY destination_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW))"""

LAB_CTE = f"lab AS (SELECT * FROM log WHERE ts < TIMESTAMP '{TRAIN_CUTOFF}')"

FRAME_CTE = """fr AS (
  SELECT l.event_id, l.user_longitude, l.user_latitude, d.longitude, d.latitude
  FROM log l LEFT JOIN loc d ON l.destination_id = d.destination_id)"""

def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _rolling_sql(select: str, part: str) -> str:
    return (_with(LOG_CTE) + f"SELECT {select} FROM (SELECT *, {SECS} AS s FROM log)\n"
            f"WINDOW w7 AS (PARTITION BY {part} ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),\n"
            f"       w180 AS (PARTITION BY {part} ORDER BY s RANGE BETWEEN 15552000 PRECEDING AND CURRENT ROW)")


# ---------------------------------------------------------------- shared Spark setup
def _log(spark, sf_dir):
    _prep(spark)
    return roles.purchase_log(spark, sf_dir)


def _catalog(spark) -> FeatureCatalog:
    return FeatureCatalog(spark, database=f"cl_{uuid.uuid4().hex[:10]}",
                          root=scratch_dir(spark, "catalog"))


TABLES = {"user": "user_features", "pop": "destination_popularity_features",
          "loc": "destination_location_features", "avail": "destination_availability_features"}


def travel_catalog(spark, sf_dir, streamed_availability: bool = False
                   ) -> tuple[FeatureCatalog, DataFrame]:
    """Create the reference's four feature tables from the driver tables.
    ``streamed_availability``: the availability table is an empty table filled by
    a streaming merge (S5, S6), as in the reference, instead of a batch write."""
    log = _log(spark, sf_dir)
    cat = _catalog(spark)
    cat.create_table(TABLES["user"], ["user_id"], "ts", df=user_features(log),
                     on_duplicate="latest", description="what a user spent and bought so far")
    cat.create_table(TABLES["pop"], ["destination_id"], "ts", df=destination_features(log),
                     on_duplicate="latest", description="clicks and views of a destination over a week")
    cat.create_table(TABLES["loc"], "destination_id", df=roles.destination_locations(spark, sf_dir),
                     description="where a destination lies")
    if streamed_availability:
        _merged_availability(spark, sf_dir, cat)
    else:
        cat.create_table(TABLES["avail"], ["destination_id", "booking_date"], ["event_ts"],
                         df=roles.availability_log(spark, sf_dir),
                         description="places left by destination and day")
    return cat, log


def travel_lookups() -> list[Lookup]:
    return [
        Lookup(TABLES["pop"], "destination_id", "ts"),
        Lookup(TABLES["loc"], "destination_id", feature_names=("latitude", "longitude")),
        Lookup(TABLES["user"], "user_id", "ts", ("mean_price_7d",)),
        Lookup(TABLES["avail"], ("destination_id", "booking_date"), "ts", ("availability",)),
    ]


# The columns kept out of the training set
EXCLUDE = ["user_id", "destination_id", "ts", "booking_date", "clicked", "price"]


def training_set_df(spark, sf_dir, streamed_availability: bool = False):
    cat, log = travel_catalog(spark, sf_dir, streamed_availability)
    ts = create_training_set(cat, roles.training_labels(log), travel_lookups(),
                             exclude_columns=EXCLUDE, label="purchased")
    return cat, log, ts


# ---------------------------------------------------------------- W: rolling windows
@query("feat_user", _with(LOG_CTE, UF_CTE) + "SELECT * FROM uf")
def q_feat_user(spark, sf_dir):
    return user_features(_log(spark, sf_dir))


@query("feat_destination", _with(LOG_CTE, DF_CTE) + "SELECT * FROM dfeat")
def q_feat_destination(spark, sf_dir):
    return destination_features(_log(spark, sf_dir))


def _one_rolling(spark, sf_dir, keys, agg):
    log = _log(spark, sf_dir)
    src = log.select("event_id", *keys, "ts", "price", flag01("purchased").alias("purchased01"),
                     flag01("clicked").alias("clicked01"))
    out = rolling_aggregate(src, keys, "ts", [agg])
    return out.select("event_id", *keys, "ts", agg.name)


@query("rolling_sum_price", _rolling_sql(
    "event_id, user_id, ts, CAST(sum(CAST(price AS DECIMAL(18,2))) OVER w7 AS DOUBLE) "
    "AS lookedup_price_7d_rolling_sum", "user_id"))
def q_rolling_sum_price(spark, sf_dir):
    return _one_rolling(spark, sf_dir, ["user_id"], rolling_sum(
        "lookedup_price_7d_rolling_sum", "price", WEEK_SECONDS))


@query("rolling_count_user", _rolling_sql(
    "event_id, user_id, ts, CAST(count(*) OVER w7 AS BIGINT) AS lookups_7d_rolling_sum", "user_id"))
def q_rolling_count_user(spark, sf_dir):
    return _one_rolling(spark, sf_dir, ["user_id"], rolling_count("lookups_7d_rolling_sum",
                                                                 WEEK_SECONDS))


@query("rolling_purchases_180d", _rolling_sql(
    "event_id, user_id, ts, CAST(sum(CASE WHEN purchased THEN 1 ELSE 0 END) OVER w180 AS BIGINT) "
    "AS last_6m_purchases", "user_id"))
def q_rolling_purchases(spark, sf_dir):
    return _one_rolling(spark, sf_dir, ["user_id"], rolling_sum(
        "last_6m_purchases", "purchased01", SIX_MONTHS_SECONDS))


@query("rolling_clicks", _rolling_sql(
    "event_id, destination_id, ts, CAST(sum(CASE WHEN clicked THEN 1 ELSE 0 END) OVER w7 AS BIGINT) "
    "AS sum_clicks_7d", "destination_id"))
def q_rolling_clicks(spark, sf_dir):
    return _one_rolling(spark, sf_dir, ["destination_id"], rolling_sum(
        "sum_clicks_7d", "clicked01", WEEK_SECONDS))


@query("rolling_impressions", _rolling_sql(
    "event_id, destination_id, ts, CAST(count(*) OVER w7 AS BIGINT) AS sum_impressions_7d",
    "destination_id"))
def q_rolling_impressions(spark, sf_dir):
    return _one_rolling(spark, sf_dir, ["destination_id"], rolling_count(
        "sum_impressions_7d", WEEK_SECONDS))


@query("rolling_without_current", _rolling_sql(
    "event_id, destination_id, ts, CAST(sum(CASE WHEN clicked THEN 1 ELSE 0 END) OVER own AS BIGINT) AS sum_clicks_7d, "
    "CAST(count(*) OVER own AS BIGINT) AS sum_impressions_7d, "
    "CAST(sum(CAST(price AS DECIMAL(18,2))) OVER own AS DOUBLE) AS sum_price_7d", "destination_id")
    + """,
       own AS (PARTITION BY destination_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW EXCLUDE CURRENT ROW)""")
def q_rolling_without_current(spark, sf_dir):
    log = _log(spark, sf_dir)
    src = log.select("event_id", "destination_id", "ts", "price", flag01("clicked").alias("clicked01"))
    return rolling_aggregate(src, ["destination_id"], "ts", [
        rolling_sum("sum_clicks_7d", "clicked01", WEEK_SECONDS, exclude_current=True),
        rolling_count("sum_impressions_7d", WEEK_SECONDS, exclude_current=True),
        rolling_sum("sum_price_7d", "price", WEEK_SECONDS, exclude_current=True)]).select(
        "event_id", "destination_id", "ts", "sum_clicks_7d", "sum_impressions_7d", "sum_price_7d")


@query("rolling_mean_price", f"""SELECT event_id, user_id, ts,
  CAST(sum(CAST(price AS DECIMAL(18,2))) OVER w7 AS DOUBLE) / count(*) OVER w7 AS mean_price_7d
FROM (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS price,
             {SECS} AS s FROM events)
WINDOW w7 AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)""")
def q_rolling_mean_price(spark, sf_dir):
    _prep(spark)
    e = roles.table(spark, sf_dir, "events")
    # prices of 'error' events are unknown (NULL): they count in the divisor, not the sum
    src = e.select("event_id", "user_id", "ts",
                   F.when(F.col("event_type") != "error", F.col("value")).alias("price"))
    out = rolling_aggregate(src, ["user_id"], "ts", [
        rolling_sum("s7", "price", WEEK_SECONDS),
        rolling_count("n7", WEEK_SECONDS)])
    return out.select("event_id", "user_id", "ts",
                      (F.col("s7") / F.col("n7")).alias("mean_price_7d"))


@query("rolling_sum_fractional", _rolling_sql(
    "event_id, user_id, ts, round(sum(price / 7) OVER w7, 6) AS sevenths_7d", "user_id"))
def q_rolling_sum_fractional(spark, sf_dir):
    out = rolling_aggregate(_log(spark, sf_dir).select("event_id", "user_id", "ts", (F.col("price") / 7).alias("seventh")),
                            ["user_id"], "ts", [rolling_sum("s", "seventh", WEEK_SECONDS)])
    return out.select("event_id", "user_id", "ts", F.round("s", 6).alias("sevenths_7d"))


# ---------------------------------------------------------------- P: projections / filters
@query("flag_null_safe", _with(LOG_CTE) + """SELECT l.event_id,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE l.purchased END AS purchased,
  CAST(CASE WHEN (CASE WHEN e.event_type = 'error' THEN NULL ELSE l.purchased END) = TRUE THEN 1 ELSE 0 END AS INTEGER)
    AS tickets_purchased
FROM log l JOIN events e ON l.event_id = e.event_id""")
def q_flag_null_safe(spark, sf_dir):
    _prep(spark)
    e = roles.table(spark, sf_dir, "events")
    flag = F.when(F.col("event_type") != "error", F.col("event_type") == "purchase")
    return e.select("event_id", flag.alias("purchased"), flag01(flag).alias("tickets_purchased"))


@query("split_before", _with(LOG_CTE) + f"SELECT * FROM log WHERE ts < TIMESTAMP '{TRAIN_CUTOFF}'")
def q_split_before(spark, sf_dir):
    return time_split(_log(spark, sf_dir), "ts", TRAIN_CUTOFF)[0]


@query("split_after", _with(LOG_CTE) + f"SELECT * FROM log WHERE ts >= TIMESTAMP '{TRAIN_CUTOFF}'")
def q_split_after(spark, sf_dir):
    return time_split(_log(spark, sf_dir), "ts", TRAIN_CUTOFF)[1]


@query("hash_split", _with(LOG_CTE) + """SELECT * FROM log
WHERE CAST(('0x' || substr(md5('123:' || CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 4 < 3""")
def q_hash_split(spark, sf_dir):
    return hash_split(_log(spark, sf_dir), "event_id")[0]


@query("threshold_accuracy", _with(LOG_CTE) + """SELECT
  CAST(avg(CASE WHEN purchased = (CASE WHEN price / 500 >= 0.2 THEN TRUE ELSE FALSE END)
           THEN 1 ELSE 0 END) AS DOUBLE) AS accuracy,
  CAST(sum(CASE WHEN price / 500 >= 0.2 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive
FROM log""")
def q_threshold_accuracy(spark, sf_dir):
    log = _log(spark, sf_dir)
    scored = log.select("purchased", (F.col("price") / 500).alias("prediction"))
    t = threshold_predictions(scored, 0.2)
    return t.agg(accuracy_col("purchased", "prediction").alias("accuracy"),
                 F.count_if("prediction").alias("n_positive"))


@query("preview_topn", _with(LOG_CTE, LAB_CTE) + "SELECT * FROM lab ORDER BY ts, event_id LIMIT 5")
def q_preview_topn(spark, sf_dir):
    return roles.training_labels(_log(spark, sf_dir)).orderBy("ts", "event_id").limit(5)


@query("duplicate_keys", _with(LOG_CTE) + """SELECT user_id, booking_date, CAST(count(*) AS BIGINT) AS n
FROM log GROUP BY user_id, booking_date HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_log(spark, sf_dir), ["user_id", "booking_date"])


# ---------------------------------------------------------------- F: scalars
@query("scalar_dates", """SELECT event_id,
  CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS booking_date,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
  epoch_us(ts) // 1000000 AS epoch_s
FROM events""")
def q_scalar_dates(spark, sf_dir):
    _prep(spark)
    e = roles.table(spark, sf_dir, "events")
    return e.select("event_id",
                    F.to_date(F.substring(F.col("ts").cast("string"), 1, 10)).alias("booking_date"),
                    day_of_week("ts").alias("day_of_week"), epoch_seconds("ts").alias("epoch_s"))


@query("scalar_strings", """SELECT c_custkey,
  replace(split_part(lower(c_name), '@', 1), '.', '_') AS user_name FROM customer""")
def q_scalar_strings(spark, sf_dir):
    c = roles.table(spark, sf_dir, "customer")
    return c.select("c_custkey", clean_user_name("c_name").alias("user_name"))


@query("scalar_day_stamp", """SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y%m%d') AS day_stamp
FROM events""")
def q_scalar_day_stamp(spark, sf_dir):
    _prep(spark)
    e = roles.table(spark, sf_dir, "events")
    return e.select("event_id", day_stamp("ts", -5).alias("day_stamp"))


def _distance_query(spark, sf_dir, sql_fn):
    log = _log(spark, sf_dir)
    fr = static_lookup(log.select("event_id", "user_latitude", "user_longitude", "destination_id"),
                       roles.destination_locations(spark, sf_dir), "destination_id",
                       "destination_id", ["latitude", "longitude"])
    method = "geodesic" if sql_fn is geodesic_miles_sql else "haversine"
    out = with_distance(fr, "user_latitude", "user_longitude", "latitude", "longitude",
                        "distance_miles", method)
    return out.select("event_id", F.round("distance_miles", 3).alias("distance_miles"))


# Nodes and weights of the eight-point Gauss-Legendre rule, WGS-84 flattening and semi-major axis
_NODES = [(0.1834346424956498, 0.3626837833783620), (0.5255324099163290, 0.3137066458778873),
          (0.7966664774136267, 0.2223810344533745), (0.9602898564975363, 0.1012285362903763)]
_FLAT, _AXIS, _MILE = "(1 / 298.257223563)", "6378137.0", "1609.344"


def _integral(of: str) -> str:
    """Of sqrt(1 + k2 sin^2 t), as {r} in ``of``, over the arc from s1 to s2."""
    terms = [f"{w!r} * ({of.format(r=f'sqrt(1 + k2 * pow(sin((s1 + s2) / 2 {sign} (s2 - s1) / 2 * {x!r}), 2))')})"
             for x, w in _NODES for sign in "+-"]
    return f"((s2 - s1) / 2 * ({' + '.join(terms)}))"


def _geodesic_oracle(pairs: str) -> str:
    """CTEs ending in geo(a, b, c, d, miles) for the distinct (a, b) to (c, d) of ``pairs``: the azimuth is bisected and
    the integrals of the geodesic are summed numerically, so nothing is shared with the library's series."""
    line = f"""SELECT *, (2 * {_FLAT} - pow({_FLAT}, 2)) / pow(1 - {_FLAT}, 2) * (1 - sa * sa) AS k2,
      atan2(sin1, x) AS s1, atan2(sin2, y) AS s2, atan2(sa * sin2, y) - atan2(sa * sin1, x) AS turn FROM (
        SELECT *, -sin(m) * cos1 AS x, cos(m) * cos1 AS sa, sqrt(greatest(0, pow(sin(m) * cos1, 2) + cos2 * cos2 - cos1 * cos1)) AS y
        FROM (SELECT *, (lo + hi) / 2 AS m FROM bis WHERE {{0}}))"""
    ahead = f"{_FLAT} * sa * " + _integral(f"(2 - {_FLAT}) / (1 + (1 - {_FLAT}) * {{r}})")
    return f"""pairs AS ({pairs}),
ends AS MATERIALIZED (SELECT a, b, c, d, abs(radians(d - b) - 2 * pi() * round((d - b) / 360)) AS gap,
  atan((1 - {_FLAT}) * tan(radians(a))) AS p, atan((1 - {_FLAT}) * tan(radians(c))) AS q
  FROM (SELECT DISTINCT a, b, c, d FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL)),
bis AS (
  SELECT 0 AS i, -pi() / 2 AS lo, pi() / 2 AS hi, a, b, c, d, gap, sin(u) AS sin1, cos(u) AS cos1, sin(v) AS sin2, cos(v) AS cos2
  FROM (SELECT *, least(-1e-300, CASE WHEN first > 0 THEN -first ELSE first END) AS u, CASE WHEN first > 0 THEN -other ELSE other END AS v
        FROM (SELECT *, CASE WHEN abs(p) >= abs(q) THEN p ELSE q END AS first, CASE WHEN abs(p) >= abs(q) THEN q ELSE p END AS other
              FROM ends))
  UNION ALL
  SELECT i + 1, CASE WHEN turn - {ahead} < gap THEN m ELSE lo END, CASE WHEN turn - {ahead} < gap THEN hi ELSE m END,
    a, b, c, d, gap, sin1, cos1, sin2, cos2 FROM ({line.format('i < 70')})
), geo AS MATERIALIZED (
  SELECT a, b, c, d, CASE WHEN a = c AND gap = 0 THEN 0
    WHEN sin1 > -1e-200 AND sin2 = 0 AND gap <= pi() * (1 - {_FLAT}) THEN {_AXIS} * gap / {_MILE}
    ELSE {_AXIS} * (1 - {_FLAT}) * {_integral('{r}')} / {_MILE} END AS miles FROM ({line.format('i = 70')})
)"""


def _distance_sql(fn) -> str:
    expr = fn("l.user_latitude", "l.user_longitude", "d.latitude", "d.longitude")
    return (_with(LOG_CTE, LOC_CTE) + f"SELECT l.event_id, round({expr}, 3) AS distance_miles\n"
            "FROM log l LEFT JOIN loc d ON l.destination_id = d.destination_id")


_GEO_KEYS = " AND ".join(f"g.{x} = {{}}" for x in "abcd")


@query("distance_geodesic", _with(LOG_CTE, LOC_CTE, """ll AS (SELECT l.event_id, l.user_latitude AS a, l.user_longitude AS b,
  d.latitude AS c, d.longitude AS d FROM log l LEFT JOIN loc d ON l.destination_id = d.destination_id)""",
       _geodesic_oracle("SELECT a, b, c, d FROM ll")).replace("WITH", "WITH RECURSIVE", 1)
       + f"""SELECT event_id, round(g.miles, 3) AS distance_miles
FROM ll LEFT JOIN geo g ON {_GEO_KEYS.format('ll.a', 'll.b', 'll.c', 'll.d')}""")
def q_distance_geodesic(spark, sf_dir):
    return _distance_query(spark, sf_dir, geodesic_miles_sql)


@query("distance_haversine", _distance_sql(haversine_miles_sql))
def q_distance_haversine(spark, sf_dir):
    return _distance_query(spark, sf_dir, haversine_miles_sql)


# ---------------------------------------------------------------- A / U: medians, on-demand
def _frame(spark, sf_dir):
    log = _log(spark, sf_dir)
    return static_lookup(log.select("event_id", "user_longitude", "user_latitude", "destination_id"),
                         roles.destination_locations(spark, sf_dir), "destination_id",
                         "destination_id", ["longitude", "latitude"]).drop("destination_id")


_MED_SQL = {c: f"(SELECT median({c}) FROM fr)" for c in LOCATION_COLUMNS}


@query("median_coords", _with(LOG_CTE, LOC_CTE, FRAME_CTE) + "SELECT " + ", ".join(
    f"CAST(median({c}) AS DOUBLE) AS med_{c}" for c in LOCATION_COLUMNS) + " FROM fr")
def q_median_coords(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    med = exact_medians(fr, list(LOCATION_COLUMNS))
    # one row derived from the frame, carrying the exact medians
    return fr.agg(F.count(F.lit(1)).alias("__n")).select(
        *[F.lit(med[c]).cast("double").alias(f"med_{c}") for c in LOCATION_COLUMNS])


@query("fill_median", _with(LOG_CTE, LOC_CTE, FRAME_CTE) + "SELECT event_id, " + ", ".join(
    f"coalesce({c}, {_MED_SQL[c]}) AS {c}" for c in LOCATION_COLUMNS) + " FROM fr")
def q_fill_median(spark, sf_dir):
    fr = _frame(spark, sf_dir)
    return fill_with(fr, exact_medians(fr, list(LOCATION_COLUMNS)))


_FILLED = [f"coalesce(CAST({c} AS DOUBLE), CAST({_MED_SQL[c]} AS DOUBLE))"
           for c in ("user_latitude", "user_longitude", "latitude", "longitude")]


@query("ondemand_distance", _with(LOG_CTE, LOC_CTE, FRAME_CTE, "ff AS MATERIALIZED (SELECT *, " + ", ".join(
    f"{v} AS {k}" for k, v in zip("abcd", _FILLED)) + " FROM fr)", _geodesic_oracle("SELECT a, b, c, d FROM ff"))
       .replace("WITH", "WITH RECURSIVE", 1) + "SELECT event_id, " + ", ".join(f"ff.{c}" for c in LOCATION_COLUMNS)
       + f""", CASE WHEN abs(ff.a) <= 90 AND abs(ff.c) <= 90 THEN round(g.miles, 3) END AS distance
FROM ff LEFT JOIN geo g ON {_GEO_KEYS.format('ff.a', 'ff.b', 'ff.c', 'ff.d')}""")
def q_ondemand_distance(spark, sf_dir):
    out = add_distance(_frame(spark, sf_dir))
    return out.withColumn("distance", F.round("distance", 3))


# ---------------------------------------------------------------- J: lookups
def _asof_sql(select_f: str, table_cte: str, table: str, on: str) -> str:
    return (_with(LOG_CTE, LAB_CTE, table_cte) +
            f"SELECT l.*, {select_f} FROM lab l ASOF LEFT JOIN {table} f ON {on}")


@query("asof_popularity", _asof_sql("f.sum_clicks_7d, f.sum_impressions_7d", DF_CTE, "dfeat",
                                    "l.destination_id = f.destination_id AND l.ts >= f.ts"))
def q_asof_popularity(spark, sf_dir):
    log = _log(spark, sf_dir)
    return asof_join(roles.training_labels(log), destination_features(log), "destination_id",
                     "destination_id", "ts", "ts")


@query("asof_user", _asof_sql("f.mean_price_7d", UF_CTE, "uf",
                              "l.user_id = f.user_id AND l.ts >= f.ts"))
def q_asof_user(spark, sf_dir):
    log = _log(spark, sf_dir)
    return asof_join(roles.training_labels(log), user_features(log), "user_id", "user_id", "ts",
                     "ts", ["mean_price_7d"])


@query("asof_availability", _asof_sql(
    "f.availability", AVAIL_CTE, "avail",
    "l.destination_id = f.destination_id AND l.booking_date = f.booking_date AND l.ts >= f.event_ts"))
def q_asof_availability(spark, sf_dir):
    log = _log(spark, sf_dir)
    return asof_join(roles.training_labels(log), roles.availability_log(spark, sf_dir),
                     ["destination_id", "booking_date"], ["destination_id", "booking_date"], "ts",
                     "event_ts", ["availability"])


@query("lookup_location", _with(LOG_CTE, LAB_CTE, LOC_CTE) +
       "SELECT l.*, d.latitude, d.longitude FROM lab l LEFT JOIN loc d ON l.destination_id = d.destination_id")
def q_lookup_location(spark, sf_dir):
    log = _log(spark, sf_dir)
    return static_lookup(roles.training_labels(log), roles.destination_locations(spark, sf_dir),
                         "destination_id", "destination_id", ["latitude", "longitude"])


@query("lookup_hot_keys", _with(LOG_CTE, LOC_CTE) + """SELECT l.event_id, l.destination_id, d.latitude, d.longitude
FROM (SELECT event_id, CASE WHEN clicked THEN 7 WHEN NOT purchased THEN destination_id END AS destination_id FROM log) l
LEFT JOIN loc d ON l.destination_id = d.destination_id""")
def q_lookup_hot_keys(spark, sf_dir):
    """A lookup left to the shuffle, with one destination and NULL in many of the rows."""
    log = _log(spark, sf_dir)
    asked = F.when(F.col("clicked"), F.lit(7)).when(~F.col("purchased"), F.col("destination_id"))
    return key_lookup(log.select("event_id", asked.alias("destination_id")), roles.destination_locations(spark, sf_dir),
                      "destination_id", "destination_id", ["latitude", "longitude"], broadcast=False,
                      hot_rows=HOT_ROWS)


HOT_ROWS = 500   # so that the smallest test tables have hot keys


def _training_sql(avail_ctes=(AVAIL_CTE,), avail="avail") -> str:
    return _with(LOG_CTE, LAB_CTE, LOC_CTE, *avail_ctes, UF_CTE, DF_CTE, """t1 AS (
  SELECT l.*, f.sum_clicks_7d, f.sum_impressions_7d FROM lab l
  ASOF LEFT JOIN dfeat f ON l.destination_id = f.destination_id AND l.ts >= f.ts)""", """t2 AS (
  SELECT t1.*, d.latitude, d.longitude FROM t1 LEFT JOIN loc d ON t1.destination_id = d.destination_id)""",
                 """t3 AS (
  SELECT t2.*, u.mean_price_7d FROM t2 ASOF LEFT JOIN uf u ON t2.user_id = u.user_id AND t2.ts >= u.ts)""",
                 f"""t4 AS (
  SELECT t3.*, a.availability FROM t3 ASOF LEFT JOIN {avail} a
  ON t3.destination_id = a.destination_id AND t3.booking_date = a.booking_date AND t3.ts >= a.event_ts)""") + \
        """SELECT event_id, user_latitude, user_longitude, sum_clicks_7d, sum_impressions_7d,
  latitude, longitude, mean_price_7d, availability, purchased FROM t4"""


TRAINING_SQL = _training_sql()


@query("training_set", TRAINING_SQL)
def q_training_set(spark, sf_dir):
    _cat, _log_df, ts = training_set_df(spark, sf_dir)
    return ts.load_df()


@query("create_feature_table", _with(LOG_CTE, UF_CTE) + "SELECT * FROM uf")
def q_create_feature_table(spark, sf_dir):
    log = _log(spark, sf_dir)
    cat = _catalog(spark)
    cat.create_table("user_features", ["user_id"], "ts", df=user_features(log),
                     description="what a user spent and bought so far")
    return cat.read_table("user_features")


@query("create_feature_table_latest", _with(
    LOG_CTE, "hourly AS (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM log)",
    DF_CTE.replace("FROM log", "FROM hourly")) + "SELECT DISTINCT * FROM dfeat")
def q_create_feature_table_latest(spark, sf_dir):
    """Times as coarse as an hour: several rows share a key, of which one stays."""
    log = _log(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    cat = _catalog(spark)
    cat.create_table("popularity", ["destination_id"], "ts", df=destination_features(log), on_duplicate="latest")
    return _ntz(cat.read_table("popularity"), "ts")


LATEST = "QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY {t} DESC) = 1"


@query("publish_latest", _with(LOG_CTE, UF_CTE) + "SELECT * FROM uf " +
       LATEST.format(k="user_id", t="ts"))
def q_publish_latest(spark, sf_dir):
    log = _log(spark, sf_dir)
    cat = _catalog(spark)
    cat.create_table("user_features", ["user_id"], "ts", df=user_features(log))
    cat.publish_table("user_features")
    return cat.read_online("user_features")


ONLINE_SQL = _with(LOG_CTE, LOC_CTE, AVAIL_CTE, UF_CTE, DF_CTE,
                   "ufl AS (SELECT * FROM uf " + LATEST.format(k="user_id", t="ts") + ")",
                   "dfl AS (SELECT * FROM dfeat " + LATEST.format(k="destination_id", t="ts") + ")",
                   "avl AS (SELECT * FROM avail " +
                   LATEST.format(k="destination_id, booking_date", t="event_ts") + ")") + \
    """SELECT r.event_id, r.user_id, r.booking_date, r.destination_id, r.user_latitude, r.user_longitude,
  ufl.mean_price_7d, dfl.sum_clicks_7d, dfl.sum_impressions_7d, d.latitude, d.longitude, avl.availability
FROM log r
LEFT JOIN ufl ON r.user_id = ufl.user_id
LEFT JOIN dfl ON r.destination_id = dfl.destination_id
LEFT JOIN loc d ON r.destination_id = d.destination_id
LEFT JOIN avl ON r.destination_id = avl.destination_id AND r.booking_date = avl.booking_date"""


def online_features(cat: FeatureCatalog, requests: DataFrame, lookup=None) -> DataFrame:
    """Latest-value features for request rows (keys, no time) from published tables."""
    from chronoleaf.operators.lookup import online_lookup
    lookup = lookup or online_lookup
    out = lookup(requests, cat.read_online(TABLES["user"]), "user_id", "user_id",
                 ["mean_price_7d"])
    out = lookup(out, cat.read_online(TABLES["pop"]), "destination_id", "destination_id",
                 ["sum_clicks_7d", "sum_impressions_7d"])
    out = lookup(out, cat.read_online(TABLES["loc"]), "destination_id", "destination_id",
                 ["latitude", "longitude"])
    out = lookup(out, cat.read_online(TABLES["avail"]), ["destination_id", "booking_date"],
                 ["destination_id", "booking_date"], ["availability"])
    return out


@query("online_lookup", ONLINE_SQL)
def q_online_lookup(spark, sf_dir):
    cat, log = travel_catalog(spark, sf_dir)
    for t in TABLES.values():
        cat.publish_table(t)
    return online_features(cat, roles.requests(log))


# ---------------------------------------------------------------- T: streaming
def _files(df: DataFrame, at_least: int = 8) -> int:
    """Output file count: at least a few (so streams see several triggers), else as
    many as the input has partitions (the write parallelism grows with the data)."""
    return max(at_least, df.rdd.getNumPartitions())


def _stage_availability(spark, sf_dir, path, where=None, transform=None):
    """Write availability log rows as JSON files (the stream's source directory)."""
    df = roles.availability_log(spark, sf_dir)
    if where is not None:
        df = df.where(where)
    if transform is not None:
        df = transform(df)
    # round-robin: even files even when one destination holds most rows
    files.write_json(df.repartition(_files(df)), path, mode="append")


AVAIL_OUT = _with(AVAIL_CTE) + "SELECT * FROM avail"


@query("stream_json_scan", AVAIL_OUT)
def q_stream_json_scan(spark, sf_dir):
    _prep(spark)
    base = scratch_dir(spark, "stream_json_scan")
    _stage_availability(spark, sf_dir, f"{base}/src")
    stream = files.availability_features(
        files.json_stream(spark, f"{base}/src/*.json", max_files_per_trigger=2))
    drain(to_parquet(stream, f"{base}/sink", f"{base}/ckpt"))
    return _ntz(spark.read.parquet(f"{base}/sink"), "event_ts")


def _bump(df):
    return df.withColumns({"price": F.col("price") + 1,
                           "availability": F.col("availability") + 1000})


MERGED_CTE = """merged AS (SELECT event_ts, destination_id, name, booking_date,
  CASE WHEN availability < 50 THEN price + 1 ELSE price END AS price,
  CASE WHEN availability < 50 THEN availability + 1000 ELSE availability END AS availability
  FROM avail)"""


def _merged_availability(spark, sf_dir, cat: FeatureCatalog | None = None):
    """Two waves through one streaming merge into an empty feature table: all rows,
    then rewrites of the low-availability rows (same keys and event time)."""
    _prep(spark)
    base = scratch_dir(spark, "stream_merge")
    cat = cat or _catalog(spark)
    cat.create_table(TABLES["avail"], ["destination_id", "booking_date"], ["event_ts"],
                     schema=files.AVAILABILITY_SCHEMA, description="places left by destination and day")
    src, ckpt = f"{base}/src", f"{base}/ckpt"
    _stage_availability(spark, sf_dir, src)
    stream = lambda: files.availability_features(files.json_stream(spark, f"{src}/*.json"))
    drain(cat.write_table(TABLES["avail"], stream(), mode="merge", checkpoint_location=ckpt))
    # periodic compaction: the rewrites below then fold into the snapshot on read
    cat.compact(TABLES["avail"])
    _stage_availability(spark, sf_dir, src, where=F.col("availability") < 50, transform=_bump)
    drain(cat.write_table(TABLES["avail"], stream(), mode="merge", checkpoint_location=ckpt))
    return cat, base


@query("training_set_streamed", _training_sql((AVAIL_CTE, MERGED_CTE), "merged"))
def q_training_set_streamed(spark, sf_dir):
    """The reference's flow: availability arrives by streaming merge (with rewrites),
    then the point-in-time training set is assembled over the resolved table."""
    _cat, _log_df, ts = training_set_df(spark, sf_dir, streamed_availability=True)
    return ts.load_df()


@query("stream_merge_write", _with(AVAIL_CTE, MERGED_CTE) + "SELECT * FROM merged")
def q_stream_merge_write(spark, sf_dir):
    cat, _ = _merged_availability(spark, sf_dir)
    return _ntz(cat.read_table(TABLES["avail"]), "event_ts")


@query("stream_publish_latest", _with(AVAIL_CTE, MERGED_CTE) + "SELECT * FROM merged " +
       LATEST.format(k="destination_id, booking_date", t="event_ts"))
def q_stream_publish_latest(spark, sf_dir):
    cat, base = _merged_availability(spark, sf_dir)
    drain(cat.publish_table(TABLES["avail"], streaming=True, checkpoint_location=f"{base}/online"))
    cat.compact_online(TABLES["avail"])
    return _ntz(cat.read_online(TABLES["avail"]), "event_ts")


@query("stream_drain", AVAIL_OUT)
def q_stream_drain(spark, sf_dir):
    """Continuous trigger, one file per micro-batch, drained then stopped (T-e)."""
    _prep(spark)
    base = scratch_dir(spark, "stream_drain")
    _stage_availability(spark, sf_dir, f"{base}/src")
    stream = files.availability_features(
        files.json_stream(spark, f"{base}/src/*.json", max_files_per_trigger=1))
    q = to_parquet(stream, f"{base}/sink", f"{base}/ckpt", trigger={"processingTime": "100 milliseconds"})
    drain(q)
    return _ntz(spark.read.parquet(f"{base}/sink"), "event_ts")


@query("stream_resume", AVAIL_OUT)
def q_stream_resume(spark, sf_dir):
    """Three runs on one checkpoint: old files, then new files, then nothing new (T-f)."""
    _prep(spark)
    base = scratch_dir(spark, "stream_resume")
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    cut = F.col("event_ts") < F.lit(TRAIN_CUTOFF).cast("timestamp")
    _stage_availability(spark, sf_dir, src, where=cut)
    stream = lambda: files.availability_features(files.json_stream(spark, f"{src}/*.json"))
    drain(to_parquet(stream(), sink, ckpt))
    _stage_availability(spark, sf_dir, src, where=~cut | F.col("event_ts").isNull())
    drain(to_parquet(stream(), sink, ckpt))
    drain(to_parquet(stream(), sink, ckpt))
    return _ntz(spark.read.parquet(sink), "event_ts")


def _two_waves(name: str, table: str, key: str) -> str:
    """Latest rows as published before and after the later features came."""
    last = LATEST.format(k=key, t="ts")
    return (f"{name} AS ((SELECT *, true AS early FROM {table} WHERE ts < TIMESTAMP '{TRAIN_CUTOFF}' {last}) "
            f"UNION ALL (SELECT *, false AS early FROM {table} {last}))")


STREAM_ONLINE_SQL = _with(LOG_CTE, UF_CTE, DF_CTE, _two_waves("ufl", "uf", "user_id"),
                          _two_waves("dfl", "dfeat", "destination_id")) + \
    f"""SELECT r.event_id, r.user_id, r.booking_date, r.destination_id, r.user_latitude, r.user_longitude,
  ufl.mean_price_7d, dfl.sum_clicks_7d, dfl.sum_impressions_7d
FROM (SELECT *, coalesce(ts < TIMESTAMP '{TRAIN_CUTOFF}', false) AS wave1 FROM log) r
LEFT JOIN ufl ON r.user_id = ufl.user_id AND r.wave1 = ufl.early
LEFT JOIN dfl ON r.destination_id = dfl.destination_id AND r.wave1 = dfl.early"""


@query("stream_online_lookup", STREAM_ONLINE_SQL)
def q_stream_online_lookup(spark, sf_dir):
    """One running stream, two waves of requests, and a republish of newer features between them."""
    log = _log(spark, sf_dir)
    cat = _catalog(spark)
    early = F.coalesce(F.col("ts") < F.lit(TRAIN_CUTOFF).cast("timestamp"), F.lit(False))
    base = scratch_dir(spark, "stream_requests")
    feats = {TABLES["user"]: (["user_id"], user_features(log)),
             TABLES["pop"]: (["destination_id"], destination_features(log))}
    feats = {t: (keys, materialize(df, f"stream_requests_{t}")) for t, (keys, df) in feats.items()}

    def send(rows):
        reqs = roles.requests(rows)
        reqs.repartition(_files(reqs)).write.mode("append").parquet(f"{base}/requests")

    def enrich(wave):
        out = key_lookup(wave, cat.read_online(TABLES["user"]), "user_id", "user_id", ["mean_price_7d"])
        return key_lookup(out, cat.read_online(TABLES["pop"]), "destination_id", "destination_id",
                          ["sum_clicks_7d", "sum_impressions_7d"])

    for t, (keys, df) in feats.items():
        cat.create_table(t, keys, "ts", df=df.where(early), on_duplicate="latest")
        cat.publish_table(t)
    send(log.where(early))
    live = (spark.readStream.schema(roles.requests(log).schema).option("maxFilesPerTrigger", 8)
            .parquet(f"{base}/requests"))
    running = lookup_waves(live, enrich, f"{base}/sink", f"{base}/ckpt",
                           trigger={"processingTime": "100 milliseconds"})
    running.processAllAvailable()
    for t, (_, df) in feats.items():
        cat.write_table(t, df.where(~early))
        cat.publish_table(t)
    send(log.where(~early))
    drain(running)
    return spark.read.parquet(f"{base}/sink").drop("wave")


# ---------------------------------------------------------------- S1: CSV scan
@query("scan_csv_infer", _with(LOG_CTE) + """SELECT CAST(event_id AS INTEGER) AS event_id,
  CAST(user_id AS INTEGER) AS user_id, ts, destination_id, booking_date, price, purchased, clicked,
  user_latitude, user_longitude FROM log""")
def q_scan_csv_infer(spark, sf_dir):
    log = _log(spark, sf_dir)
    base = scratch_dir(spark, "csv")
    files.write_csv(log.withColumn("ts", F.col("ts").cast("timestamp")), f"{base}/purchase_log")
    df = files.read_csv(spark, f"{base}/purchase_log")
    df = df.withColumn("booking_date", F.to_date("booking_date"))
    return _ntz(df, "ts")


@query("scan_csv_declared", _with(LOC_CTE) + """SELECT destination_id, name,
  CASE WHEN destination_id % 5 <> 3 THEN price END AS price, latitude, longitude,
  CASE WHEN destination_id % 5 = 3 THEN concat_ws(',', destination_id, name, 'n/a', latitude, longitude) END AS malformed_line
FROM loc""")
def q_scan_csv_declared(spark, sf_dir):
    """The location dimension from CSV with a declared schema; every fifth line has a price that is no number."""
    loc = roles.destination_locations(spark, sf_dir)
    price = F.when(F.col("destination_id") % 5 == 3, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    path = f"{scratch_dir(spark, 'csv')}/locations"
    loc.select(F.concat_ws(",", "destination_id", "name", price, "latitude", "longitude").alias("value")).write.text(path)
    return files.read_csv_checked(spark, path, files.LOCATION_SCHEMA, header=False)


# ---------------------------------------------------------------- L / U: model
# Tree scores have no SQL form; what can be checked of every row is returned instead.
TEST_SPLIT = "CAST(('0x' || substr(md5('123:' || CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 4 >= 3"


def _in_range():
    return F.col("prediction").between(0.0, 1.0).alias("in_range")


def _fit(ts):
    """Model fitted on three quarters of the training set, and the quarter held out."""
    train, test = hash_split(materialize(ts.load_df(), "training-set"), "event_id")
    return OnDemandModel(exclude=["event_id"]).fit(train, "purchased"), test


def _scored_twice(loaded: DataFrame, model, *columns: str) -> DataFrame:
    """Rows scored by a loaded model, held against the model that was saved, a walk down its trees in SQL, and
    a constant guess (which gives all rows one score)."""
    again = model.transform(loaded.withColumnRenamed("prediction", "loaded"), features="vector")
    scored = materialize(model.tree_walk(again, features="vector").drop("vector"), "scored")
    low, high = scored.agg(F.min("prediction"), F.max("prediction")).first()
    return scored.select(*columns, _in_range(), F.col("loaded").eqNullSafe(F.col("prediction")).alias("same_after_load"),
                         (F.abs(F.col("walked") - F.col("prediction")) < 1e-6).alias("same_as_walk"),
                         F.lit(low is not None and low < high).alias("scores_differ"))


SCORED = "true AS in_range, true AS same_after_load, true AS same_as_walk, true AS scores_differ"


@query("train_score", _with(LOG_CTE) + f"SELECT event_id, purchased, {SCORED} FROM log")
def q_train_score(spark, sf_dir):
    """Fit, log with the lookups, and score the whole log by name (lookups included)."""
    cat, log, ts = training_set_df(spark, sf_dir)
    model, _ = _fit(ts)
    reg = ModelRegistry(spark, scratch_dir(spark, "models"))
    reg.log_model("travel", model, ts)
    return _scored_twice(reg.score_batch(cat, "models:/travel/latest", log), model, "event_id", "purchased")


@query("model_roundtrip", _with(LOG_CTE, LAB_CTE) + f"SELECT event_id, purchased, {SCORED} FROM lab")
def q_model_roundtrip(spark, sf_dir):
    """Two versions logged, the newest loaded, the whole training set scored."""
    _cat, _log_df, ts = training_set_df(spark, sf_dir)
    frame = materialize(ts.load_df(), "training-set")
    model = OnDemandModel(exclude=["event_id"]).fit(hash_split(frame, "event_id")[0], "purchased")
    reg = ModelRegistry(spark, scratch_dir(spark, "models"))
    reg.log_model("travel", model, ts)
    v = reg.log_model("travel", model, ts)
    if v != 2 or reg.latest_version("travel") != 2:
        raise RuntimeError("model registry did not advance the version")
    return _scored_twice(reg.load("travel", reg.latest_version("travel")).transform(frame), model,
                         "event_id", "purchased")


@query("model_accuracy", "SELECT count(*) AS n_test, "
       "CAST(greatest(avg(CASE WHEN coalesce(availability, 0) >= 50 THEN 1 ELSE 0 END), "
       "avg(CASE WHEN coalesce(availability, 0) >= 50 THEN 0 ELSE 1 END)) AS DOUBLE) AS constant_accuracy, "
       f"true AS beats_constant FROM ({_training_sql((AVAIL_CTE,), 'avail')}) WHERE {TEST_SPLIT}")
def q_model_accuracy(spark, sf_dir):
    """Accuracy of real scores on the held-out quarter against the constant guess.  The label
    (at least 50 places left) follows from a feature, so a model that learns must win."""
    _cat, _log_df, ts = training_set_df(spark, sf_dir)
    frame = materialize(ts.load_df(), "training-set").withColumn("open", F.coalesce("availability", F.lit(0)) >= 50)
    train, test = hash_split(frame, "event_id")
    model = OnDemandModel(exclude=["event_id", "purchased"]).fit(train, "open")
    scored = threshold_predictions(model.transform(test), 0.5)
    share = F.avg(F.col("open").cast("double"))
    return (scored.agg(F.count(F.lit(1)).alias("n_test"), F.greatest(share, 1 - share).alias("constant_accuracy"),
                       accuracy_col("open", "prediction").alias("accuracy"))
            .select("n_test", "constant_accuracy", (F.col("accuracy") > F.col("constant_accuracy")).alias("beats_constant")))


@query("online_score", f"SELECT *, {SCORED} FROM ({ONLINE_SQL})")
def q_online_score(spark, sf_dir):
    """Requests without time or price: newest published features, then the fitted model."""
    cat, log, ts = training_set_df(spark, sf_dir)
    model, _ = _fit(ts)
    for t in TABLES.values():
        cat.publish_table(t)
    requests = online_features(cat, roles.requests(log))
    reg = ModelRegistry(spark, scratch_dir(spark, "models"))
    reg.log_model("travel", model, ts)
    return _scored_twice(reg.load("travel").transform(requests), model, *requests.columns)
