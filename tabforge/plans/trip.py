"""Trip program on the driver tables (E2 in SURVEY §3).

Mapping: one trip per order.  Coordinates, pickup time and duration are
derived by fixed rules from the order and customer keys (SURVEY §7.3);
orders with ``o_orderkey % 5 = 0`` form the test split (no duration).
Clusters come from M02 with centres derived from the data: the rounded
mean 4-D point of each ``id % 20`` group over both splits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, timefn
from ..functions.contract import ratio
from ..operators import clean, encode, ml
from ..operators.joins import join_measured
from .common import TS, R, T, finish, query, rnd, ts_text

# The 18 extreme-weather days of the trip program (2016).
WEATHER_EVENT_DAYS = ["20160110", "20160113", "20160117", "20160123",
                      "20160205", "20160208", "20160215", "20160216",
                      "20160224", "20160225", "20160314", "20160315",
                      "20160328", "20160329", "20160403", "20160404",
                      "20160530", "20160628"]
# The outlier bounds of the trip program.
DURATION_BOUNDS = (120, 85000)
LAT_BOUNDS = (40.6, 40.9)
LNG_BOUNDS = (-74.05, -73.7)

# The driver's orders span 1995-2001; the same month/days in 1997 are used.
EVENT_DAYS_1997 = [dt.date(1997, int(d[4:6]), int(d[6:8])) for d in WEATHER_EVENT_DAYS]
K = 20
POINT4 = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]

TRIPS_SQL = """
trips AS (
  SELECT o_orderkey AS id,
         CAST(o_orderkey % 2 + 1 AS INTEGER) AS vendor_id,
         CAST(o_custkey % 6 + 1 AS INTEGER) AS passenger_count,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) AS pickup_datetime,
         CAST(40.58 AS DOUBLE) + CAST(o_custkey % 340 AS DOUBLE) / 1000 AS pickup_latitude,
         CAST(-74.06 AS DOUBLE) + CAST(o_orderkey % 370 AS DOUBLE) / 1000 AS pickup_longitude,
         CAST(40.58 AS DOUBLE) + CAST(o_orderkey % 331 AS DOUBLE) / 1000 AS dropoff_latitude,
         CAST(-74.06 AS DOUBLE) + CAST(o_custkey % 353 AS DOUBLE) / 1000 AS dropoff_longitude,
         CASE WHEN o_orderkey % 10 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(60 + o_orderkey % 90000 AS BIGINT) AS trip_duration,
         o_orderkey % 5 = 0 AS is_test
  FROM orders),
train_raw AS (SELECT * EXCLUDE (is_test) FROM trips WHERE NOT is_test),
train AS (
  SELECT *, ln(1 + trip_duration) AS log_trip_duration FROM train_raw
  WHERE NOT coalesce(trip_duration > 85000 OR trip_duration < 120
        OR dropoff_latitude < 40.6 OR dropoff_latitude > 40.9
        OR dropoff_longitude < -74.05 OR dropoff_longitude > -73.7
        OR pickup_latitude < 40.6 OR pickup_latitude > 40.9
        OR pickup_longitude < -74.05 OR pickup_longitude > -73.7, false)),
test AS (SELECT * EXCLUDE (is_test, trip_duration) FROM trips WHERE is_test)"""


def trips(t) -> DataFrame:
    o = t.orders
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("id"),
        (k % 2 + 1).cast("int").alias("vendor_id"),
        (c % 6 + 1).cast("int").alias("passenger_count"),
        F.timestamp_add("SECOND", (k * 7919) % 86400, F.col("o_orderdate")).alias("pickup_datetime"),
        (F.lit(40.58) + (c % 340).cast("double") / 1000).alias("pickup_latitude"),
        (F.lit(-74.06) + (k % 370).cast("double") / 1000).alias("pickup_longitude"),
        (F.lit(40.58) + (k % 331).cast("double") / 1000).alias("dropoff_latitude"),
        (F.lit(-74.06) + (c % 353).cast("double") / 1000).alias("dropoff_longitude"),
        F.when(k % 10 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("store_and_fwd_flag"),
        (F.lit(60) + k % 90000).cast("long").alias("trip_duration"),
        (k % 5 == 0).alias("is_test"))


def splits(t) -> tuple[DataFrame, DataFrame]:
    """(train, test): P04 bounds on train (missing kept), log target."""
    all_trips = trips(t)
    train = clean.drop_outside(
        all_trips.where(~F.col("is_test")).drop("is_test"),
        {"trip_duration": DURATION_BOUNDS,
         "dropoff_latitude": LAT_BOUNDS, "dropoff_longitude": LNG_BOUNDS,
         "pickup_latitude": LAT_BOUNDS, "pickup_longitude": LNG_BOUNDS})
    train = train.withColumn("log_trip_duration", F.log1p("trip_duration"))
    test = all_trips.where(F.col("is_test")).drop("is_test", "trip_duration")
    return train, test


# --- clusters (M02) ------------------------------------------------------------------------
CENTERS_SQL = f"""
pts AS (SELECT id, {', '.join(POINT4)} FROM train UNION ALL SELECT id, {', '.join(POINT4)} FROM test),
centers AS (SELECT CAST(id % {K} AS INTEGER) AS k, {', '.join(R(f'avg({c})') + ' AS c_' + c for c in POINT4)}
            FROM pts GROUP BY 1)"""


def _dist_sql(prefix: str = "") -> str:
    terms = [f"({prefix}{c} - c_{c}) * ({prefix}{c} - c_{c})" for c in POINT4]
    expr = terms[0]
    for tm in terms[1:]:
        expr = f"({expr} + {tm})"
    return expr


def cluster_sql(frame: str) -> str:
    return (f"SELECT f.id, arg_min(k, ({_dist_sql('f.')}, k)) AS pickup_dropoff_loc "
            f"FROM {frame} f, centers GROUP BY f.id")


CLUSTER_SQL = f"""{CENTERS_SQL},
train_cl AS (SELECT train.*, c.pickup_dropoff_loc FROM train JOIN ({cluster_sql('train')}) c USING (id)),
test_cl AS (SELECT test.*, c.pickup_dropoff_loc FROM test JOIN ({cluster_sql('test')}) c USING (id))"""


def derived_centers(train: DataFrame, test: DataFrame) -> list[list[float]]:
    """Centres: rounded mean point of each ``id % K`` group of both splits
    (K x 4 numbers reach the driver)."""
    pts = train.select("id", *POINT4).unionByName(test.select("id", *POINT4))
    rows = (pts.groupBy((F.col("id") % K).cast("int").alias("k"))
            .agg(*[rnd(F.avg(c)).alias(c) for c in POINT4]).collect())
    rows = sorted(rows, key=lambda r: r["k"])
    return [[r[c] for c in POINT4] for r in rows]


def with_clusters(t):
    train, test = splits(t)
    centers = derived_centers(train, test)
    loc = ml.assign_nearest(POINT4, centers).cast("int").alias("pickup_dropoff_loc")
    return train.select("*", loc), test.select("*", loc)


# --- geo and time features (F12-F15, T02-T06, P14) ---------------------------------------------


def geo_time(df: DataFrame) -> DataFrame:
    p = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    return df.select(
        "*",
        geo.haversine(*p).alias("distance_haversine"),
        geo.manhattan(*p).alias("distance_dummy_manhattan"),
        geo.bearing(*p).alias("direction"),
        timefn.to_date("pickup_datetime").alias("pickup_date"),
        timefn.month("pickup_datetime").alias("Month"),
        timefn.hour("pickup_datetime").alias("Hour"),
        timefn.dow_monday0("pickup_datetime").alias("dayofweek"),
        timefn.hour_of_week("pickup_datetime").alias("hourofweek"),
        clean.isin_flag(timefn.to_date("pickup_datetime"), EVENT_DAYS_1997).alias("extreme_weather"))


def with_speeds(train: DataFrame) -> DataFrame:
    return train.select("*", geo.speed("distance_haversine", "trip_duration").alias("avg_speed_h"),
                        geo.speed("distance_dummy_manhattan", "trip_duration").alias("avg_speed_m"))


def features(t):
    """Train / test with clusters, geo, time and speed columns."""
    train, test = with_clusters(t)
    return with_speeds(geo_time(train)), geo_time(test)


HAV = ("2 * 6371 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) * 0.5), 2) + "
       "cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) * 0.5), 2)))")


def hav(lat1, lng1, lat2, lng2):
    return HAV.format(lat1=lat1, lng1=lng1, lat2=lat2, lng2=lng2)


GEO_SQL = f"""
geo_train AS (
  SELECT *,
    {hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')} AS distance_haversine,
    {hav('pickup_latitude', 'pickup_longitude', 'pickup_latitude', 'dropoff_longitude')} +
    {hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'pickup_longitude')} AS distance_dummy_manhattan,
    CAST(hour(pickup_datetime) AS INTEGER) AS Hour,
    CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS dayofweek,
    CAST((isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS INTEGER) AS hourofweek,
    CAST(month(pickup_datetime) AS INTEGER) AS Month
  FROM train_cl),
speed AS (
  SELECT *, 1000 * distance_haversine / NULLIF(CAST(trip_duration AS DOUBLE), 0) AS avg_speed_h,
            1000 * distance_dummy_manhattan / NULLIF(CAST(trip_duration AS DOUBLE), 0) AS avg_speed_m
  FROM geo_train),
geo_test AS (
  SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS Hour,
    CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS dayofweek,
    CAST((isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS INTEGER) AS hourofweek
  FROM test_cl)"""

ALL_SQL = f"WITH {TRIPS_SQL}, {CLUSTER_SQL}, {GEO_SQL}"


@query("P04_drop_outliers", f"""WITH {TRIPS_SQL}
SELECT id, trip_duration, {R('log_trip_duration')} AS log_trip_duration FROM train""")
def p04_drop_outliers(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return finish(train.select("id", "trip_duration", "log_trip_duration"))


@query("F09_log1p", f"WITH {TRIPS_SQL} SELECT id, {R('ln(1 + trip_duration)')} AS log_trip_duration FROM train_raw")
def f09_log1p(spark, sf_dir):
    tr = trips(T(spark, sf_dir)).where(~F.col("is_test"))
    return finish(tr.select("id", F.log1p("trip_duration").alias("log_trip_duration")))


@query("F10_expm1", f"WITH {TRIPS_SQL} SELECT id, {R('exp(ln(1 + trip_duration)) - 1', 3)} AS trip_duration_back FROM train_raw")
def f10_expm1(spark, sf_dir):
    tr = trips(T(spark, sf_dir)).where(~F.col("is_test"))
    return finish(tr.select("id", F.expm1(F.log1p("trip_duration")).alias("trip_duration_back")), 3)


@query("F12_haversine", f"""WITH {TRIPS_SQL}
SELECT id, {R(hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude'))} AS distance_haversine FROM trips""")
def f12_haversine(spark, sf_dir):
    return finish(trips(T(spark, sf_dir)).select("id", geo.haversine(*POINT4).alias("distance_haversine")))


@query("F13_manhattan", f"""WITH {TRIPS_SQL}
SELECT id, {R(hav('pickup_latitude', 'pickup_longitude', 'pickup_latitude', 'dropoff_longitude') + ' + ' + hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'pickup_longitude'))} AS distance_dummy_manhattan FROM trips""")
def f13_manhattan(spark, sf_dir):
    return finish(trips(T(spark, sf_dir)).select("id", geo.manhattan(*POINT4).alias("distance_dummy_manhattan")))


@query("F14_bearing", f"""WITH {TRIPS_SQL}
SELECT id, {R('degrees(atan2(sin(radians(dropoff_longitude - pickup_longitude)) * cos(radians(dropoff_latitude)), '
              'cos(radians(pickup_latitude)) * sin(radians(dropoff_latitude)) - sin(radians(pickup_latitude)) * '
              'cos(radians(dropoff_latitude)) * cos(radians(dropoff_longitude - pickup_longitude))))')} AS direction FROM trips""")
def f14_bearing(spark, sf_dir):
    return finish(trips(T(spark, sf_dir)).select("id", geo.bearing(*POINT4).alias("direction")))


@query("F15_speed", f"""{ALL_SQL}
SELECT id, {R('avg_speed_h')} AS avg_speed_h, {R('avg_speed_m')} AS avg_speed_m FROM speed""")
def f15_speed(spark, sf_dir):
    train, _ = features(T(spark, sf_dir))
    return finish(train.select("id", "avg_speed_h", "avg_speed_m"))


@query("T01_parse_timestamp", f"""WITH {TRIPS_SQL}
SELECT id, {TS("strptime(strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')")} AS pickup_parsed
FROM trips""")
def t01_parse_timestamp(spark, sf_dir):
    s = F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    return trips(T(spark, sf_dir)).select("id", ts_text(timefn.parse_ts(s)).alias("pickup_parsed"))


# Date results are compared as ISO 'yyyy-MM-dd' text on both sides, so the
# check does not depend on how each engine's DATE type reaches the client.
@query("T02_to_date", f"WITH {TRIPS_SQL} SELECT id, strftime(CAST(pickup_datetime AS DATE), '%Y-%m-%d') AS pickup_date FROM trips")
def t02_to_date(spark, sf_dir):
    d = timefn.to_date("pickup_datetime")
    return trips(T(spark, sf_dir)).select("id", F.date_format(d, "yyyy-MM-dd").alias("pickup_date"))


@query("T03_month", f"WITH {TRIPS_SQL} SELECT id, CAST(month(pickup_datetime) AS INTEGER) AS Month FROM trips")
def t03_month(spark, sf_dir):
    return trips(T(spark, sf_dir)).select("id", timefn.month("pickup_datetime").alias("Month"))


@query("T04_hour", f"WITH {TRIPS_SQL} SELECT id, CAST(hour(pickup_datetime) AS INTEGER) AS Hour FROM trips")
def t04_hour(spark, sf_dir):
    return trips(T(spark, sf_dir)).select("id", timefn.hour("pickup_datetime").alias("Hour"))


@query("T05_dow_monday0", f"WITH {TRIPS_SQL} SELECT id, CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS dayofweek FROM trips")
def t05_dow_monday0(spark, sf_dir):
    return trips(T(spark, sf_dir)).select("id", timefn.dow_monday0("pickup_datetime").alias("dayofweek"))


@query("T06_hour_of_week", f"""WITH {TRIPS_SQL}
SELECT id, CAST((isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS INTEGER) AS hourofweek FROM trips""")
def t06_hour_of_week(spark, sf_dir):
    return trips(T(spark, sf_dir)).select("id", timefn.hour_of_week("pickup_datetime").alias("hourofweek"))


@query("T07_round_half_even", f"""WITH {TRIPS_SQL}
SELECT id, {TS("make_timestamp(CAST(round_even(epoch_us(pickup_datetime) / 3600000000.0, 0) * 3600000000 AS BIGINT))")}
       AS pickup_datetime_group FROM trips""")
def t07_round_half_even(spark, sf_dir):
    return trips(T(spark, sf_dir)).select(
        "id", ts_text(timefn.round_to_minutes("pickup_datetime", 60)).alias("pickup_datetime_group"))


@query("T08_parse_yyyymmdd", f"""WITH {TRIPS_SQL}
SELECT id, strftime(CAST(strptime(strftime(pickup_datetime, '%Y%m%d'), '%Y%m%d') AS DATE), '%Y-%m-%d') AS pickup_day
FROM trips""")
def t08_parse_yyyymmdd(spark, sf_dir):
    s = F.date_format("pickup_datetime", "yyyyMMdd")
    d = timefn.parse_yyyymmdd(s)
    return trips(T(spark, sf_dir)).select("id", F.date_format(d, "yyyy-MM-dd").alias("pickup_day"))


def _days_sql():
    return ", ".join(f"DATE '{d.isoformat()}'" for d in EVENT_DAYS_1997)


@query("P14_isin_flag", f"""WITH {TRIPS_SQL}
SELECT id, CAST(CAST(pickup_datetime AS DATE) IN ({_days_sql()}) AS INTEGER) AS extreme_weather FROM trips""")
def p14_isin_flag(spark, sf_dir):
    return trips(T(spark, sf_dir)).select(
        "id", clean.isin_flag(timefn.to_date("pickup_datetime"), EVENT_DAYS_1997).alias("extreme_weather"))


@query("M02_assign_nearest", f"""WITH {TRIPS_SQL}, {CLUSTER_SQL}
SELECT id, pickup_dropoff_loc FROM train_cl UNION ALL SELECT id, pickup_dropoff_loc FROM test_cl""")
def m02_assign_nearest(spark, sf_dir):
    train, test = with_clusters(T(spark, sf_dir))
    return train.select("id", "pickup_dropoff_loc").unionByName(test.select("id", "pickup_dropoff_loc"))


def _loc_flags_sql(src: str) -> str:
    return ", ".join(f"CAST(pickup_dropoff_loc = {i} AS INTEGER) AS loc_{i}" for i in range(K))


@query("E02_one_hot_prefix", f"""WITH {TRIPS_SQL}, {CLUSTER_SQL}
SELECT id, {", ".join(f"CAST(pickup_dropoff_loc = {i} AS BIGINT) AS loc_{i}" for i in range(K))} FROM train_cl""")
def e02_one_hot_prefix(spark, sf_dir):
    train, _ = with_clusters(T(spark, sf_dir))
    # every cluster gets a column, so the schema does not hang on the rows
    out = encode.one_hot(train.select("id", "pickup_dropoff_loc"), {"pickup_dropoff_loc": [str(i) for i in range(K)]},
                         prefix={"pickup_dropoff_loc": "loc"})
    return out.select("id", *[F.col(c).cast("long") for c in out.columns if c != "id"])


@query("U03_column_concat", f"""{ALL_SQL}
SELECT id, {R('distance_haversine')} AS distance_haversine, Hour, {_loc_flags_sql('speed')} FROM speed""")
def u03_column_concat(spark, sf_dir):
    train, _ = features(T(spark, sf_dir))
    cats = {"pickup_dropoff_loc": [str(i) for i in range(K)]}
    out = encode.one_hot(train.select("id", "distance_haversine", "Hour", "pickup_dropoff_loc"), cats,
                         prefix={"pickup_dropoff_loc": "loc"})
    return finish(out)


# --- target-mean encodings (E06, J03), grouped stats with HAVING (A11, J04) --------------------------
GBY = ["Hour", "hourofweek", "dayofweek", "pickup_dropoff_loc"]


def encodings(train: DataFrame, test: DataFrame):
    """E06 + J03: speed means by hour, hour of week, day and cluster, fitted
    on train in one pass and joined onto both splits."""
    return tuple(encode.apply_target_means([train, test], train, GBY, ["avg_speed_h", "avg_speed_m"]))


@query("E06_target_mean", f"""{ALL_SQL}
SELECT Hour, {R('avg(avg_speed_h)')} AS avg_speed_h_gby_Hour, {R('avg(avg_speed_m)')} AS avg_speed_m_gby_Hour
FROM speed GROUP BY Hour""")
def e06_target_mean(spark, sf_dir):
    train, _ = features(T(spark, sf_dir))
    return finish(encode.target_mean(train, "Hour", ["avg_speed_h", "avg_speed_m"]))


def _j03_sql():
    ctes, joins, cols = [], [], []
    for i, key in enumerate(GBY):
        ctes.append(f"g{i} AS (SELECT {key}, avg(avg_speed_h) AS h, avg(avg_speed_m) AS m FROM speed "
                    f"WHERE {key} IS NOT NULL GROUP BY {key})")
        joins.append(f"LEFT JOIN g{i} ON t.{key} = g{i}.{key}")
        cols += [f"{R(f'g{i}.h')} AS avg_speed_h_gby_{key}", f"{R(f'g{i}.m')} AS avg_speed_m_gby_{key}"]
    return f"{ALL_SQL}, {', '.join(ctes)} SELECT t.id, {', '.join(cols)} FROM geo_test t {' '.join(joins)}"


@query("J03_join_fitted_stats", _j03_sql())
def j03_join_fitted_stats(spark, sf_dir):
    train, test = features(T(spark, sf_dir))
    _, test = encodings(train, test)
    cols = [f"{m}_gby_{k}" for k in GBY for m in ("avg_speed_h", "avg_speed_m")]
    return finish(test.select("id", *cols))


def coord_stats(train: DataFrame, min_count: int | None = 100) -> DataFrame:
    keys = ["Hour", "pickup_dropoff_loc"]
    # groups with a missing key hold exactly the rows with that missing key,
    # so dropping them after the aggregate equals filtering rows first
    # and evaluates the computed keys once
    stats = (train.groupBy(*keys).agg(F.avg("avg_speed_h").alias("avg_speed_h_Hour_pickup_dropoff_loc"),
                                      F.count("id").alias("cnt_Hour_pickup_dropoff_loc"))
             .where(F.col("Hour").isNotNull() & F.col("pickup_dropoff_loc").isNotNull()))
    if min_count is not None:
        stats = stats.where(F.col("cnt_Hour_pickup_dropoff_loc") > min_count)
    return stats


_COORD_SQL = f"""{ALL_SQL}
SELECT Hour, pickup_dropoff_loc, {R('avg(avg_speed_h)')} AS avg_speed_h_Hour_pickup_dropoff_loc,
       count(id) AS cnt_Hour_pickup_dropoff_loc
FROM speed GROUP BY Hour, pickup_dropoff_loc"""


@query("J04_inner_join_aggregates", _COORD_SQL)
def j04_inner_join_aggregates(spark, sf_dir):
    """Two aggregates of one grouping, joined.  Both are dealt by the same
    keys, so the join shuffles nothing again; rows with a missing key form a
    group that meets none (C3)."""
    train, _ = features(T(spark, sf_dir))
    keys = ["Hour", "pickup_dropoff_loc"]
    speeds = train.groupBy(*keys).agg(F.avg("avg_speed_h").alias("avg_speed_h_Hour_pickup_dropoff_loc"))
    counts = train.groupBy(*keys).agg(F.count("id").alias("cnt_Hour_pickup_dropoff_loc"))
    return finish(speeds.join(counts, keys, "inner"))


@query("A11_having_count", _COORD_SQL + " HAVING count(id) > 100")
def a11_having_count(spark, sf_dir):
    train, _ = features(T(spark, sf_dir))
    return finish(coord_stats(train, 100))


@query("A11_having_supplier", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600")
def a11_having_supplier(spark, sf_dir):
    return (T(spark, sf_dir).lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 600))


# --- side table, unions, PCA (J05, U01, U02, M04) ---------------------------------------------------
ROUTES_SQL = """
routes AS (SELECT l_orderkey AS id, sum(l_quantity) AS total_distance,
                  sum(l_extendedprice) / 1000 AS total_travel_time, count(*) AS number_of_steps
           FROM lineitem GROUP BY l_orderkey)"""


def routes(t) -> DataFrame:
    return (t.lineitem.groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.sum("l_quantity").alias("total_distance"),
                 (F.sum("l_extendedprice") / 1000).alias("total_travel_time"),
                 F.count(F.lit(1)).alias("number_of_steps")))


@query("J05_left_join_side_table", f"""WITH {TRIPS_SQL}, {ROUTES_SQL}
SELECT t.id, {R('r.total_distance')} AS total_distance, {R('r.total_travel_time')} AS total_travel_time,
       CAST(r.number_of_steps AS DOUBLE) AS number_of_steps FROM train t LEFT JOIN routes r ON t.id = r.id""")
def j05_left_join_side_table(spark, sf_dir):
    t = T(spark, sf_dir)
    train, _ = splits(t)
    out = train.select("id").join(routes(t), on="id", how="left")
    # a nullable count is compared as double on both sides
    return finish(out.withColumn("number_of_steps", F.col("number_of_steps").cast("double")))


@query("U01_union_all", f"""WITH {TRIPS_SQL}
SELECT id, 'train' AS split, CAST(trip_duration AS DOUBLE) AS trip_duration FROM train
UNION ALL SELECT id, 'test' AS split, CAST(NULL AS DOUBLE) AS trip_duration FROM test""")
def u01_union_all(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    a = train.select("id", F.lit("train").alias("split"), F.col("trip_duration").cast("double"))
    b = test.select("id", F.lit("test").alias("split"))
    return a.unionByName(b, allowMissingColumns=True)


def points(train: DataFrame, test: DataFrame) -> DataFrame:
    """Pickup and dropoff points of both splits as one (lat, lng) set."""
    out = None
    for df in (train, test):
        for p in ("pickup", "dropoff"):
            part = df.select(F.col(f"{p}_latitude").alias("lat"), F.col(f"{p}_longitude").alias("lng"))
            out = part if out is None else out.unionByName(part)
    return out


_PTS_SQL = """pts2 AS (
  SELECT pickup_latitude AS lat, pickup_longitude AS lng FROM train
  UNION ALL SELECT dropoff_latitude, dropoff_longitude FROM train
  UNION ALL SELECT pickup_latitude, pickup_longitude FROM test
  UNION ALL SELECT dropoff_latitude, dropoff_longitude FROM test)"""


@query("U02_stack_points", f"WITH {TRIPS_SQL}, {_PTS_SQL} SELECT {R('lat')} AS lat, {R('lng')} AS lng FROM pts2")
def u02_stack_points(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    return finish(points(train, test))


def pca_manhattan(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    fit = ml.pca2_fit(points(train, test), "lat", "lng")
    out = []
    for df in (train, test):
        p0, p1 = ml.pca2_transform(fit, "pickup_latitude", "pickup_longitude")
        d0, d1 = ml.pca2_transform(fit, "dropoff_latitude", "dropoff_longitude")
        df = df.select("*", p0.alias("pickup_pca0"), p1.alias("pickup_pca1"),
                       d0.alias("dropoff_pca0"), d1.alias("dropoff_pca1"))
        out.append(df.withColumn("pca_manhattan", geo.l1("pickup_pca0", "pickup_pca1",
                                                         "dropoff_pca0", "dropoff_pca1")))
    return out[0], out[1]


@query("M04_pca_manhattan", f"""WITH {TRIPS_SQL}, {_PTS_SQL},
fit AS (SELECT 0.5 * atan2(2 * covar_pop(lat, lng), var_pop(lat) - var_pop(lng)) AS th FROM pts2)
SELECT id, {R('abs((dropoff_latitude - pickup_latitude) * cos(th) + (dropoff_longitude - pickup_longitude) * sin(th))'
              ' + abs(-(dropoff_latitude - pickup_latitude) * sin(th) + (dropoff_longitude - pickup_longitude) * cos(th))')}
       AS pca_manhattan
FROM (SELECT id, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude FROM train
      UNION ALL SELECT id, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude FROM test), fit""")
def m04_pca_manhattan(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    a, b = pca_manhattan(train, test)
    return finish(a.select("id", "pca_manhattan").unionByName(b.select("id", "pca_manhattan")))


# --- chart data (D14, D15) ---------------------------------------------------------------------------
@query("D14_train_test_distribution", f"""WITH {TRIPS_SQL}, {CLUSTER_SQL}
SELECT pickup_dropoff_loc, count(*) FILTER (WHERE split = 'train') AS train,
       count(*) FILTER (WHERE split = 'test') AS test
FROM (SELECT pickup_dropoff_loc, 'train' AS split FROM train_cl
      UNION ALL SELECT pickup_dropoff_loc, 'test' AS split FROM test_cl) GROUP BY pickup_dropoff_loc""")
def d14_train_test_distribution(spark, sf_dir):
    train, test = with_clusters(T(spark, sf_dir))
    tagged = (train.select("pickup_dropoff_loc", F.lit("train").alias("split"))
              .unionByName(test.select("pickup_dropoff_loc", F.lit("test").alias("split"))))
    return (tagged.groupBy("pickup_dropoff_loc").pivot("split", ["train", "test"]).count()
            .fillna(0, ["train", "test"]))


@query("D15_mean_by_time_part", f"""{ALL_SQL}
SELECT 'Hour' AS part, Hour AS value, {R('avg(avg_speed_m)')} AS mean_speed FROM speed GROUP BY Hour
UNION ALL SELECT 'dayofweek', dayofweek, {R('avg(avg_speed_m)')} FROM speed GROUP BY dayofweek
UNION ALL SELECT 'Month', Month, {R('avg(avg_speed_m)')} FROM speed GROUP BY Month""")
def d15_mean_by_time_part(spark, sf_dir):
    train, _ = features(T(spark, sf_dir))
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("value")) for p in ("Hour", "dayofweek", "Month")])
    return finish(train.select(F.explode(parts).alias("p"), "avg_speed_m").groupBy("p.part", "p.value")
                  .agg(F.avg("avg_speed_m").alias("mean_speed")))


# --- regression metrics on a deterministic predictor (V02-V04) ----------------------------------------
# The prediction is the duration implied by the trip's distance and the mean
# speed of its pickup hour (an E06 encoding), so it is reproducible.
PRED_SQL = f"""{ALL_SQL},
hourly AS (SELECT Hour, avg(avg_speed_h) AS sp FROM speed GROUP BY Hour),
pred AS (SELECT s.id, CAST(s.trip_duration AS DOUBLE) AS actual,
                1000 * s.distance_haversine / NULLIF(h.sp, 0) AS predicted
         FROM speed s JOIN hourly h USING (Hour))"""


def predictions(t) -> DataFrame:
    train, _ = features(t)
    stats = encode.target_mean(train, "Hour", ["avg_speed_h"])
    return (join_measured(train, stats, "Hour", "inner")
            .select("id", F.col("trip_duration").cast("double").alias("actual"),
                    ratio(F.col("distance_haversine") * 1000, "avg_speed_h_gby_Hour").alias("predicted")))


@query("V02_rmsle", f"""{PRED_SQL}
SELECT {R('sqrt(avg(pow(ln(1 + predicted) - ln(1 + actual), 2)))')} AS rmsle, count(*) AS n
FROM pred WHERE predicted IS NOT NULL""")
def v02_rmsle(spark, sf_dir):
    from ..operators.metrics import rmsle
    return finish(rmsle(predictions(T(spark, sf_dir)), "predicted", "actual"))


@query("V03_rmse_log", f"""{PRED_SQL}
SELECT {R('sqrt(avg(pow(ln(1 + predicted) - ln(1 + actual), 2)))')} AS rmse, count(*) AS n
FROM pred WHERE predicted IS NOT NULL""")
def v03_rmse_log(spark, sf_dir):
    from ..operators.metrics import rmse
    p = predictions(T(spark, sf_dir)).select(F.log1p("predicted").alias("p"), F.log1p("actual").alias("a"))
    return finish(rmse(p, "p", "a"))


@query("V04_r2", f"""{PRED_SQL}
SELECT {R('1 - sum(pow(ln(1 + actual) - ln(1 + predicted), 2)) / (count(*) * var_pop(ln(1 + actual)))')} AS r2,
       count(*) AS n
FROM pred WHERE predicted IS NOT NULL""")
def v04_r2(spark, sf_dir):
    from ..operators.metrics import r2
    p = predictions(T(spark, sf_dir)).select(F.log1p("predicted").alias("p"), F.log1p("actual").alias("a"))
    return finish(r2(p, "p", "a"))


@query("F16_l1_distance", f"""WITH {TRIPS_SQL}
SELECT id, {R('abs(dropoff_latitude - pickup_latitude) + abs(dropoff_longitude - pickup_longitude)')} AS l1 FROM trips""")
def f16_l1_distance(spark, sf_dir):
    return finish(trips(T(spark, sf_dir)).select(
        "id", geo.l1("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude").alias("l1")))
