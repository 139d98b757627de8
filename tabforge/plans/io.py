"""CSV round trips (S01-S04): driver tables written as CSV to the shared
folder, then read back through the scan operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources import csv
from . import passenger, trip
from .common import R, T, finish, query

PASS_SCHEMA = ("PassengerId long, Pclass int, Name string, Sex string, Age double, SibSp int, "
               "Parch int, Fare double, Embarked string, Survived int")
ROUTES_SCHEMA = "id long, total_distance double, total_travel_time double, number_of_steps long"


def _fresh(spark, name: str) -> str:
    return shared_path(spark, f"io/{name}/{uuid.uuid4().hex}")


def _passenger_csvs(spark, sf_dir) -> list[tuple[str, str, str]]:
    """Both splits as CSV: (split, path, schema); the test split has no label."""
    out = []
    for name, split in zip(("train", "test"), passenger.splits(T(spark, sf_dir)), strict=True):
        path = csv.write_csv(split, _fresh(spark, f"passengers_{name}"))
        out.append((name, path, PASS_SCHEMA if name == "train" else PASS_SCHEMA.removesuffix(", Survived int")))
    return out


def _both(frames) -> DataFrame:
    train, test = frames
    return train.unionByName(test, allowMissingColumns=True)


_SPLIT_SQL = "SELECT 'train' AS split, {} FROM ptrain UNION ALL SELECT 'test', {} FROM ptest"
_PASS_COLS = "PassengerId, Pclass, Name, Sex, Age, SibSp, Parch, Fare, Embarked"


@query("S01_csv_scan", f"WITH {passenger.PASS_SQL} "
       + _SPLIT_SQL.format(f"{_PASS_COLS}, CAST(Survived AS DOUBLE) AS Survived", f"{_PASS_COLS}, NULL"))
def s01_csv_scan(spark, sf_dir):
    out = _both(csv.read_csv(spark, path, schema).select(F.lit(name).alias("split"), "*")
                for name, path, schema in _passenger_csvs(spark, sf_dir))
    return out.withColumn("Survived", F.col("Survived").cast("double"))


@query("S02_csv_pruned_scan", f"WITH {passenger.PASS_SQL} " + _SPLIT_SQL.format("PassengerId, Name, Fare", "PassengerId, Name, Fare"))
def s02_csv_pruned_scan(spark, sf_dir):
    return _both(csv.read_csv(spark, path, schema, usecols=["PassengerId", "Name", "Fare"]).select(F.lit(name).alias("split"), "*")
                 for name, path, schema in _passenger_csvs(spark, sf_dir))


@query("S03_csv_multi_part", f"""WITH {trip.ROUTES_SQL}
SELECT id, {R('total_distance')} AS total_distance, {R('total_travel_time')} AS total_travel_time, number_of_steps
FROM routes""")
def s03_csv_multi_part(spark, sf_dir):
    r = trip.routes(T(spark, sf_dir))
    p1, p2 = _fresh(spark, "routes_part1"), _fresh(spark, "routes_part2")
    csv.write_csv(r.where(F.col("id") % 2 == 0), p1)
    csv.write_csv(r.where(F.col("id") % 2 == 1), p2)
    return finish(csv.read_csv(spark, [p1, p2], ROUTES_SCHEMA))


@query("S04_prediction_sink", f"""{trip.ALL_SQL},
hourly AS (SELECT Hour, avg(avg_speed_h) AS sp FROM speed GROUP BY Hour),
geo_t AS (SELECT id, Hour, {trip.hav('pickup_latitude', 'pickup_longitude', 'dropoff_latitude', 'dropoff_longitude')} AS d
          FROM geo_test)
SELECT id, {R('1000 * d / NULLIF(sp, 0)', 3)} AS trip_duration FROM geo_t JOIN hourly USING (Hour)""")
def s04_prediction_sink(spark, sf_dir):
    from ..operators import encode
    from ..functions.contract import ratio
    train, test = trip.features(T(spark, sf_dir))
    stats = encode.target_mean(train, "Hour", ["avg_speed_h"])
    from ..operators.joins import join_measured
    pred = join_measured(test, stats, "Hour", "inner").select(
        "id", ratio(F.col("distance_haversine") * 1000, "avg_speed_h_gby_Hour").alias("trip_duration"))
    path = _fresh(spark, "submission")
    csv.write_predictions(pred, "id", "trip_duration", path)
    return finish(csv.read_csv(spark, path, "id long, trip_duration double"), 3)
