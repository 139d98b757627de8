"""Model queries (M01-M16, O04 on importances).

Fits and seeded draws cannot be compared value by value with SQL, so
these queries are checked by row count; each returns a small, sorted
table.  Estimator settings follow the parameter maps of the reference
trainers (``operators.ml``); where a grid or curve needs many fits the
fold count is kept small and stated.
"""

from __future__ import annotations

import re
import uuid

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import boosting, metrics, ml, profile
from ..session import shared_path, written
from . import cover, loans, passenger, trip
from .common import R, T, finish, query

# --- folds, samples, splits (M03, M05, M06) ---------------------------------------------------


@query("M06_fold_assignment", "SELECT CAST(c_custkey % 5 AS INTEGER) AS fold, count(*) AS n FROM customer GROUP BY 1")
def m06_fold_assignment(spark, sf_dir):
    c = T(spark, sf_dir).customer
    return c.select(ml.fold_col("c_custkey", 5).alias("fold")).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("M06_shuffled_folds", f"""SELECT CAST({ml.id_hash_sql('c_custkey', 1024)} % 5 AS INTEGER) AS fold, count(*) AS n
FROM customer GROUP BY 1""")
def m06_shuffled_folds(spark, sf_dir):
    c = T(spark, sf_dir).customer
    return (c.select(ml.fold_col("c_custkey", 5, seed=1024).alias("fold")).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("fold"))


def _points4(t) -> DataFrame:
    train, test = trip.splits(t)
    return train.select("id", *trip.POINT4).unionByName(test.select("id", *trip.POINT4))


@query("M03_sample", f"""WITH {trip.TRIPS_SQL}, {trip.CENTERS_SQL}
SELECT id, {', '.join(f'{R(c)} AS {c}' for c in trip.POINT4)} FROM pts WHERE {ml.id_hash_sql('id', 0)} < {ml.HASH_RANGE // 2}""")
def m03_sample(spark, sf_dir):
    return finish(ml.sample(_points4(T(spark, sf_dir)), 0.5, seed=0, id_col="id"))


@query("M01_minibatch_kmeans")
def m01_minibatch_kmeans(spark, sf_dir):
    """Every point of both splits goes to its nearest centre: per cluster
    the centre and the points it has."""
    points = _points4(T(spark, sf_dir))
    centers = ml.mini_batch_kmeans(points, trip.POINT4, "id", k=20, batch=10_000, seed=1)
    rows = [(i, *c) for i, c in enumerate(centers)]
    found = spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in trip.POINT4))
    counts = points.groupBy(ml.assign_nearest(trip.POINT4, centers).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return found.join(counts, "cluster", "left").select("cluster", F.coalesce("n", F.lit(0)).alias("n"), *trip.POINT4)


@query("M01_kmeans")
def m01_kmeans(spark, sf_dir):
    model = ml.kmeans_fit(_points4(T(spark, sf_dir)), trip.POINT4, k=20, seed=1)
    rows = [(i, *c) for i, c in enumerate(ml.centers_of(model))]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in trip.POINT4))


@query("M05_split", f"""WITH {passenger.PASS_SQL}
SELECT CASE WHEN {ml.id_hash_sql('PassengerId', 33)} < {ml.HASH_RANGE // 4} THEN 'holdout' ELSE 'train' END AS part, count(*) AS n
FROM ptrain GROUP BY 1""")
def m05_split(spark, sf_dir):
    train, _ = passenger.splits(T(spark, sf_dir))
    fit, hold = ml.split(train, "PassengerId", 0.25, seed=33)
    return (fit.select(F.lit("train").alias("part")).unionByName(hold.select(F.lit("holdout").alias("part")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n")))


# --- credit: boosted classifier, out-of-fold scores (M07, M10) ----------------------------------------


def _credit_gbm(rounds: int):
    return ml.gbt_classifier(label="TARGET", **{**ml.CREDIT_GBM, "maxIter": rounds})


def credit_frame(t) -> tuple[DataFrame, list[str]]:
    """The training split of the assembled matrix and its features."""
    train, _, names = loans.matrix(t)
    plain = {n: re.sub(r"\W", "_", n) for n in names}
    return train.withColumnsRenamed(plain).withColumn("TARGET", F.col("TARGET").cast("double")), list(plain.values())


@query("M07_gbt_classifier")
def m07_gbt_classifier(spark, sf_dir):
    """Early stopping on the held-out fifth with the program's patience of
    ten rounds; the model is the one of its best round."""
    data, names = credit_frame(T(spark, sf_dir))
    data = boosting.compact(data.withColumn("is_valid", ml.fold_col(loans.KEY, 5, seed=1024) == 0), fits=1)
    prep = ml.fit_features(data.where(~F.col("is_valid")), names)
    rows = prep.transform(data)
    model, _ = boosting.fit_with_patience(_credit_gbm, rows.where(~F.col("is_valid")), rows.where("is_valid"), patience=10,
                                          max_rounds=ml.CREDIT_GBM["maxIter"], label="TARGET")
    scored = ml.positive_probability(model.transform(rows))
    return scored.select(F.col(loans.KEY).alias("c_custkey"), "is_valid", "score").orderBy("c_custkey")


@query("M10_out_of_fold")
def m10_out_of_fold(spark, sf_dir):
    """Out-of-fold scores on the assembled matrix, with the rounds of the
    model that gave them and their ROC AUC over all folds (V01)."""
    data, names = credit_frame(T(spark, sf_dir))
    data = data.withColumn("fold", ml.fold_col(loans.KEY, 5, seed=1024))
    oof = written(boosting.out_of_fold(data, names, _credit_gbm, "fold", 5, loans.KEY, "TARGET", patience=10,
                                       max_rounds=ml.CREDIT_GBM["maxIter"]), "out-of-fold")
    total = metrics.auc(oof, "score", "TARGET").select("auc")       # one row
    return oof.join(F.broadcast(total)).select(F.col(loans.KEY).alias("c_custkey"), F.col("TARGET").alias("label"), "score",
                                               "rounds", "auc").orderBy("c_custkey")


# --- trip: boosted regressor on the log target, prediction file (M08, M16) ---------------------------


def trip_frame(t):
    train, test = trip.features(t)
    train, test = trip.encodings(train, test)
    routes = trip.routes(t)
    stats = trip.coord_stats(train, 100)
    train, test = trip.pca_manhattan(train, test)
    from ..operators.joins import join_measured
    train = join_measured(train.join(routes, "id", "left"), stats, ["Hour", "pickup_dropoff_loc"], "left")
    test = join_measured(test.join(routes, "id", "left"), stats, ["Hour", "pickup_dropoff_loc"], "left")
    feats = ["vendor_id", "distance_haversine", "distance_dummy_manhattan", "direction", "Month", "Hour",
             "dayofweek", "hourofweek", "extreme_weather", "pickup_dropoff_loc",
             "total_distance", "total_travel_time", "number_of_steps",
             "avg_speed_h_Hour_pickup_dropoff_loc", "cnt_Hour_pickup_dropoff_loc",
             "pickup_pca0", "pickup_pca1", "dropoff_pca0", "dropoff_pca1", "pca_manhattan"]
    feats += [f"{m}_gby_{k}" for k in trip.GBY for m in ("avg_speed_h", "avg_speed_m")]
    cast = [F.col(c).cast("double").alias(c) for c in feats]
    train = train.select("id", F.col("log_trip_duration").alias("label"), *cast)
    test = test.select("id", *cast)
    return train, test, feats


@query("M08_gbt_regressor")
def m08_gbt_regressor(spark, sf_dir):
    train, test, feats = trip_frame(T(spark, sf_dir))
    fit, _ = ml.split(boosting.compact(train, fits=1), "id", 0.2, seed=33)
    prep = ml.fit_features(fit, feats)             # means of the fitted rows, applied to all others
    # All rounds: the program's patience is longer than its rounds.
    model = boosting.fit_all_rounds(ml.gbt_regressor(**ml.TRIP_GBM), prep.transform(fit))
    scored = model.transform(prep.transform(test))
    return scored.select("id", F.expm1("prediction").alias("trip_duration")).orderBy("id")


# --- cover: forest, importances, top-k (M09, M15, O04) ---------------------------------------------


def cover_model(t, trees: int = 150):
    df = cover.cover_features(cover.train_split(t))
    names = cover.feature_columns(df)
    data = ml.assemble(df.withColumn("label", F.col("Cover_Type").cast("double")), names)
    return ml.fit_forest(ml.random_forest(trees=trees, max_depth=ml.DEEP, seed=0), boosting.compact(data)), names


@query("M09_random_forest")
def m09_random_forest(spark, sf_dir):
    t = T(spark, sf_dir)
    model, names = cover_model(t)
    test = cover.cover_features(cover.cover(t).where(F.col("is_test")).drop("is_test"))
    scored = model.transform(ml.assemble(test, names))
    return scored.select("Id", F.col("prediction").cast("int").alias("Cover_Type")).orderBy("Id")


@query("M15_importances")
def m15_importances(spark, sf_dir):
    model, names = cover_model(T(spark, sf_dir))
    return ml.importances(model, names).orderBy(F.desc("importance"), "feature")


@query("O04_top_k_importance")
def o04_top_k_importance(spark, sf_dir):
    model, names = cover_model(T(spark, sf_dir), trees=250)
    return profile.top_k_share(ml.importances(model, names), "importance", 15, tie="feature")


# --- passenger: CV, grid, curves, submission (M11-M14, M16) -------------------------------------------


def passenger_frame(t, folds: int = 10):
    train, test = passenger.splits(t)
    vt, vs = passenger.vectorize(passenger.prepare(train), passenger.prepare(test))
    labels = train.select("PassengerId", F.col("Survived").cast("double").alias("label"))
    names = [c for c in vt.columns if c != "PassengerId"]
    vt = ml.assemble(vt.join(labels, "PassengerId"), names)
    vt = vt.withColumn("fold", ml.fold_col("PassengerId", folds, seed=33))
    return vt, ml.assemble(vs, names), names


SIDE_BY_SIDE = 4        # fits of a grid or curve


def _stored(data: DataFrame, fits: int = SIDE_BY_SIDE) -> DataFrame:
    """What fits and scores read, stored once: not the columns that went
    into the feature vector."""
    return boosting.compact(data.select("PassengerId", "label", "fold", "features"), fits)


def _acc():
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")


@query("M11_cv_score")
def m11_cv_score(spark, sf_dir):
    data, _, _ = passenger_frame(T(spark, sf_dir), folds=10)
    cvm = ml.cross_validate(_stored(data, fits=1), ml.random_forest(trees=80, max_depth=3, seed=0), _acc(), "fold", 10)
    return spark.createDataFrame([("accuracy", float(cvm.avgMetrics[0]))], "metric string, mean double")


# The forest grid of the passenger program.  Depth has no bound
# there; the rows a node needs to be split have no counterpart, so a node's
# children get at least half of them.
FOREST_GRID = [{"max_features": f, "min_samples_split": s, "min_samples_leaf": leaf, "n_estimators": n}
               for f in (1, 3, 10) for s in (2, 3, 10) for leaf in (1, 3, 10) for n in (100, 300)]


def grid_forest(max_features: int, min_samples_split: int, min_samples_leaf: int, n_estimators: int):
    forest = ml.random_forest(trees=n_estimators, max_depth=ml.DEEP, seed=0)
    return forest.setFeatureSubsetStrategy(str(max_features)).setMinInstancesPerNode(max(min_samples_leaf, (min_samples_split + 1) // 2))


@query("M12_grid_search")
def m12_grid_search(spark, sf_dir):
    """Three folds over the points with 100 trees; ``ml.grid_scores`` with
    ``FOREST_GRID`` and ten folds is the whole search, which goes on where
    it was stopped."""
    data, _, _ = passenger_frame(T(spark, sf_dir), folds=3)
    points = [p for p in FOREST_GRID if p["n_estimators"] == 100 and p["min_samples_split"] == 2]
    path = shared_path(spark, f"grid/{uuid.uuid4().hex}")
    return ml.best_point(ml.grid_scores(_stored(data), grid_forest, points, _acc(), "fold", 3, path, SIDE_BY_SIDE))


@query("M13_learning_curve")
def m13_learning_curve(spark, sf_dir):
    data, _, _ = passenger_frame(T(spark, sf_dir), folds=10)
    return ml.learning_curve(_stored(data), lambda: ml.random_forest(trees=80, max_depth=3, seed=0), _acc(),
                             "fold", 10, "PassengerId")


@query("M14_validation_curve")
def m14_validation_curve(spark, sf_dir):
    data, _, _ = passenger_frame(T(spark, sf_dir), folds=10)
    data = _stored(data)
    rows = data.count() * 9 // 10
    make = lambda v: ml.gbt_classifier(**{**ml.PASSENGER_GBM, "minInfoGain": ml.gain_per_row(v, rows)})
    return ml.validation_curve(data, make, [0.5, 0.75, 1.0, 2.0, 3.0, 5.0], _acc(), "fold", 10, "gamma")


@query("M16_predict")
def m16_predict(spark, sf_dir):
    data, test, _ = passenger_frame(T(spark, sf_dir))
    model = ml.gbt_classifier(**ml.PASSENGER_GBM).fit(data)
    out = ml.predict(model, test, "PassengerId", "Survived", transform=lambda c: c.cast("int"))
    return out.orderBy("PassengerId")

