"""Model-data work on Spark ML.

The reference fits scikit-learn / LightGBM / XGBoost models on in-memory
arrays.  Here features stay a DataFrame: a ``VectorAssembler`` builds the
vector column, Spark ML fits distributed trees and k-means, and every
result (scores, curves, importances, out-of-fold predictions) comes back
as a small DataFrame.  Splits and folds are hash-based on a row id, so
they do not depend on partitioning or row order and survive recomputation
after an executor loss.
"""

from __future__ import annotations

import json
import math
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_path
from .trees import GrownForest, grow_forest

# --- splits and folds (M05, M06) -------------------------------------------------------


HASH_RANGE = 1 << 32


def id_hash(id_col: str, seed: int) -> Column:
    """A number in [0, 2^32) per id: the first eight digits of the md5 of
    ``seed:id``.  Any engine can compute it, and it depends on nothing but
    the id and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def id_hash_sql(id_col: str, seed: int) -> str:
    """DuckDB twin of ``id_hash``."""
    return f"CAST('0x' || substr(md5(concat('{seed}:', {id_col})), 1, 8) AS BIGINT)"


def hash_fraction(id_col: str, seed: int) -> Column:
    """A stable pseudo-random number in [0, 1) per id."""
    return id_hash(id_col, seed) / float(HASH_RANGE)


def split(df: DataFrame, id_col: str, test_fraction: float = 0.25, seed: int = 33):
    """Train / holdout split by hashed id."""
    h = hash_fraction(id_col, seed)
    return df.where(h >= test_fraction), df.where(h < test_fraction)


def fold_col(id_col: str, k: int, seed: int | None = None) -> Column:
    """Fold index in [0, k).  With a seed: shuffled folds by hash;
    without: ``id mod k`` (the reference's unshuffled folds are contiguous
    row blocks, which have no meaning for unordered rows)."""
    if seed is None:
        return F.pmod(F.col(id_col), F.lit(k)).cast("int")
    return (id_hash(id_col, seed) % k).cast("int")


def sample(df: DataFrame, fraction: float, seed: int = 0, id_col: str | None = None) -> DataFrame:
    """A seeded sample of the given fraction, at any size.  With an id
    column a row is in or out by its id alone, however the rows lie."""
    if id_col is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_fraction(id_col, seed) < fraction)


# --- clusters and rotations (M01, M02, M04) -----------------------------------------------


class FeaturePrep:
    """Mean imputation + vector assembly fitted on one split.

    The means come from ONE aggregate (a row of scalars reaches the
    driver); a column that is missing everywhere is filled with 0 instead
    of failing, and the same fill is applied to every split.  Spark trees
    cannot route missing values, hence the fill.
    """

    def __init__(self, cols: Sequence[str], fill: Mapping[str, float], out: str):
        self.cols, self.fill, self.out = list(cols), dict(fill), out

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str], out: str = "features", impute: bool = True):
        cols = list(cols)
        fill = {}
        if impute and cols:
            row = train.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]).first()
            fill = {c: (float(row[c]) if row[c] is not None else 0.0) for c in cols}
        return cls(cols, fill, out)

    def transform(self, df: DataFrame) -> DataFrame:
        if self.fill:
            df = df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v))
                                 for c, v in self.fill.items()})
        return VectorAssembler(inputCols=self.cols, outputCol=self.out, handleInvalid="keep").transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", impute: bool = False) -> DataFrame:
    """Vector column from feature columns, optionally mean-imputed with the
    frame's own means (see ``FeaturePrep`` to reuse one split's means)."""
    return FeaturePrep.fit(df, cols, out, impute).transform(df)


def fit_features(train: DataFrame, cols: Sequence[str], out: str = "features", impute: bool = True):
    """Imputation fitted on the training split, to apply unchanged to every split."""
    return FeaturePrep.fit(train, cols, out, impute)


def kmeans_fit(points: DataFrame, cols: Sequence[str], k: int = 20, seed: int = 1,
               max_iter: int = 20):
    """K-means on the given coordinate columns (k-means|| init)."""
    data = assemble(points.dropna(subset=list(cols)), cols)
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(data)


def mini_batch_kmeans(points: DataFrame, cols: Sequence[str], id_col: str, k: int = 20, batch: int = 10_000, steps: int = 50,
                      seed: int = 1) -> list[list[float]]:
    """Centres by mini-batch k-means.

    Batches are drawn by hashed id: about ``steps * batch`` rows at most,
    stored once, a folder per step, so a step reads its own rows only; fewer
    rows than that are dealt into batches that come round again.  The first
    batch starts the centres (k-means||).  In each step every row of the
    batch goes to its nearest centre (the centres are literals, k x d
    numbers), one aggregate gives the sums per centre, and a centre moves by
    its share of the rows it has ever had, so steps get smaller; once every
    batch was seen, a step that moves nothing to speak of is the last.
    Rows with a missing coordinate are left out."""
    data = points.select(id_col, *cols).dropna(subset=list(cols))
    n = data.count()
    if not n:
        return []
    dealt = min(steps, max(1, -(-n // batch)))
    data = data if n <= dealt * batch else sample(data, dealt * batch / n, seed, id_col)
    path = shared_path(data.sparkSession, f"batches/{uuid.uuid4().hex}")
    data.withColumn("_batch", fold_col(id_col, dealt, seed + 1)).write.partitionBy("_batch").parquet(path)
    stored = data.sparkSession.read.parquet(path)
    first = stored.where("_batch = 0") if dealt > 1 else stored
    centers = centers_of(kmeans_fit(first, cols, k, seed, max_iter=5))
    seen = [0] * len(centers)
    for step in range(steps):
        part = stored.where(F.col("_batch") == step % dealt) if dealt > 1 else stored
        sums = part.withColumn("_at", assign_nearest(cols, centers)).groupBy("_at").agg(
            F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in cols]).collect()      # one row per centre
        moved = 0.0
        for r in sums:
            i = r["_at"]
            seen[i] += r["_n"]
            rate = r["_n"] / seen[i]
            new = [old + rate * (r[c] - old) for old, c in zip(centers[i], cols, strict=True)]
            moved += sum((a - b) ** 2 for a, b in zip(new, centers[i], strict=True))
            centers[i] = new
        if step >= dealt and moved <= 1e-8 * sum(v * v for at in centers for v in at):
            break
    return centers


def inertia(points: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """One row: points and the sum of their squared distances to the nearest centre."""
    near = F.array_min(F.array(*[sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip(cols, at, strict=True)), F.lit(0.0)) for at in centers]))
    return points.dropna(subset=list(cols)).agg(F.count(F.lit(1)).alias("n"), F.sum(near).alias("inertia"))


def centers_of(model) -> list[list[float]]:
    return [list(map(float, c)) for c in model.clusterCenters()]


def assign_nearest(cols: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre (squared Euclidean, first on ties).

    The centres (k x d numbers, bounded by k) become literals inside one
    expression, so assignment is a projection: no join, no shuffle.  The
    k (distance, index) pairs form one array whose ``array_min`` is the
    nearest centre with the lowest index on ties; the array is built once,
    which keeps the generated code within whole-stage codegen limits even
    when the result is also a grouping key.
    """
    pairs = []
    for i, c in enumerate(centers):
        d = None
        for col_name, v in zip(cols, c):
            diff = F.col(col_name) - F.lit(float(v))
            d = diff * diff if d is None else d + diff * diff
        pairs.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*pairs)).getField("i").cast("int")


def pca2_fit(points: DataFrame, x: str, y: str) -> dict[str, float]:
    """2-D PCA in closed form: centre and rotation angle of the
    principal axis, from one aggregate (three scalars reach the driver)."""
    r = points.agg(F.avg(x).alias("mx"), F.avg(y).alias("my"),
                   F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"),
                   F.covar_pop(x, y).alias("cxy")).first()
    theta = 0.5 * math.atan2(2 * r["cxy"], r["vx"] - r["vy"])
    return {"mx": r["mx"], "my": r["my"], "theta": theta}


def pca2_transform(fit: Mapping[str, float], x: str, y: str) -> tuple[Column, Column]:
    """Coordinates on the first and second principal axes."""
    c, s = math.cos(fit["theta"]), math.sin(fit["theta"])
    dx, dy = F.col(x) - fit["mx"], F.col(y) - fit["my"]
    return dx * c + dy * s, -dx * s + dy * c


# --- models (M07-M09, M15, M16) ---------------------------------------------------------------

# Fixed parameter maps of the reference trainers, translated.
# The trainers' gain thresholds are loss reductions summed over a node's rows;
# Spark's ``minInfoGain`` is an impurity gain per row, so they have no
# counterpart here: depth and the rows per node are the brakes.
CREDIT_GBM = {"stepSize": 0.02, "maxIter": 1000, "maxDepth": 8, "subsamplingRate": 0.8715623,
              "featureSubsetStrategy": "0.9497036", "minInfoGain": 0.0,
              "minInstancesPerNode": 60, "validationTol": 0.0, "seed": 0}
TRIP_GBM = {"stepSize": 0.05, "maxIter": 200, "maxDepth": 12, "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.3", "minInfoGain": 0.0, "minInstancesPerNode": 10}
PASSENGER_GBM = {"maxDepth": 3, "stepSize": 0.5, "minInfoGain": 0.0, "seed": 10}


def gain_per_row(loss_reduction: float, rows: int) -> float:
    """A threshold on the loss reduction over all rows as one on the gain
    per row (equal at the root)."""
    return loss_reduction / max(rows, 1)


def gbt_classifier(label: str = "label", features: str = "features", validation: str | None = None,
                   **params) -> GBTClassifier:
    """Boosted-tree binary classifier; early stopping when a
    ``validation`` indicator column is given."""
    est = GBTClassifier(labelCol=label, featuresCol=features, **params)
    if validation:
        est = est.setValidationIndicatorCol(validation)
    return est


def gbt_regressor(label: str = "label", features: str = "features", validation: str | None = None,
                  **params) -> GBTRegressor:
    """Boosted-tree regressor (fit on the log1p target)."""
    est = GBTRegressor(labelCol=label, featuresCol=features, **params)
    if validation:
        est = est.setValidationIndicatorCol(validation)
    return est


DEEP = 30       # Spark's deepest tree; the programs set no bound


def random_forest(label: str = "label", features: str = "features", trees: int = 80,
                  max_depth: int = 5, seed: int = 0) -> RandomForestClassifier:
    """Random-forest classifier (80 / 150 / 250 trees in the programs).
    Deep trees keep each row's node instead of passing the trees to the
    rows in every round, with a reliable checkpoint every ten levels."""
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=max_depth, seed=seed,
                                  cacheNodeIds=max_depth > 10, checkpointInterval=10)


def fit_forest(forest: RandomForestClassifier, df: DataFrame, cores: int | None = None) -> RandomForestClassificationModel | GrownForest:
    """The forest grown by tasks that take a share of its trees each; where
    that is not for them (``trees``), or ``cores`` are given, fitted by Spark
    ML as smaller ones side by side, one for each core that the partitions of
    ``df`` leave idle, and put together again: its trees are independent, and
    each smaller forest has a seed of its own.  ``df`` should be checkpointed,
    as every one of them reads it."""
    grown = grow_forest(forest, df) if cores is None else None
    if grown is not None:
        return grown
    spark = df.sparkSession
    cores = cores or spark.sparkContext.defaultParallelism
    trees = forest.getNumTrees()
    parts = max(1, min(trees, cores // max(1, df.rdd.getNumPartitions())))
    if parts == 1:
        return forest.fit(df)

    def one(i: int) -> RandomForestClassificationModel:
        own = forest.copy({forest.numTrees: trees // parts + (i < trees % parts), forest.seed: forest.getSeed() + 1_000_003 * i})
        return own.fit(df)

    with ThreadPoolExecutor(parts) as pool:
        fitted = list(pool.map(one, range(parts)))
    # As many classes as the largest label seen, which all of them have seen.
    jvm, java = spark._jvm, fitted[0]._java_obj
    kind = jvm.java.lang.Class.forName("org.apache.spark.ml.classification.DecisionTreeClassificationModel")
    grown = jvm.java.lang.reflect.Array.newInstance(kind, trees)
    at = 0
    for model in fitted:
        for tree in model._java_obj.trees():
            grown[at] = tree
            at += 1
    whole = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
        java.uid(), grown, java.numFeatures(), java.numClasses())
    java.copyValues(whole, java.extractParamMap())
    whole.set("numTrees", trees)
    out = RandomForestClassificationModel(whole)
    out._resetUid(java.uid())
    out._transfer_params_from_java()
    return out


def importances(model, names: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` from a fitted tree model."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    vals = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(v) for v in vals])),
                                 "feature string, importance double")


def predict(model, df: DataFrame, id_col: str, out: str = "prediction",
            transform: Callable[[Column], Column] | None = None) -> DataFrame:
    """Score a frame and pair predictions with ids (``expm1`` etc. via
    ``transform``)."""
    pred = F.col("prediction")
    if transform is not None:
        pred = transform(pred)
    return model.transform(df).select(F.col(id_col), pred.alias(out))


def positive_probability(df: DataFrame, out: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return df.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


# --- validation (M10-M14) -------------------------------------------------------------------------


def out_of_fold(df: DataFrame, estimator_factory: Callable[[], object], fold: str, k: int,
                id_col: str, score: Callable[[DataFrame], DataFrame] = positive_probability,
                validation: str | None = None,
                prepare: Callable[[DataFrame], FeaturePrep] | None = None) -> DataFrame:
    """Fit on ``fold != i``, score ``fold == i``, for every fold; the
    union covers every row exactly once.  With ``validation`` the held-out
    fold is also the early-stopping set (flagged in that column), as the
    reference's ``valid_sets``.  ``prepare`` fits the features on the
    training rows of each fold, never on the held-out ones.  The input is checkpointed first so the k
    fits do not recompute its lineage."""
    data = cut_lineage(df)
    parts = []
    for i in range(k):
        rows = data
        if prepare is not None:
            rows = prepare(data.where(F.col(fold) != i)).transform(data)
        if validation:
            fit_on = rows.withColumn(validation, F.col(fold) == i)
        else:
            fit_on = rows.where(F.col(fold) != i)
        model = estimator_factory().fit(fit_on)
        parts.append(score(model.transform(rows.where(F.col(fold) == i))).select(id_col, "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_validate(df: DataFrame, estimator, evaluator, fold: str, k: int, grid=None,
                   parallelism: int = 1):
    """K-fold cross-validation over a parameter grid with a
    user-supplied fold column in [0, k); returns the ``CrossValidatorModel``."""
    grid = grid if grid is not None else ParamGridBuilder().build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        foldCol=fold, numFolds=k, parallelism=parallelism, collectSubModels=False)
    return cv.fit(df)


def grid_table(cv_model) -> DataFrame:
    """One row per parameter map: parameters as text, mean metric,
    and whether it was the best."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    maps = cv_model.getEstimatorParamMaps()
    metrics = list(cv_model.avgMetrics)
    larger = cv_model.getEvaluator().isLargerBetter()
    best = (max if larger else min)(range(len(metrics)), key=lambda i: metrics[i])
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             float(metrics[i]), i == best) for i, m in enumerate(maps)]
    return spark.createDataFrame(rows, "params string, mean_score double, best boolean")


def _scores_by_fold(df: DataFrame, make_estimator, evaluator, fold: str, k: int,
                    train_filter: Column | None = None, parallelism: int = 4) -> list[tuple[float, float]]:
    """Train and test score of each fold; ``parallelism`` fits run side by side."""
    def one(i: int) -> tuple[float, float]:
        train = df.where(F.col(fold) != i)
        if train_filter is not None:
            train = train.where(train_filter)
        model = make_estimator().fit(train)
        return evaluator.evaluate(model.transform(train)), evaluator.evaluate(model.transform(df.where(F.col(fold) == i)))

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(one, range(k)))


GRID_SCHEMA = "params string, fold int, score double"


def grid_scores(df: DataFrame, make_estimator: Callable[..., object], points: Sequence[Mapping[str, object]], evaluator,
                fold: str, k: int, path: str, parallelism: int = 4) -> DataFrame:
    """M12, resumable: ``params, fold, score`` for every point of the grid
    and every fold, from a table in ``path`` (a folder all machines can
    reach).  A pair that has a row there is not fitted again; each new one
    is appended as soon as it is done, so a run that was stopped goes on
    where it was.  ``params`` is the point as JSON, names in order."""
    spark = df.sparkSession
    done = {(r["params"], r["fold"]) for r in stored_scores(spark, path).collect()}
    todo = [(p, name, i) for p in points for name in [json.dumps(dict(p), sort_keys=True)] for i in range(k) if (name, i) not in done]
    lock = threading.Lock()

    def one(job) -> None:
        point, name, i = job
        est, train = make_estimator(**point), df.where(F.col(fold) != i)
        grown = grow_forest(est, train, parallelism)
        model = est.fit(train) if grown is None else grown
        score = evaluator.evaluate(model.transform(df.where(F.col(fold) == i)))
        with lock:
            spark.createDataFrame([(name, i, float(score))], GRID_SCHEMA).coalesce(1).write.mode("append").parquet(path)

    with ThreadPoolExecutor(parallelism) as pool:
        jobs = [pool.submit(one, job) for job in todo]
        try:
            for job in jobs:
                job.result()
        except BaseException:
            for job in jobs:        # those that have not begun wait for the next run
                job.cancel()
            raise
    return stored_scores(spark, path)


def stored_scores(spark, path: str) -> DataFrame:
    """The rows that ``grid_scores`` has stored so far."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], GRID_SCHEMA)
    return spark.read.schema(GRID_SCHEMA).parquet(path).dropDuplicates(["params", "fold"])


def best_point(scores: DataFrame, larger: bool = True) -> DataFrame:
    """``params, mean_score, best``: the mean over the folds per point,
    and the best one (ties: the first in order of its name)."""
    means = scores.groupBy("params").agg(F.avg("score").alias("mean_score"))
    top = means.orderBy(F.desc("mean_score") if larger else F.asc("mean_score"), "params").limit(1).select(F.col("params").alias("_top"))
    return means.join(F.broadcast(top)).select("params", "mean_score", (F.col("params") == F.col("_top")).alias("best"))


def _mean_std(xs):
    m = sum(xs) / len(xs)
    return m, math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))


def learning_curve(df: DataFrame, make_estimator, evaluator, fold: str, k: int, id_col: str,
                   sizes: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), seed: int = 7) -> DataFrame:
    """train/test score mean and std (ddof 0) per training-size
    fraction x fold, as rows.  The size subset is a stable hash of the id."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    data = cut_lineage(df)
    rows = []
    for s in sizes:
        scores = _scores_by_fold(data, make_estimator, evaluator, fold, k,
                                 hash_fraction(id_col, seed) < s if s < 1.0 else None)
        tm, ts = _mean_std([a for a, _ in scores])
        vm, vs = _mean_std([b for _, b in scores])
        rows.append((float(s), tm, ts, vm, vs))
    return spark.createDataFrame(rows, "train_size double, train_mean double, train_std double, "
                                       "test_mean double, test_std double")


def validation_curve(df: DataFrame, make_estimator: Callable[[object], object], values: Sequence,
                     evaluator, fold: str, k: int, param: str) -> DataFrame:
    """train/test score mean and std per parameter value."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    data = cut_lineage(df)
    rows = []
    for v in values:
        scores = _scores_by_fold(data, lambda: make_estimator(v), evaluator, fold, k)
        tm, ts = _mean_std([a for a, _ in scores])
        vm, vs = _mean_std([b for _, b in scores])
        rows.append((param, str(v), tm, ts, vm, vs))
    return spark.createDataFrame(rows, "param string, value string, train_mean double, train_std double, "
                                       "test_mean double, test_std double")
