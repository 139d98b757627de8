"""Early stopping with a patience: best rounds, staged scores, models cut to them."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabforge.operators import boosting, metrics, ml


def _frame(spark, n=600, noise=1.0, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + noise * rng.normal(size=n) > 0).astype(float)
    rows = [(i, float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label double, a double, b double, c double, d double")


def test_best_round():
    assert boosting.best_round([0.5, 0.6, 0.7], 2) == (3, False)
    assert boosting.best_round([0.5, 0.7, 0.6, 0.7], 2) == (2, True)       # the first of equal scores
    assert boosting.best_round([0.5, 0.7, 0.6, 0.71, 0.6], 2) == (4, False)
    assert boosting.best_round([0.7, 0.6, 0.6], 3) == (1, False)


def test_staged_scores_and_cut_models(spark):
    df = ml.assemble(_frame(spark), ["a", "b", "c", "d"])
    train, held = df.where("id % 3 != 0"), df.where("id % 3 = 0")
    model = ml.gbt_classifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=1).fit(train)
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction")
    staged = boosting.staged_auc(model, held)
    for rounds in (1, 5, 12):
        cut = boosting.cut_to(model, rounds)
        assert cut.getNumTrees == rounds and list(cut.treeWeights) == list(model.treeWeights)[:rounds]
        exact = metrics.auc(ml.positive_probability(cut.transform(held)), "score", "label").first()["auc"]
        assert staged[rounds - 1] == pytest.approx(exact, abs=2e-3)
    assert staged[-1] == pytest.approx(auc.evaluate(model.transform(held)), abs=2e-3)
    longer = ml.gbt_classifier(maxIter=20, maxDepth=3, stepSize=0.3, seed=1).fit(train)
    assert [t.toDebugString.split("\n", 1)[1] for t in longer.trees[:12]] == [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_patience_keeps_the_best_round(spark):
    """Deep trees on noisy labels: the score on held-out rows falls after a
    few rounds.  Fits of 4, 8, ... rounds end when the best is old enough."""
    df = ml.assemble(_frame(spark, noise=2.5, seed=8), ["a", "b", "c", "d"])
    train, held = df.where("id % 3 != 0"), df.where("id % 3 = 0")
    make = lambda rounds: ml.gbt_classifier(maxIter=rounds, maxDepth=6, stepSize=0.5, seed=1)
    model, scores = boosting.fit_with_patience(make, train, held, patience=6, max_rounds=64, first_rounds=4)
    keep, stopped = boosting.best_round(scores, 6)
    assert stopped and model.getNumTrees == keep < len(scores) < 64
    assert max(scores[:keep + 6]) == scores[keep - 1] > scores[-1]
    few, scores = boosting.fit_with_patience(make, train, held, patience=100, max_rounds=6, first_rounds=4)
    assert len(scores) == 6 and few.getNumTrees == int(np.argmax(scores)) + 1


def test_no_fit_that_a_last_one_would_repeat(spark, monkeypatch):
    """Scores that go up to the end: 4, 8, 16, then all 40 rounds, not 32 and
    40; a patience that runs out ends the fits as before."""
    grown = []

    class Model:
        def fit(self, rows):
            return grown[-1]

    def make(rounds):
        grown.append(rounds)
        return Model()

    monkeypatch.setattr(boosting, "cut_to", lambda model, keep: keep)
    monkeypatch.setattr(boosting, "staged_auc", lambda model, rows, label: [i / 100 for i in range(model)])
    keep, scores = boosting.fit_with_patience(make, None, None, patience=3, max_rounds=40, first_rounds=4)
    assert grown == [4, 8, 16, 40] and keep == len(scores) == 40
    grown.clear()
    monkeypatch.setattr(boosting, "staged_auc", lambda model, rows, label: [-abs(i - 6) for i in range(model)])
    assert boosting.fit_with_patience(make, None, None, patience=3, max_rounds=40, first_rounds=4)[0] == 7
    assert grown == [4, 8, 16]


def test_out_of_fold_covers_every_row_and_finds_the_signal(spark):
    df = _frame(spark, n=400, noise=0.7).withColumn("fold", ml.fold_col("id", 4, seed=5)) \
        .withColumn("a", F.when(F.col("id") % 11 != 0, F.col("a")))
    oof = boosting.out_of_fold(df, ["a", "b", "c", "d"], lambda r: ml.gbt_classifier(maxIter=r, maxDepth=3, stepSize=0.2, seed=1),
                               "fold", 4, "id", patience=4, max_rounds=16, first_rounds=8)
    rows = oof.collect()
    assert sorted(r["id"] for r in rows) == list(range(400)) and len({r["rounds"] for r in rows}) >= 1
    assert len({r["score"] for r in rows}) > 20
    assert metrics.auc(oof, "score", "label").first()["auc"] > 0.65


def test_forest_without_a_depth_bound(spark):
    """Labels that only deep trees can tell apart."""
    df = ml.assemble(spark.range(3000).select("id", (F.col("id") % 3000).cast("double").alias("a"),
                                             F.pmod(F.xxhash64("id"), F.lit(2)).cast("double").alias("label")), ["a"])
    model = ml.random_forest(trees=2, max_depth=ml.DEEP, seed=0).fit(df)
    assert max(t.depth for t in model.trees) > 10


def test_grid_search_goes_on_where_it_stopped(spark, tmp_path):
    df = ml.assemble(_frame(spark, n=200), ["a", "b", "c", "d"]).withColumn("fold", ml.fold_col("id", 3, seed=2))
    evaluator = BinaryClassificationEvaluator()
    points = [{"trees": t, "max_depth": d} for t in (3, 5) for d in (2, 3)]
    fits = []

    def make(trees, max_depth):
        fits.append((trees, max_depth))
        if len(fits) == 8:
            raise RuntimeError("stopped")
        return ml.random_forest(trees=trees, max_depth=max_depth, seed=1)

    path = str(tmp_path / "grid")
    with pytest.raises(RuntimeError):
        ml.grid_scores(df, make, points, evaluator, "fold", 3, path, parallelism=1)
    # A pool that is told of a failure may have begun its next job.
    there, begun = ml.stored_scores(spark, path).count(), len(fits)
    assert 7 <= there < 12
    scores = ml.grid_scores(df, make, points, evaluator, "fold", 3, path, parallelism=2)
    assert scores.count() == 12 and len(fits) == begun + 12 - there
    ml.grid_scores(df, make, points, evaluator, "fold", 3, path)
    assert len(fits) == begun + 12 - there      # all there: nothing fitted
    table = ml.best_point(scores).collect()
    assert len(table) == 4 and sum(r["best"] for r in table) == 1
    assert max(table, key=lambda r: r["mean_score"])["best"]


def test_the_programs_grid_is_whole():
    from tabforge.plans import models
    assert len(models.FOREST_GRID) == 54 and len({tuple(p.items()) for p in models.FOREST_GRID}) == 54


def test_the_credit_program_scores_above_chance(spark):
    """The assembled matrix of sf0.01 carries the signal: a few rounds on two
    folds are enough for an AUC above 0.65."""
    from tabforge.plans import loans, models
    from tabforge.plans.common import T
    from tests.conftest import SF01
    data, names = models.credit_frame(T(spark, SF01))
    data = data.withColumn("fold", ml.fold_col(loans.KEY, 2, seed=1024))
    oof = boosting.out_of_fold(data, names, models._credit_gbm, "fold", 2, loans.KEY, "TARGET", patience=10, max_rounds=12,
                               first_rounds=12)
    found = metrics.auc(oof, "score", "TARGET").first()
    assert found["n"] == 1200 and found["auc"] > 0.65
