import pytest
from pyspark.sql import functions as F

from leadlens.operators import models as M
from leadlens.operators import prep as T
from leadlens.sources import synthetic
from leadlens.sources.testviews import NUMERIC_FEATURES


@pytest.fixture(scope="module")
def data(spark):
    df = synthetic.learnable_leads(spark, 400, seed=5).withColumnRenamed("intent_label", "label")
    return T.FeaturePipeline(list(NUMERIC_FEATURES), []).fit(df).transform(df).select("id", "features", "label").cache()


def test_fold_sizes_differ_by_one_at_most(spark):
    df = spark.range(1_003).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3 % 2).alias("label"))
    a = M.stratified_folds(df, "id", "label", 5)
    b = M.stratified_folds(df.repartition(3), "id", "label", 5)
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str) and a.count() == 1_003
    sizes = {}
    for r in a.groupBy("label", "fold").count().collect():
        sizes.setdefault(r.label, []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values()) and len(sizes) == 3
    tiny = M.stratified_folds(df.limit(2), "id", "label", 5)
    assert tiny.count() == 2 and tiny.where("fold not between 0 and 4").count() == 0


def test_the_median_rule():
    finished = [[0.8, 0.7, 0.9], [0.6, 0.6, 0.6], [0.7, 0.9, 0.8]]
    assert M.stops([0.65], finished) and not M.stops([0.7], finished)
    assert M.stops([0.9, 0.55], finished) and not M.stops([0.9, 0.65], finished)
    assert not M.stops([0.1], finished[:1])


def test_a_weak_configuration_is_stopped(data, monkeypatch):
    drawn = iter([{"C": 1.0, "max_iter": 50}, {"C": 0.5, "max_iter": 50}, {"C": 1e-9, "max_iter": 0}, {"C": 2.0, "max_iter": 50}])
    monkeypatch.setattr(M, "_draw", lambda rng, spec: next(values))
    values = (v for d in drawn for v in d.values())
    found = M.search(data, "logistic_regression", n_trials=4, folds=3, parallelism=1)
    assert found.stopped[2] and len(found.foldMetrics[2]) == 1 and not any(found.stopped[:2])
    assert len(found.foldMetrics[0]) == 3 and not found.stopped[found.best] and found.avgMetrics[found.best] > 0.7
    assert found.bestModel.coefficients.size == data.first().features.size


def test_regularisation_follows_the_fold():
    whole = M._candidate("logistic_regression", {"C": 2.0, "max_iter": 9}, 1_000, "label", "features", 1)
    fold = M._candidate("logistic_regression", {"C": 2.0, "max_iter": 9}, 800, "label", "features", 1)
    assert whole.getRegParam() == pytest.approx(1 / 2_000) and fold.getRegParam() == pytest.approx(1 / 1_600)


def test_search_over_second_order_trees(data, monkeypatch):
    monkeypatch.setitem(M.SEARCH_SPACES, "xgboost", {"n_estimators": (2, 3), "max_depth": (2, 2), "learning_rate": (0.1, 0.3, "log"),
                                                     "subsample": (0.8, 1.0), "colsample_bytree": (0.6, 1.0)})
    found = M.search(data, "xgboost", n_trials=1, folds=2, parallelism=1)
    assert found.avgMetrics[0] > 0.6 and found.bestModel.featureImportances.toArray().sum() == pytest.approx(1)


def test_rows_without_a_label_have_no_weight(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "label int")
    assert [r.weight for r in M.balanced_weights(df, "label").collect()] == [0.5, 0.5, None]
