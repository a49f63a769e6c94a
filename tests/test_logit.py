"""The baseline's fit is held against an independent solution of its optimality conditions."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from leadlens.operators import models as M
from leadlens.operators.logit import NewtonLogit, NewtonLogitModel
from leadlens.plans.training import SCORE_COLUMNS as M_SCORES


def _gradient(x, y, w, ridge, point):
    p = 1 / (1 + np.exp(-(x @ point[:-1] + point[-1])))
    r = w * (p - y) / w.sum()
    return np.append(x.T @ r + ridge * point[:-1], r.sum())


def _descended(x, y, w, ridge):
    """Accelerated descent with restarts: another way to the optimum than Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    rate = 1 / (0.25 * np.linalg.norm(z * np.sqrt(w / w.sum())[:, None], 2) ** 2 + ridge)
    point = ahead = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(200_000):
        slope = _gradient(x, y, w, ridge, ahead)
        if np.abs(slope).max() < 1e-11:
            break
        fresh = ahead - rate * slope
        if slope @ (fresh - point) > 0:
            t = 1.0
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, point, t = fresh + (t - 1) / later * (fresh - point), fresh, later
    return ahead


def _frame(spark, x, y, w):
    rows = [(Vectors.dense(a), None if b is None else float(b), c) for a, b, c in zip(x.tolist(), y, w)]
    return spark.createDataFrame(rows, ["features", "label", "weight"])


def _data(n=600, d=5, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 3, 0.2, 1, 1]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.0, -0.4, 2.0, 0.0, 0.3] - 0.7)))).astype(float)
    return x, y, rng.choice([0.5, 1.0, 2.5], n)


def test_equals_an_independent_solution(spark):
    x, y, w = _data()
    df = _frame(spark, x, y, w.tolist())
    for ridge in (1 / 600, 0.3):
        model = NewtonLogit(weightCol="weight", regParam=ridge).fit(df)
        got = np.append(model.coefficients.toArray(), model.intercept)
        assert np.abs(got - _descended(x, y, w, ridge)).max() < 1e-6
        assert np.abs(_gradient(x, y, w, ridge, got)).max() < 1e-9


def test_rows_without_label_or_weight_take_no_part_and_repeats_count(spark):
    x, y, w = _data(200)
    df = _frame(spark, x, y, w.tolist())
    null_rows = df.limit(3).withColumn("label", F.lit(None).cast("double")).union(
        df.limit(3).withColumn("weight", F.lit(None).cast("double")))
    plain = NewtonLogit(weightCol="weight", regParam=0.01).fit(df)
    assert np.allclose(NewtonLogit(weightCol="weight", regParam=0.01).fit(df.union(null_rows)).coefficients, plain.coefficients, atol=1e-9)
    twice = NewtonLogit(weightCol="weight", regParam=0.01).fit(df.union(df))
    assert np.allclose(twice.coefficients, plain.coefficients, atol=1e-9)


def test_transform_equals_the_formula_and_survives_saving(spark, tmp_path):
    x, y, w = _data(100)
    df = _frame(spark, x, y, w.tolist())
    model = NewtonLogit(weightCol="weight", regParam=0.01).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = NewtonLogitModel.load(str(tmp_path / "m"))
    out = M.with_probability(back.transform(df)).collect()
    want = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    assert np.allclose([r.p1 for r in out], want, atol=1e-12)
    assert [r.prediction for r in out] == [float(p > 0.5) for p in want]


def test_one_class_and_empty_tables_are_refused(spark):
    x, y, w = _data(50)
    df = _frame(spark, x, y, w.tolist())
    for bad in (df.where("label = 1"), df.where("label = 7")):
        with pytest.raises(ValueError, match="both classes"):
            NewtonLogit().fit(bad)


def test_separable_rows_have_an_optimum_with_a_penalty(spark):
    df = _frame(spark, np.array([[float(i)] for i in range(-20, 20)]), [float(i >= 0) for i in range(-20, 20)], [1.0] * 40)
    model = NewtonLogit(regParam=0.05).fit(df)
    assert 0 < model.coefficients[0] < 10


def test_features_that_are_no_numbers_are_refused(spark):
    x, y, w = _data(50)
    x[7, 2] = np.nan
    with pytest.raises(ValueError, match="NaN"):
        NewtonLogit().fit(_frame(spark, x, y, w.tolist()))


def test_baseline_on_the_scored_table_equals_an_independent_solution(spark):
    from leadlens.plans.q_eval import scored
    from leadlens.plans.training import SCORED_TARGET, prepare, scored_mode
    from tests.conftest import SF_SMALL

    table = scored(spark, SF_SMALL)
    _, models, pre, cols, _ = scored_mode(table, ["baseline"])
    names = [c for c in table.columns if c in M_SCORES]
    train = pre.transform(prepare(table.where("split = 'train'"), names, [], SCORED_TARGET)).select("features", "label").collect()
    x, y = np.array([r.features.toArray() for r in train]), np.array([float(r.label) for r in train])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    got = np.append(models["baseline"].coefficients.toArray(), models["baseline"].intercept)
    assert x.shape[1] == len(cols) == len(got) - 1
    assert np.abs(got - _descended(x, y, w, 1 / len(y))).max() < 1e-6
