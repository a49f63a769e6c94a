import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import ordered as O
from leadlens.operators import selection as S
from leadlens.operators import split as D


def test_brackets_move_few_rows_and_narrow_again(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=60_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    moved, counted = [], S._cumulated

    def seen(values, brackets):
        moved.append([(b.inside, b.column) for b in brackets])
        return counted(values, brackets)

    monkeypatch.setattr(S, "_cumulated", seen)
    for most in (None, 50):
        row = O.exact_quantiles(df, ["x"], [0.25, 0.5, 0.95], n=most).first()
        assert [row[f"x_q{i}"] for i in range(3)] == pytest.approx([np.percentile(x, p) for p in (25, 50, 95)], abs=1e-12)
    assert sum(n for n, _ in moved[0]) < 0.02 * 60_000
    assert all(n <= 50 for n, _ in moved[1])


def test_odd_columns(spark):
    inf = float("inf")
    df = spark.createDataFrame([(None, 1.0, inf, 0.0, 5), (None, float("nan"), -inf, -0.0, 5), (None, 3.0, 2.0, 0.0, 5)],
                               "none double, nan double, inf double, zero double, one int")
    row = O.exact_quantiles(df, df.columns, [0.0, 0.5, 1.0]).first()
    assert [row[f"none_q{i}"] for i in range(3)] == [None] * 3
    assert [row[f"nan_q{i}"] for i in range(3)] == [1.0, 2.0, 3.0]
    assert row["inf_q1"] == 2.0 and row["zero_q1"] == 0.0 and row["one_q2"] == 5.0
    assert O.exact_quantiles(df.limit(0), ["nan"], [0.5]).first()[0] is None


def test_a_hot_value_is_its_own_answer(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    x = np.array([7.0 if i % 3 == 0 else float(i) for i in range(30_000)])
    row = O.exact_quantiles(df, ["x"], [0.1, 0.33, 0.34, 0.9], n=100).first()
    assert list(row) == pytest.approx([np.percentile(x, p) for p in (10, 33, 34, 90)], abs=1e-9)


def ranked(rows, q):
    """Ids of the first q(n) rows of each class by (hash, id)."""
    import hashlib

    def h(i):
        return -1 if i is None else int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16)

    out = set()
    for c in {y for _, y in rows}:
        own = sorted((h(i), i) for i, y in rows if y == c)
        out |= {i for _, i in own[:q(len(own))]}
    return out


def test_splits_by_cut_equal_ranking(spark):
    rows = [(i, [0, 0, 0, 1, None][i % 5]) for i in range(7_000)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(5)
    half_up = lambda x: int(x + 0.5)
    flagged = D.exact_test_flag(df, "id", "y", 0.21)
    assert flagged.columns == ["id", "y", "_is_test"] and flagged.count() == 7_000
    assert {r.id for r in flagged.where("_is_test").collect()} == ranked(rows, lambda n: half_up(n * 0.21))
    three = D.exact_three_way_split(df, "id", "y")
    assert {r.id for r in three.where("split = 'test'").collect()} == ranked(rows, lambda n: half_up(half_up(n * 0.3) / 3))
    assert {r.id for r in three.where("split <> 'train'").collect()} == ranked(rows, lambda n: half_up(n * 0.3))


def test_ties_at_the_cut_and_extreme_quotas(spark):
    rows = [(i // 4, 0) for i in range(100)] + [(1000 + i, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, y int")
    for size in (0.0, 0.33, 0.5, 1.0):
        got = {(r.y, r._is_test): r["count"] for r in D.exact_test_flag(df, "id", "y", size).groupBy("y", "_is_test").count().collect()}
        assert got.get((0, True), 0) == int(100 * size + 0.5) and got.get((1, True), 0) == int(3 * size + 0.5)
        assert sum(got.values()) == 103


def test_many_classes_are_ranked(spark):
    df = spark.range(700).withColumn("y", F.col("id") % 70)
    got = D.exact_test_flag(df, "id", "y", 0.2).groupBy("y").agg(F.count_if("_is_test").alias("n")).collect()
    assert {r.n for r in got} == {2}
