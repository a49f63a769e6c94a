import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from leadlens.operators import prep as T
from leadlens.operators.sparse_onehot import SparseOneHot, SparseOneHotModel

ROWS = [("b", "x"), ("a", "y"), (None, "x"), ("c", None), ("b", "x"), ("", "z")]


def dense(model, df):
    return [r[0].toArray().tolist() for r in model.transform(df).select(model.getOrDefault(model.outputCol)).collect()]


@pytest.mark.parametrize("drop", [True, False])
def test_equals_the_column_per_level_encoder(spark, drop):
    df = spark.createDataFrame(ROWS, "j string, k string").coalesce(1)
    wide = T.OneHot(["j", "k"], dropFirst=drop).fit(df)
    want = [list(r) for r in wide.transform(df).select(*[F.col(f"`{c}`") for c in wide.output_columns()]).collect()]
    model = SparseOneHot(["j", "k"], dropFirst=drop).fit(df)
    assert model.size() == len(want[0]) and sorted(dense(model, df)) == sorted(want)


def test_unseen_levels_nulls_and_odd_columns(spark):
    df = spark.createDataFrame([("b", None, "one", 3), ("a", None, "one", 4)], "j string, none string, one string, n int")
    model = SparseOneHot(["j", "none", "one", "n"], dropFirst=True).fit(df)
    other = spark.createDataFrame([("b", "q", "one", 4), ("new", None, "two", 9), (None, None, None, None)], df.schema)
    assert sorted(dense(model, other)) == [[0.0, 0.0], [0.0, 0.0], [1.0, 1.0]]
    assert [(r["column"], r.level, r.slot) for r in model.levels().where("slot is not null").orderBy("slot").collect()] == [
        ("j", "b", 0), ("n", "4", 1)]
    empty = SparseOneHot(["j"]).fit(df.limit(0))
    assert empty.size() == 0 and dense(empty, other) == [[]] * 3


def test_a_million_levels(spark):
    df = spark.range(1_000_000).select(F.format_string("level-%07d", F.col("id")).alias("j"), (F.col("id") % 3).cast("string").alias("k"))
    model = SparseOneHot(["j", "k"], dropFirst=True).fit(df)
    assert model.size() == 1_000_001
    got = model.slots(df.where("j in ('level-0000000', 'level-0000001', 'level-0999999')")).orderBy("j").collect()
    assert [sorted(r.slots) for r in got] == [[], [0, 999_999], [999_998]]
    vector = model.transform(df.where("j = 'level-0999998'")).first()["onehot"]
    assert vector.size == 1_000_001 and vector.indices.tolist() == [999_997, 1_000_000]


def test_a_hot_level_and_low_variance_levels(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, "rare").otherwise(
        F.concat(F.lit("l"), F.col("id") % 4)).alias("j"))
    wide = T.OneHot(["j"]).fit(df)
    kept = T.VarianceFilter(wide.output_columns(), threshold=0.01).fit(wide.transform(df)).kept()
    model = SparseOneHot(["j"], minVariance=0.01).fit(df)
    assert [f"j_{r.level}" for r in model.levels().where("slot is not null").orderBy("slot").collect()] == kept
    assert "j_rare" not in kept and model.slots(df).where("size(slots) = 0").count() == 1


def test_saved_and_loaded(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "j string, k string")
    model = SparseOneHot(["j", "k"], dictionary=str(tmp_path / "levels")).fit(df)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(back, SparseOneHotModel) and sorted(dense(back, df)) == sorted(dense(model, df))


def test_pipeline_with_sparse_levels_keeps_the_same_features(spark):
    df = spark.range(400).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("flat"), F.concat(F.lit("l"), F.col("id") % 5).alias("j"))
    one = T.FeaturePipeline(["x", "flat"], ["j"]).fit(df)
    two = T.FeaturePipeline(["x", "flat"], ["j"], sparse=True).fit(df)
    assert one.columns[0] == "x" and two.columns == ["x", "_levels"]
    a, b = ({round(r.x, 9): r.features.toArray().tolist() for r in p.transform(df).select("x", "features").collect()} for p in (one, two))
    assert a == b
