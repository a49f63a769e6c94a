import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import prep as T
from leadlens.operators import quality as Q
from leadlens.operators import split as D


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    out = T.PopulationScaler(["x", "c"]).fit(df).transform(df).toPandas()
    assert list(out["x"]) == [-1.0, 1.0]  # population std = 1
    assert list(out["c"]) == [0.0, 0.0]  # zero std divides by 1


def test_onehot_drop_first_and_unknown(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    model = T.OneHot(["k"], dropFirst=True).fit(train)
    assert model.output_columns() == ["k_b", "k_c"]
    test = spark.createDataFrame([("a",), ("c",), ("zzz",), (None,)], "k string")
    rows = [tuple(r) for r in model.transform(test).select("k_b", "k_c").collect()]
    assert rows == [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_onehot_rejects_unbounded_levels(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("j"))
    with pytest.raises(ValueError, match="too many categories"):
        T.OneHot(["j", "k"], maxLevels=100).fit(df)
    model = T.OneHot(["j", "k"], maxLevels=500).fit(df)
    assert len(model.output_columns()) == 501  # every level kept, none dropped


def test_imputers_and_variance(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (None, "x", 1.0), (4.0, "y", 1.0), (10.0, None, 1.0)],
                               "a double, s string, k double")
    m = T.MedianImputer(["a"]).fit(df)
    assert [r[0] for r in m.transform(df).select("a").collect()] == [1.0, 4.0, 4.0, 10.0]
    c = T.ConstantImputer(["s"]).transform(df)
    assert [r[0] for r in c.select("s").collect()] == ["missing", "x", "y", "missing"]
    v = T.VarianceFilter(["a", "k"], threshold=0.01).fit(df)
    assert v.kept() == ["a"]


def test_feature_pipeline_not_fitted(spark):
    fp = T.FeaturePipeline(["a"], ["s"])
    with pytest.raises(ValueError, match="not fitted"):
        fp.transform(spark.createDataFrame([(1.0, "x")], "a double, s string"))


def test_feature_pipeline_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(float(i), "u" if i % 2 else "v") for i in range(20)], "a double, s string")
    fp = T.FeaturePipeline(["a"], ["s"]).fit(df)
    out = fp.transform(df)
    assert out.count() == 20 and len(out.first()["features"]) == len(fp.columns)
    fp.model.write().overwrite().save(str(tmp_path / "prep"))
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(str(tmp_path / "prep")).transform(df)
    assert again.select("features").collect() == out.select("features").collect()


def test_range_rules_reject(spark):
    row = dict(lead_score=150.0, company_size=10, engagement_score=50.0, response_time_hours=1.0,
               email_open_rate=0.5, email_click_rate=0.1, page_views=3, time_since_signup_days=4,
               industry="Tech", company_type="SaaS", location="US", product_interest="SMB",
               source="Direct", sales_stage="Decision")
    good = dict(row, lead_score=75.0)
    df = spark.createDataFrame(pd.DataFrame([row, good]))
    flags = [r.is_valid for r in Q.valid_flag(df).collect()]
    assert flags == [False, True]
    v = {r.rule: r.violations for r in Q.violation_counts(df).collect()}
    assert v["lead_score"] == 1 and sum(v.values()) == 1


def test_duplicates_nulls_outliers(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (100, "b")], "x int, s string")
    assert Q.duplicate_rows(df).first()[0] == 2
    nulls = {r.column_name: r.null_count for r in Q.null_counts(df).collect()}
    assert nulls == {"x": 0, "s": 1}
    out = [r.is_outlier for r in Q.iqr_outliers(df, ["x"]).orderBy("x").collect()]
    assert out[-1] is True and not any(out[:-1])
    assert Q.iqr_outliers(df, ["x"], enabled=False).where("is_outlier").count() == 0
    Q.check_shape(df)
    with pytest.raises(ValueError):
        Q.check_shape(df.limit(0))


def test_fill_strategies(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, None)], "id long, v double")
    assert [r.v for r in Q.fill_mean(df, ["v"]).orderBy("id").collect()] == [1.0, 3.0, 5.0, 3.0]
    assert [r.v for r in Q.fill_median(df, ["v"]).orderBy("id").collect()] == [1.0, 3.0, 5.0, 3.0]
    assert [r.v for r in Q.fill_ordered(df, "id", ["v"]).orderBy("id").collect()] == [1.0, 1.0, 5.0, 5.0]


def test_splits(spark):
    df = spark.range(4000).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    tr, te = D.train_test_split(df, "id", 0.2)
    assert tr.count() + te.count() == 4000 and 650 < te.count() < 950
    tr2, te2 = D.train_test_split(df, "id", 0.2, label_col="y", exact=True)
    counts = {r.y: r["count"] for r in te2.groupBy("y").count().collect()}
    assert counts == {1: 200, 0: 600} and tr2.count() == 3200
    s = D.three_way_split(df, "id").groupBy("split").count().toPandas().set_index("split")["count"]
    assert abs(s["train"] / 4000 - 0.7) < 0.03 and abs(s["test"] / 4000 - 0.1) < 0.02
    # deterministic: the same rows every time
    assert te.orderBy("id").collect() == D.train_test_split(df, "id", 0.2)[1].orderBy("id").collect()


def test_duplicates_by_digest_are_compared_in_full(spark):
    from leadlens.operators import quality as Q

    rows = [(1, None, "a"), (None, 1.0, "a"), (1, None, "a"), (2, float("nan"), None), (2, None, None), (3, -0.0, ""), (3, 0.0, "")]
    df = spark.createDataFrame(rows + [(i, 1.0, "x") for i in range(10, 200)], "i long, v double, t string")
    want = df.count() - Q.missing_as_null(df, df.columns).distinct().count()
    for bits in (128, 64, 4):  # 4 bits: nearly all digests collide
        assert Q.duplicate_rows(df, bits=bits).first()[0] == want == 3
    assert Q.duplicate_rows(df, ["t"], bits=128).first()[0] == df.count() - 4
    assert Q.duplicate_rows(df.limit(0)).first()[0] == 0
