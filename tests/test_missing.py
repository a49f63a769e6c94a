"""Missing values and keys: NaN, null labels, null and repeated keys, odd lines."""

import math

import pytest
from pyspark.sql import functions as F

from leadlens.operators import aggregates as A
from leadlens.operators import joins as J
from leadlens.operators import prep as P
from leadlens.operators import quality as Q
from leadlens.operators import split as D
from leadlens.session import checkpoint_dir
from leadlens.sources import csv_io

NAN = float("nan")


@pytest.fixture()
def holes(spark):
    rows = [(0, 1.0, 1.0), (1, NAN, 2.0), (2, None, 3.0), (3, 3.0, 4.0), (4, 5.0, 1000.0)]
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_nan_is_missing(holes):
    assert {r.column_name: r.null_count for r in Q.null_counts(holes).collect()} == {"id": 0, "x": 2, "y": 0}
    assert [r.x for r in Q.fill_mean(holes, ["x"]).orderBy("id").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]
    assert [r.x for r in Q.fill_median(holes, ["x"]).orderBy("id").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]
    assert [r.x for r in Q.fill_ordered(holes, "id", ["x"]).orderBy("id").collect()] == [1.0, 1.0, 1.0, 3.0, 5.0]
    assert [r.is_outlier for r in Q.iqr_outliers(holes, ["x", "y"]).orderBy("id").collect()] == [False] * 4 + [True]
    model = P.MedianImputer(["x"]).fit(holes)
    assert [r.x for r in model.transform(holes).orderBy("id").collect()] == [1.0, 3.0, 3.0, 3.0, 5.0]
    scaled = P.PopulationScaler(["x"]).fit(holes)._stats()["x"]
    assert scaled[0] == 3.0 and math.isclose(scaled[1], math.sqrt(8 / 3))


def test_column_without_values_is_filled_with_zero(spark):
    df = spark.createDataFrame([(None, 1.0), (NAN, 2.0)], "x double, y double")
    assert [r.x for r in P.MedianImputer(["x", "y"]).fit(df).transform(df).collect()] == [0.0, 0.0]


def test_rows_without_label_are_a_class_of_the_split(spark):
    df = spark.range(40).withColumn("y", F.when(F.col("id") >= 10, (F.col("id") % 3).cast("int")))
    train, test = D.train_test_split(df, "id", 0.2, label_col="y", exact=True)
    assert train.unionByName(test).orderBy("id").collect() == df.orderBy("id").collect()
    counts = {r.y: r["count"] for r in test.groupBy("y").count().collect()}
    assert counts == {None: 2, 0: 2, 1: 2, 2: 2}
    parts = {(r.y, r.split): r["count"] for r in D.exact_three_way_split(df, "id", "y").groupBy("y", "split").count().collect()}
    assert all(parts[y, "train"] == 7 and parts[y, "test"] == 1 and parts[y, "validation"] == 2 for y in (None, 0, 1, 2))


def test_label_that_is_no_class_raises(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_CLASSES", 20)
    with pytest.raises(ValueError, match="not a class label"):
        D.exact_test_flag(spark.range(50).withColumn("y", F.col("id")), "id", "y", 0.2)


def test_seed_and_id_do_not_run_together(spark):
    row = spark.createDataFrame([(21, 1)], "a long, b long").select(
        D.hash_fraction("a", 4).alias("x"), D.hash_fraction("b", 42).alias("y")).first()
    assert row.x != row.y


def test_activities_without_lead_keep_their_distinct_counts(spark):
    df = spark.createDataFrame([(None, 1, 7), (None, 2, 8), (5, 1, 7)], "lead_id long, activity_id long, follow_up_id long")
    df = df.selectExpr("*", "'x' call_status", "1.0D duration", "'r' call_recordings", "timestamp_seconds(1) created_at",
                       "'' activity_details", "'' description")
    got = {r.lead_id: (r.unique_activity_types, r.followup_count) for r in A.activity_aggregate(df).collect()}
    assert got == {None: (2, 2), 5: (1, 1)}


def test_repeated_lookup_key_raises(spark):
    side = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k long, v string")
    with pytest.raises(ValueError, match="key 2 occurs 2 times"):
        J.unique_key(side, "k", "users")
    assert J.unique_key(side.where("v <> 'c'"), "k", "users").count() == 2


def test_attached_row_is_no_join(spark, capsys):
    row = spark.createDataFrame([(1.5, 2)], "m double, n long").agg(F.avg("m").alias("m"), F.max("n").alias("n"))
    out = J.attach_row(spark.range(3), row)
    out.explain()
    assert "Join" not in capsys.readouterr().out and [(r.m, r.n) for r in out.collect()] == [(1.5, 2)] * 3


def test_comma_only_lines_stay_and_tabs_go(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text(",".join(csv_io.ALL_FIELDS) + "\n" + "," * 13 + "\n\n" + "1.5,2,\t3\t" + "," * 11 + "\n")
    rows = csv_io.read_leads_csv(spark, str(path)).collect()
    assert [(r.lead_score, r.company_size, r.engagement_score, r.industry) for r in rows] == [(0.0, 0, 0.0, ""), (1.5, 2, 3.0, "")]


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="share"):
        checkpoint_dir(Session())
