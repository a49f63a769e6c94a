from pyspark.sql import functions as F

from leadlens.sources import csv_io, profile, synthetic, tables

FIELDS = ",".join(csv_io.ALL_FIELDS)


def test_csv_rules(spark, tmp_path):
    text = "\n".join([
        '"' + '","'.join(csv_io.ALL_FIELDS) + '"',
        '31.25,7,64.0,9.75,0.2,0.9,4,211,Finance,Startup,APAC,SMB,Event,Decision',
        '',
        '12abc, 7.9 ,x,,0.1e1,-0.5,3,12.7,"Retail",SMB,EU,SMB,Direct,Awareness',
        '   ',
        '1,2,3',
    ])
    p = tmp_path / "in.csv"
    p.write_text(text)
    rows = csv_io.read_leads_csv(spark, str(p)).collect()
    assert len(rows) == 3
    r = rows[1]
    assert r.lead_score == 12.0 and r.company_size == 7 and r.engagement_score == 0.0
    assert r.response_time_hours == 0.0 and r.email_open_rate == 1.0 and r.time_since_signup_days == 12
    assert r.industry == "Retail"
    assert rows[2].industry == "" and rows[2].engagement_score == 3.0


def test_csv_missing_columns(spark, tmp_path):
    import pytest
    p = tmp_path / "bad.csv"
    p.write_text("lead_score,company_size\n1,2\n")
    with pytest.raises(ValueError, match="Missing columns"):
        csv_io.read_leads_csv(spark, str(p))


def test_results_format(spark):
    df = spark.createDataFrame([(5, 0.12345, True, 0.87655, "v1.0.0", "pred_r_1"),
                                (2, 0.5, False, None, None, None)],
                               "k long, probability double, predicted_label boolean, confidence double, "
                               "model_version string, prediction_id string")
    out = [tuple(r) for r in csv_io.format_results(df, "k").orderBy("row").collect()]
    assert out[0] == (1, "0.5000", "false", "", "", "")
    assert out[1][:4] == (2, "0.1235", "true", "0.8766")


def test_profile_and_limit(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "A long, B string")
    low = tables.lower_names(df)
    assert low.columns == ["a", "b"]
    p = {r.column_name: (r.row_count, r.null_count, r.data_type) for r in profile.profile(low, "t").collect()}
    assert p == {"a": (2, 0, "bigint"), "b": (2, 1, "string")}
    assert tables.scan_limit(low, 0).count() == 2 and tables.scan_limit(low, 1, ["a"]).first().a == 1


def test_generators_have_signal(spark):
    from leadlens.operators import metrics as E
    df = synthetic.learnable_leads(spark, 4000, seed=7)
    assert df.count() == 4000 and 0.2 < df.agg({"intent_label": "avg"}).first()[0] < 0.8
    sig = (df.selectExpr("intent_label", "0.4*lead_score/100 + 0.3*engagement_score/100 "
                         "+ 0.2*(1-response_time_hours/48) + 0.1*email_click_rate AS s"))
    assert E.roc_auc(sig, "intent_label", "s").first()[0] > 0.8
    s = synthetic.sample_leads(spark, 3000)
    assert s.agg({"id": "min"}).first()[0] == 1
    assert abs(s.agg({"intent_label": "avg"}).first()[0] - 0.3) < 0.05
    assert synthetic.learnable_leads(spark, 50, seed=7).collect() == synthetic.learnable_leads(spark, 50, seed=7).collect()


def test_overwriting_a_table_keeps_it_until_the_new_one_is_complete(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from leadlens.sources import tables

    path = str(tmp_path / "deep" / "t")
    tables.write_table(spark.range(10), path)
    tables.write_table(spark.read.parquet(path).where("id < 5"), path)  # from itself
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="on purpose"):
        tables.write_table(spark.range(50).withColumn("x", F.when(F.col("id") == 49, F.raise_error(F.lit("on purpose")))), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]
    tables.write_table(spark.range(6).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert spark.read.parquet(path).where("p = 1").count() == 3
    assert [f.name for f in (tmp_path / "deep").iterdir()] == ["t"]


def test_tables_of_a_folder_and_of_the_catalogue(spark, tmp_path):
    spark.range(5).withColumn("m", F.create_map(F.lit("a"), F.col("id"))).write.parquet(str(tmp_path / "numbers"))
    spark.range(2).selectExpr("id", "IF(id = 0, NULL, 'x') AS t").write.parquet(str(tmp_path / "texts.parquet"))
    spark.range(1).write.parquet(str(tmp_path / "_hidden"))
    (tmp_path / "notes.txt").write_text("no table")
    found = profile.folder_tables(spark, str(tmp_path))
    assert list(found) == ["numbers", "texts"]
    rows = {r.table_name: r for r in profile.summaries(found).collect()}
    assert (rows["numbers"].row_count, rows["numbers"].n_columns, len(rows["numbers"].sample)) == (5, 2, 3)
    assert rows["texts"].sample == ['{"id":0,"t":null}', '{"id":1,"t":"x"}']
    (tmp_path / "none").mkdir()
    assert profile.folder_tables(spark, str(tmp_path / "none")) == {}
    (tmp_path / "none").rmdir()
    found["texts"].createOrReplaceTempView("catalogue_texts")
    try:
        listed = profile.catalogue_tables(spark)
        assert listed["catalogue_texts"].count() == 2
    finally:
        spark.catalog.dropTempView("catalogue_texts")


def test_sample_of_ties_nulls_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (0, "z"), (1, "a")], "k int, t string")
    row = profile.summary(df.repartition(4), "ties", 4).first()
    assert [(r.k, r.t) for r in row.sample] == [(0, "z"), (1, None), (1, "a"), (1, "a")] and row.row_count == 5
    none = profile.summary(df.limit(0), "none").first()
    assert (none.row_count, none.n_columns, none.sample) == (0, 2, [])
