import pytest
from pyspark.sql import functions as F

from leadlens.operators import leaderboard as R
from leadlens.operators import models as M
from leadlens.operators import prep as T
from leadlens.operators import scoring as B
from leadlens.sources import synthetic
from leadlens.sources.csv_io import ALL_FIELDS
from leadlens.sources.testviews import CATEGORICAL_FEATURES, NUMERIC_FEATURES


@pytest.fixture(scope="module")
def prepared(spark):
    df = synthetic.learnable_leads(spark, 1500, seed=3).withColumnRenamed("intent_label", "label")
    fp = T.FeaturePipeline(list(NUMERIC_FEATURES), list(CATEGORICAL_FEATURES)).fit(df)
    return fp, fp.transform(df).cache()


def test_baseline_tier_learns(prepared):
    fp, data = prepared
    model, met, params = M.train_tier("baseline", data, data)
    m = met.first()
    assert m.roc_auc > 0.8 and 0 <= m.f1 <= 1
    probs = M.with_probability(model.transform(data)).agg(F.min("p1"), F.max("p1")).first()
    assert 0 <= probs[0] <= probs[1] <= 1
    imp = M.feature_importance(model, fp.columns, top_n=5).collect()
    assert len(imp) == 5 and imp[0].importance >= imp[-1].importance


def test_tree_tiers_small(prepared, monkeypatch):
    _, data = prepared
    small = data.limit(400)
    model, met, _ = M.train_tier("challenger", small, small, challenger="random_forest")
    assert met.first().roc_auc > 0.7
    runs = M.run_row("challenger", 0, "r0", met, {"n": "1"})
    assert R.winner(runs).first().tier == "challenger"


def test_cv_search(prepared):
    _, data = prepared
    cv = M.search(data.limit(300), "logistic_regression", n_trials=2, folds=2, parallelism=2)
    assert len(cv.avgMetrics) == 2 and max(cv.avgMetrics) > 0.7


def test_batch_scoring_and_streaming(spark, prepared, tmp_path):
    fp, data = prepared
    model, _, _ = M.train_tier("baseline", data, data)
    from pyspark.ml import PipelineModel
    full = PipelineModel(stages=[*fp.model.stages, model])
    req = synthetic.learnable_leads(spark, 30, seed=11)
    out = B.score_batch(full, req, "id", "req").orderBy("id").collect()
    assert out[0].prediction_id == "pred_req_0" and out[-1].prediction_id == "pred_req_29"
    assert all(abs(r.confidence - max(r.probability, 1 - r.probability)) < 1e-12 for r in out)
    summary = B.batch_summary(B.score_batch(full, req, "id", "req")).first()
    assert summary.total == 30 and summary.high_intent_pct == int(summary.high_intent * 100 / 30 + 0.5)

    from leadlens.streaming.scoring_stream import scoring_stream
    src, sink = tmp_path / "in", tmp_path / "out"
    req.select("id", *ALL_FIELDS).write.parquet(str(src))
    q = scoring_stream(spark, full, str(src), req.select("id", *ALL_FIELDS).schema, str(sink),
                       request_id="s", checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert q.exception() is None
    got = spark.read.parquet(str(sink))
    assert got.count() == 30 and got.where("probability < 0 or probability > 1").count() == 0
    # every streamed request gets its own prediction id
    assert got.select("prediction_id").distinct().count() == 30
    assert got.where(~F.col("prediction_id").startswith("pred_s_0_")).count() == 0


def test_tier_parameter_mapping():
    lr, p = M.build_classifier("baseline", 1000, 2.0)
    assert abs(lr.getRegParam() - 1e-3) < 1e-15 and not lr.getStandardization()
    gbt, p2 = M.build_classifier("challenger", 1000, 2.0)
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSubsamplingRate()) == (200, 4, 0.05, 0.8)
    champ, p3 = M.build_classifier("champion", 1000, 2.04)
    assert (champ.getMaxIter(), champ.getMaxDepth(), champ.getFeatureSubsetStrategy()) == (300, 6, "0.8")
    assert champ.getWeightCol() == "weight" and p3["scale_pos_weight"] == "2.04"


def test_champion_weighted_fit_smoke(prepared):
    # a short fit of the champion configuration checks the weighted pipeline end to end
    _, data = prepared
    small = M.pos_weighted(data.limit(300), "label", 2.0)
    clf, _ = M.build_classifier("champion", 300, 2.0)
    model = clf.copy({clf.maxIter: 3}).fit(small)
    assert M.evaluate(model, small).first().roc_auc > 0.6


def test_fit_stable_under_repartition(prepared):
    _, data = prepared
    a, _, _ = M.train_tier("baseline", data.repartition(1), data)
    b, _, _ = M.train_tier("baseline", data.repartition(7), data)
    assert max(abs(x - y) for x, y in zip(a.coefficients, b.coefficients)) < 1e-3


def test_raw_mode_on_feature_table(spark):
    from leadlens.plans.feature_build import feature_table
    from leadlens.plans.training import raw_mode
    from tests.conftest import SF_SMALL

    ranked, models, pre, cols = raw_mode(feature_table(spark, SF_SMALL), ["baseline"])
    r = ranked.first()
    assert r.tier == "baseline" and r.is_winner and 0 <= r.primary_metric <= 1
    assert any(c.startswith("lead_channel_") for c in cols) and "lead_age_days" in cols


def test_table_mode_and_validated_load(spark, tmp_path):
    from leadlens.plans.training import table_mode
    from leadlens.sources.tables import load_training

    df = synthetic.sample_leads(spark, 600)
    df.write.parquet(str(tmp_path / "train"))
    loaded, report = load_training(spark, str(tmp_path / "train"), list(NUMERIC_FEATURES),
                                   list(CATEGORICAL_FEATURES))
    assert report["duplicates"].first()[0] == 0 and report["dtype_warnings"] == []
    ranked, models, fp = table_mode(loaded, list(NUMERIC_FEATURES), list(CATEGORICAL_FEATURES),
                                    "intent_label", tiers=["baseline"])
    assert ranked.first().is_winner and "baseline" in models and fp.columns


@pytest.mark.parametrize(("parameters", "tier", "want"), [
    ("script", "challenger", (200, 4, 0.05, 1)), ("config", "challenger", (100, 3, 0.1, 1)),
    ("script", "champion", (300, 6, 0.05, 5)), ("config", "champion", (100, 6, 0.1, 1))])
def test_parameter_sets_reach_the_estimator(parameters, tier, want):
    trees, shown = M.build_classifier(tier, 100, 2.0, parameters=parameters)
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), trees.getMinInstancesPerNode()) == want
    assert trees.getSubsamplingRate() == 0.8 and shown["learning_rate"] == str(want[2])


def test_tiers_take_challenger_and_parameters(prepared, monkeypatch):
    monkeypatch.setitem(M.BOOSTING, "tiny", {"challenger": {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1},
                                             "champion": {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1,
                                                          "min_child_weight": 1}})
    _, data = prepared
    runs, models = M.train_tiers(data, data, ["challenger", "champion"], parameters="tiny")
    rows = {r.tier: r for r in runs.collect()}
    assert all(r.params["n_estimators"] == "2" and 0.5 < r.metrics["roc_auc"] <= 1 for r in rows.values())
    for model in models.values():
        low, high = M.with_probability(model.transform(data)).agg(F.min("p1"), F.max("p1")).first()
        assert 0 <= low < high <= 1 and model.getNumTrees == 2
    with pytest.raises(ValueError, match="challenger must be"):
        M.build_classifier("challenger", 10, 1.0, challenger="other")


def test_table_mode_keeps_only_labels_and_features(spark, monkeypatch):
    from leadlens.plans import training
    from leadlens.sources import testviews as views

    kept = []
    monkeypatch.setattr(training, "_keep", lambda df: kept.append(df.columns) or df.persist())
    rows = views.training_view(spark, "/root/testdata/sf0.001")
    ranked, models, fp = training.table_mode(rows, list(views.NUMERIC_FEATURES), list(views.CATEGORICAL_FEATURES), views.TARGET,
                                             tiers=["baseline"])
    assert [r.tier for r in ranked.collect()] == ["baseline"] and len(models["baseline"].coefficients) == len(fp.columns)
    assert kept[1:] == [["label", "features"]] * 2
