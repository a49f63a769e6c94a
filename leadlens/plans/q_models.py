"""Registered queries: preprocessing (T1–T6) and the baseline tier (M1, M5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadlens.operators import models as M
from leadlens.operators import prep as T
from leadlens.operators import split as D
from leadlens.operators.sparse_onehot import SparseOneHot
from leadlens.plans.oracle_views import with_training
from leadlens.plans.registry import register
from leadlens.sources import testviews as TV

SCALED = TV.NUMERIC_FEATURES


def _training(spark, sf_dir):
    return TV.training_view(spark, sf_dir)


@register("t1_population_scaler", with_training() + "SELECT id, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM training)) / "
    f"coalesce(nullif((SELECT stddev_pop({c}) FROM training), 0), 1.0) AS {c}" for c in SCALED)
    + " FROM training")
def q_scaler(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *SCALED)
    return T.PopulationScaler(list(SCALED)).fit(t).transform(t)


# The levels of the driver's tables, in order.
ONEHOT_LEVELS = {
    "industry": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "company_type": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    "location": ("R0", "R1", "R2", "R3"),
    "product_interest": ("F", "O", "P"),
    "source": ("Direct", "Event", "LinkedIn", "Partner"),
    "sales_stage": ("", "Awareness", "Consideration", "Decision", "Qualification"),
}


@register("t2_onehot_drop_first", with_training() + "SELECT id, " + ", ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{c}_{v}\""
    for c, levels in ONEHOT_LEVELS.items() for v in levels[1:]) + " FROM training")
def q_onehot_drop(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *ONEHOT_LEVELS)
    return T.OneHot(list(ONEHOT_LEVELS), dropFirst=True).fit(t).transform(t).drop(*ONEHOT_LEVELS)


@register("t3_onehot_all_levels", with_training() + "SELECT id, " + ", ".join(
    f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{c}_{v}\""
    for c, levels in ONEHOT_LEVELS.items() for v in levels) + " FROM training")
def q_onehot_all(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *ONEHOT_LEVELS)
    return T.OneHot(list(ONEHOT_LEVELS), dropFirst=False).fit(t).transform(t).drop(*ONEHOT_LEVELS)


@register("t2_t3_sparse_levels", with_training() + " UNION ALL ".join(
    f"SELECT id, '{c}' AS \"column\", {c} AS level FROM training "
    f"WHERE {c} IS NOT NULL AND {c} > (SELECT min({c}) FROM training)" for c in ONEHOT_LEVELS))
def q_sparse_levels(spark, sf_dir):
    """The levels that are 1 in each row's sparse vector, read back through the stored dictionary."""
    t = _training(spark, sf_dir).select("id", *ONEHOT_LEVELS)
    model = SparseOneHot(list(ONEHOT_LEVELS), dropFirst=True).fit(t)
    hot = model.slots(t).select("id", F.explode("slots").alias("slot"))
    return hot.join(model.levels(), "slot").select("id", "column", "level")


@register("m6_stratified_folds", with_training() + """, placed AS (
SELECT id, intent_label, count(*) OVER (PARTITION BY intent_label) AS n,
  row_number() OVER (PARTITION BY intent_label ORDER BY ('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 8))::UBIGINT, id) AS place
FROM training)
SELECT id, intent_label, CAST(len(list_filter([1, 2, 3, 4], lambda i: place > n * i // 5)) AS INTEGER) AS fold FROM placed""")
def q_folds(spark, sf_dir):
    """The fold of every training row; a class's folds differ by one row at most."""
    t = _training(spark, sf_dir).select("id", "intent_label")
    return M.stratified_folds(t, "id", "intent_label", 5)


_TRAIN_ROWS = ("(('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 8))::UBIGINT "
               "/ 4294967296.0::DOUBLE) >= 0.2")
_IMPUTED = TV.NUMERIC_FEATURES


@register("t4_median_imputer_train_fit", with_training() + "SELECT id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM training "
    f"WHERE {_TRAIN_ROWS})) AS {c}" for c in _IMPUTED) + ", " + ", ".join(
    f"coalesce({c}, 'missing') AS {c}" for c in TV.CATEGORICAL_FEATURES) + " FROM training")
def q_imputer(spark, sf_dir):
    t = _training(spark, sf_dir).select("id", *_IMPUTED, *TV.CATEGORICAL_FEATURES)
    train, _ = D.train_test_split(t, "id", 0.2)
    model = T.MedianImputer(list(_IMPUTED)).fit(train)
    return T.ConstantImputer(list(TV.CATEGORICAL_FEATURES)).transform(model.transform(t))


@register("t6_variance_filter", with_training() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(var_pop({c}) AS DOUBLE) AS variance, "
    f"coalesce(var_pop({c}) > 0.01, false) AS kept FROM training"
    for c in (*TV.NUMERIC_FEATURES, "intent_label")))
def q_variance(spark, sf_dir):
    t = _training(spark, sf_dir)
    return T.variance_table(t, [*TV.NUMERIC_FEATURES, "intent_label"], 0.01)


@register("m1_m5_baseline_scored_mode")
def q_baseline(spark, sf_dir):
    """Baseline tier on the scored table: run results + |coefficient| importances.

    Iterative fit, so there is no SQL oracle; tests hold it against an independent solution.
    """
    from leadlens.plans.q_eval import scored
    from leadlens.plans.training import scored_mode

    ranked, models, _pre, cols, _test = scored_mode(scored(spark, sf_dir), ["baseline"])
    imp = M.feature_importance(models["baseline"], cols, spark=spark)
    run = ranked.select("tier", "run_id", F.col("primary_metric"))
    return run.select("tier", "run_id", "primary_metric").unionByName(
        imp.select(F.col("feature").alias("tier"), F.lit("importance").alias("run_id"),
                   F.col("importance").alias("primary_metric")))


@register("m1_table_mode_baseline")
def q_table_mode(spark, sf_dir):
    """Baseline tier on the small lead table (config features, exact stratified
    split, population scaler + drop-first one-hot + variance filter).

    Iterative fit, so rows-only: one run row per tier.
    """
    from leadlens.plans.training import table_mode

    ranked, _models, _fp = table_mode(_training(spark, sf_dir), list(TV.NUMERIC_FEATURES),
                                      list(TV.CATEGORICAL_FEATURES), TV.TARGET, tiers=["baseline"])
    return ranked.select("tier", "run_id", "primary_metric", "rank", "is_winner")


# Coefficients of a logistic model over the seven scores, so that SQL can say what scoring has to give.
WEIGHTS = {"eligibility_score": 0.021, "demographic_score": -0.013, "quality_score": 0.034, "engagement_score": 0.047,
           "intent_score": 0.028, "campaign_score": -0.019, "lead_aging": 0.011}
INTERCEPT = -4.5


def literal_pipeline(spark):
    """A fitted pipeline with the coefficients above, saved and loaded back like any trained one."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import VectorAssembler

    from leadlens.session import checkpoint_dir

    jvm = spark.sparkContext._jvm
    values = spark.sparkContext._gateway.new_array(jvm.double, len(WEIGHTS))
    for i, w in enumerate(WEIGHTS.values()):
        values[i] = w
    java = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "literal", jvm.org.apache.spark.ml.linalg.Vectors.dense(values), INTERCEPT)
    model = LogisticRegressionModel(java)
    model._resetUid(java.uid())
    model.setFeaturesCol("features")
    stages = [VectorAssembler(inputCols=list(WEIGHTS), outputCol="features"), model]
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{spark.sparkContext.applicationId}/literal-{uuid.uuid4().hex}"
    PipelineModel(stages=stages).write().save(path)
    return PipelineModel.load(path)


def _requests(spark, sf_dir):
    """Every scored lead is a request."""
    from leadlens.plans.q_eval import scored

    return scored(spark, sf_dir).select("lead_id", *WEIGHTS)


_P = "1 / (1 + exp(-(" + " + ".join(f"{w} * {c}" for c, w in WEIGHTS.items()) + f" + {INTERCEPT})))"
_SCORED_SQL = """SELECT lead_id, {id} AS prediction_id, round(p, 6) AS probability, p > 0.5 AS predicted_label,
  'v1.0.0' AS model_version, round(greatest(p, 1 - p), 6) AS confidence FROM requests"""


def _scoring_sql(prediction_id: str) -> str:
    from leadlens.plans.oracle_features import features_with
    from leadlens.plans.q_scores import P95, SCORED

    return features_with(P95, SCORED, f"requests AS (SELECT *, {_P} AS p FROM scored)") + _SCORED_SQL.format(id=prediction_id)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("probability", "confidence")})


@register("b1_batch_scoring", _scoring_sql("'pred_batch_' || CAST(row_number() OVER (ORDER BY lead_id) - 1 AS VARCHAR)"))
def q_batch_scoring(spark, sf_dir):
    """B1: score every lead in one transform; ids pred_<request>_<i> in lead order."""
    from leadlens.operators.scoring import score_batch

    return _rounded(score_batch(literal_pipeline(spark), _requests(spark, sf_dir), "lead_id", "batch"))


@register("b2_streaming_scoring", _scoring_sql("'pred_' || CAST(lead_id AS VARCHAR)"))
def q_streaming_scoring(spark, sf_dir):
    """B2: every lead lands in request files and is scored by a streaming
    query (availableNow trigger); returns the sink table."""
    from leadlens.session import checkpoint_dir
    from leadlens.streaming.scoring_stream import scoring_stream

    # one folder per invocation: requests, sink and stream checkpoint start empty
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    req = _requests(spark, sf_dir)
    req.write.mode("overwrite").parquet(f"{base}/requests")
    q = scoring_stream(spark, literal_pipeline(spark), f"{base}/requests", req.schema,
                       f"{base}/scored", request_id="stream", checkpoint=f"{base}/checkpoint",
                       key_col="lead_id")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _rounded(spark.read.parquet(f"{base}/scored").drop("batch_id", *WEIGHTS))
