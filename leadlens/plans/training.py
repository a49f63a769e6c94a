"""Lifecycle C: train tiers, pick a winner, report test metrics.

* ``scored_mode`` – the seven composite scores, the stored split column
  (P5): fit the preprocessor on train, evaluate tiers on validation, select
  the winner (R1) and evaluate it once on test.
* ``raw_mode`` – the 77 numeric + 3 categorical feature columns, coerced
  (F17/F18), hash-split 80/20 (D1), evaluated on the test rows.

The preprocessor is fitted on training rows only and reused for every tier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.functions.exprs import normalise_category, to_number
from leadlens.operators import leaderboard as R
from leadlens.operators import models as M
from leadlens.operators import prep as T
from leadlens.operators import split as D
from leadlens.operators.scores import SCORE_COLUMNS

# Leakage-safe raw feature lists of the training script.
NUMERIC_FEATURES = (
    "channel_historical_cvr", "channel_volume", "has_campaign", "campaign_historical_cvr",
    "campaign_volume", "followup_count", "hours_to_first_followup", "avg_followup_interval_hours",
    "lead_age_days", "days_since_last_update", "is_fresh_7d", "is_fresh_30d", "lead_hour_of_day",
    "lead_day_of_week", "lead_month", "is_weekend_lead", "is_business_hours_lead",
    "is_owner_active", "owner_historical_cvr", "owner_workload_30d", "owner_tenure_days",
    "was_reassigned", "call_count", "sms_count", "email_count", "whatsapp_count",
    "engagement_intensity_score", "has_multi_channel_engagement", "total_activities",
    "total_calls_logged", "answered_calls", "total_call_duration_sec", "avg_call_duration_sec",
    "max_call_duration_sec", "call_answer_rate", "calls_with_recording", "unique_activity_types",
    "days_since_last_activity", "positive_intent_kw_count", "negative_intent_kw_count",
    "net_intent_score", "has_positive_intent", "has_negative_intent", "minutes_to_first_contact",
    "contacted_within_1hr", "contacted_within_24hrs", "never_contacted", "status_changed",
    "has_ctc", "has_experience", "has_company", "has_designation", "is_employed_professional",
    "has_salary_increment_goal", "has_real_email", "has_gender", "has_dob", "has_state",
    "has_city", "has_alternate_mobile", "has_best_time_to_call", "has_qualification",
    "has_pain_points", "profile_completeness_score", "is_chatbot", "is_voicebot", "is_duplicate",
    "contact_lead_count", "is_domestic", "is_repeat_contact", "is_facebook_lead",
    "fb_events_count", "fb_events_success", "fb_event_success_rate", "has_voicebot_interaction",
    "voicebot_call_count", "voicebot_initiated_count",
)
CATEGORICAL_FEATURES = ("lead_channel", "source_medium", "lead_type")
TARGET = "is_interested"
SCORED_TARGET = "converted"


def _keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several fits and evaluations read (spills to disk;
    a lost block is recomputed from lineage)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _featured(model, df: DataFrame) -> DataFrame:
    """The label and features of ``df``'s rows, kept: what tiers and evaluations read, without the columns behind them."""
    return _keep(model.transform(df).select("label", "features"))


def available(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """(present columns, missing columns) of a wanted list."""
    cols = set(df.columns)
    return [c for c in wanted if c in cols], [c for c in wanted if c not in cols]


def prepare(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
            extra: Sequence[str] = ()) -> DataFrame:
    """numeric coercion, categorical normalisation, 0/1 integer label."""
    return df.select(
        *extra,
        *[to_number(c).alias(c) for c in numeric],
        *[normalise_category(c).alias(c) for c in categorical],
        F.coalesce(to_number(target), F.lit(0.0)).cast("int").alias("label"),
    )


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """T4 + T1 + T3 + T5 fitted on training rows → PipelineModel producing ``features``."""
    prep = Pipeline(stages=T.preprocessor(numeric, categorical, drop_first=False)).fit(train)
    cols = T.assembled_columns(prep.stages, numeric)
    from pyspark.ml import PipelineModel
    return PipelineModel(stages=[*prep.stages,
                                 VectorAssembler(inputCols=cols, outputCol="features",
                                                 handleInvalid="keep")]), cols


def scored_mode(scored: DataFrame, tiers: Sequence[str] = M.TIERS, challenger: str = "gradient_boosting",
                parameters: str = "script"):
    feats, _missing = available(scored, SCORE_COLUMNS)
    data = _keep(prepare(scored, feats, [], SCORED_TARGET, extra=["lead_id", "split"]))
    train = data.where(F.col("split") == "train")
    val = data.where(F.col("split") == "validation")
    test = data.where(F.col("split") == "test")
    pre, cols = fit_preprocessor(train, feats, [])
    tr, va, te = (_featured(pre, x) for x in (train, val, test))
    runs, models = M.train_tiers(tr, va, tiers, challenger=challenger, parameters=parameters)
    ranked = R.rank_runs(runs)
    win = ranked.where(F.col("is_winner")).select("tier").first()["tier"]
    test_metrics = M.evaluate(models[win], te)
    return ranked, models, pre, cols, test_metrics


def raw_mode(features: DataFrame, tiers: Sequence[str] = M.TIERS, test_size: float = 0.2,
             challenger: str = "gradient_boosting", parameters: str = "script"):
    num, _ = available(features, NUMERIC_FEATURES)
    cat, _ = available(features, CATEGORICAL_FEATURES)
    data = _keep(prepare(features, num, cat, TARGET, extra=["lead_id"]))
    train, test = D.train_test_split(data, "lead_id", test_size, label_col="label", exact=True)
    pre, cols = fit_preprocessor(train, num, cat)
    tr, te = _featured(pre, train), _featured(pre, test)
    runs, models = M.train_tiers(tr, te, tiers, challenger=challenger, parameters=parameters)
    return R.rank_runs(runs), models, pre, cols


def table_mode(training: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
               target: str, id_col: str = "id", tiers: Sequence[str] = M.TIERS,
               test_size: float = 0.2, challenger: str = "gradient_boosting", parameters: str = "config"):
    """Config-driven training table: exact stratified split (D1), the feature
    pipeline (population scaler, drop-first one-hot, variance filter 0.01,
    fitted on train), tiers evaluated on test, winner selected (R1)."""
    data = training.select(id_col, *numeric, *categorical,
                           F.col(target).cast("int").alias("label"))
    flagged = _keep(D.exact_test_flag(data, id_col, "label", test_size))
    train = flagged.where(~F.col("_is_test")).drop("_is_test")
    test = flagged.where(F.col("_is_test")).drop("_is_test")
    fp = T.FeaturePipeline(numeric, categorical, impute=True).fit(train)
    runs, models = M.train_tiers(_featured(fp, train), _featured(fp, test), tiers, challenger=challenger, parameters=parameters)
    return R.rank_runs(runs), models, fp
