"""Registered queries: scores, normalisers, splits, summaries (C, A8–A12, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.operators import scores as C
from leadlens.operators import split as D
from leadlens.operators import summaries as S
from leadlens.plans.feature_build import stored_feature_table as feature_table
from leadlens.plans.oracle_features import COMPUTED_TS, features_with
from leadlens.plans.registry import register
from leadlens.plans.scored_build import scored_build_summary, scored_from_features
from leadlens.sources import testviews as TV

P95 = """p95 AS (
  SELECT
    CASE WHEN quantile_cont(CAST(channel_historical_cvr AS DOUBLE), 0.95) > 0
         THEN quantile_cont(CAST(channel_historical_cvr AS DOUBLE), 0.95) ELSE 1.0 END AS p95_channel_cvr,
    CASE WHEN quantile_cont(CAST(campaign_historical_cvr AS DOUBLE), 0.95) > 0
         THEN quantile_cont(CAST(campaign_historical_cvr AS DOUBLE), 0.95) ELSE 1.0 END AS p95_campaign_cvr,
    CASE WHEN quantile_cont(CAST(engagement_intensity_score AS DOUBLE), 0.95) > 0
         THEN quantile_cont(CAST(engagement_intensity_score AS DOUBLE), 0.95) ELSE 1.0 END AS p95_engagement
  FROM feat
)"""


def _clip(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest(({x}), {lo}), {hi}) END)"


def _d(c: str) -> str:
    return f"CAST(f.{c} AS DOUBLE)"


HASH = ("(('0x' || substr(md5('42:' || CAST(f.lead_id AS VARCHAR)), 1, 8))::UBIGINT "
        "/ 4294967296.0::DOUBLE)")

SCORED = f"""scores AS (
  SELECT
    f.lead_id,
    {_d('is_employed_professional')} * 25 + {_d('has_ctc')} * 20 + {_d('has_experience')} * 15
      + {_d('has_salary_increment_goal')} * 15 + {_d('has_qualification')} * 15
      + {_d('is_domestic')} * 10 AS eligibility_score,
    {_d('profile_completeness_score')} / 12 * 60 + {_d('has_real_email')} * 15
      + {_d('has_alternate_mobile')} * 10 + {_d('has_best_time_to_call')} * 10
      + {_d('has_pain_points')} * 5 AS demographic_score,
    (1 - {_d('is_duplicate')}) * 30 + {_d('has_real_email')} * 20 + (1 - {_d('is_chatbot')}) * 15
      + {_clip(_d('channel_historical_cvr') + ' / p.p95_channel_cvr', '0', '1')} * 25
      + {_d('is_repeat_contact')} * 10 AS quality_score,
    {_clip(_d('engagement_intensity_score') + ' / p.p95_engagement', '0', '1')} * 40
      + {_d('call_answer_rate')} * 25 + {_d('has_multi_channel_engagement')} * 20
      + {_d('has_positive_intent')} * 15 AS engagement_score,
    {_clip('(' + _clip(_d('net_intent_score'), '-10', '15') + ' + 10) / 25', '0', '1')} * 35
      + {_d('contacted_within_1hr')} * 25 + {_d('has_positive_intent')} * 20
      + (1 - {_d('has_negative_intent')}) * 20 AS intent_score,
    {_clip(_d('channel_historical_cvr') + ' / p.p95_channel_cvr', '0', '1')} * 50
      + {_clip(_d('campaign_historical_cvr') + ' / p.p95_campaign_cvr', '0', '1')} * 40
      + {_d('has_campaign')} * 10 AS campaign_score,
    round_even(100 * exp(-{_d('lead_age_days')} / 30), 2) AS lead_aging,
    CAST(f.is_interested AS INTEGER) AS converted,
    row_number() OVER (PARTITION BY f.is_interested ORDER BY {HASH}, f.lead_id) AS rk,
    round(count(*) OVER (PARTITION BY f.is_interested) * CAST(0.3 AS DOUBLE)) AS n_out,
    {COMPUTED_TS} AS scored_at
  FROM feat f CROSS JOIN p95 p
),
scored AS (
  SELECT * EXCLUDE (rk, n_out, scored_at),
    CASE WHEN rk <= round(n_out * (CAST(1 AS DOUBLE) / 3)) THEN 'test'
         WHEN rk <= n_out THEN 'validation' ELSE 'train' END AS split, scored_at
  FROM scores
)"""


def _scored(spark, sf_dir):
    return scored_from_features(feature_table(spark, sf_dir), TV.COMPUTED_AT)


@register("c1_c7_scored_table", features_with(P95, SCORED) + "SELECT * FROM scored")
def q_scored_table(spark, sf_dir):
    return _scored(spark, sf_dir)


@register("a12_p95_params", features_with(P95) + "SELECT * FROM p95")
def q_p95(spark, sf_dir):
    return C.p95_params(feature_table(spark, sf_dir))


@register("d2_split_sizes", features_with(P95, SCORED) +
          "SELECT split, converted, CAST(count(*) AS BIGINT) AS n FROM scored GROUP BY split, converted")
def q_split_sizes(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("split", "converted").agg(F.count(F.lit(1)).alias("n"))


_EXACT_SPLIT = """labelled AS (
  SELECT lead_id, CASE WHEN lead_id % 7 <> 3 THEN is_interested END AS is_interested FROM feat
),
ranked AS (
  SELECT lead_id, is_interested,
    row_number() OVER (PARTITION BY is_interested ORDER BY
      (('0x' || substr(md5('42:' || CAST(lead_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0::DOUBLE), lead_id) AS rk,
    count(*) OVER (PARTITION BY is_interested) AS n_cls
  FROM labelled
)"""


@register("d1_exact_stratified_test", features_with(_EXACT_SPLIT) +
          "SELECT lead_id, is_interested, rk <= round(n_cls * CAST(0.2 AS DOUBLE)) AS is_test FROM ranked")
def q_exact_split(spark, sf_dir):
    """Every row with its side; every seventh label is unknown, which is a class of its own."""
    f = feature_table(spark, sf_dir).select(
        "lead_id", F.when(F.col("lead_id") % 7 != 3, F.col("is_interested")).alias("is_interested"))
    train, test = D.train_test_split(f, "lead_id", 0.2, label_col="is_interested", exact=True)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))).select(
        "lead_id", "is_interested", "is_test")


@register("d1_hash_split_test", features_with() +
          "SELECT lead_id FROM feat WHERE "
          "(('0x' || substr(md5('42:' || CAST(lead_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0::DOUBLE) < 0.2")
def q_hash_split(spark, sf_dir):
    f = feature_table(spark, sf_dir).select("lead_id")
    return D.train_test_split(f, "lead_id", 0.2)[1]


A8_SQL = """SELECT
  CAST(count(*) AS BIGINT) AS total_rows,
  CAST(coalesce(sum(is_interested), 0) AS BIGINT) AS positive_class,
  coalesce(round_even(sum(is_interested) / nullif(count(*), 0), 4), 0.0) AS positive_rate,
  CAST(coalesce(sum(never_contacted), 0) AS BIGINT) AS never_contacted_count,
  CAST(coalesce(sum(is_facebook_lead), 0) AS BIGINT) AS facebook_lead_count,
  CAST(coalesce(sum(has_voicebot_interaction), 0) AS BIGINT) AS voicebot_lead_count,
  round_even(avg(CASE WHEN minutes_to_first_contact IS NULL THEN 1.0 ELSE 0.0 END), 3) AS null_rate_first_contact,
  round_even(avg(CASE WHEN hours_to_first_followup IS NULL THEN 1.0 ELSE 0.0 END), 3) AS null_rate_first_followup,
  round_even(avg(CASE WHEN hours_to_interested_stage IS NULL THEN 1.0 ELSE 0.0 END), 3) AS null_rate_interested_stage,
  round_even(avg(CASE WHEN channel_historical_cvr = 0 THEN 1.0 ELSE 0.0 END), 3) AS null_rate_channel_cvr,
  round_even(avg(CASE WHEN owner_historical_cvr = 0 THEN 1.0 ELSE 0.0 END), 3) AS null_rate_owner_cvr,
  round_even(avg(lead_age_days), 1) AS avg_lead_age_days,
  round_even(avg(engagement_intensity_score), 2) AS avg_engagement_score,
  round_even(avg(profile_completeness_score), 2) AS avg_profile_score,
  round_even(avg(net_intent_score), 3) AS avg_net_intent_score,
  round_even(avg(total_call_duration_sec), 0) AS avg_total_call_duration_sec
FROM feat"""


@register("a8_build_stats", features_with() + A8_SQL)
def q_build_stats(spark, sf_dir):
    return S.build_stats(feature_table(spark, sf_dir))


def _corr_sql() -> str:
    parts = []
    for c in S.CORRELATION_FEATURES:
        x = f"CASE WHEN is_interested IS NOT NULL THEN CAST({c} AS DOUBLE) END"
        y = f"CASE WHEN {c} IS NOT NULL THEN CAST(is_interested AS DOUBLE) END"
        den = f"(stddev_pop({x}) * stddev_pop({y}))"
        parts.append(f"SELECT '{c}' AS feature, round_even(covar_pop({x}, {y}) / "
                     f"CASE WHEN {den} > 0 THEN {den} END, 4) AS correlation FROM feat")
    return ("SELECT feature, correlation FROM (" + " UNION ALL ".join(parts) + ") t "
            "WHERE correlation IS NOT NULL ORDER BY abs(correlation) DESC, feature LIMIT 15")


@register("a9_o1_target_correlations", features_with() + _corr_sql())
def q_correlations(spark, sf_dir):
    return S.target_correlations(feature_table(spark, sf_dir))


def _a10_sql() -> str:
    means = ", ".join(f"round_even(avg({c}), 4) AS mean_{c}" for c in C.SCORE_COLUMNS)
    return f"""SELECT
  CAST(count(*) AS BIGINT) AS total_rows,
  CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_rows,
  CAST(count(*) FILTER (WHERE split = 'validation') AS BIGINT) AS val_rows,
  CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_rows,
  avg(converted) AS positive_rate,
  CAST(coalesce(sum(converted), 0) AS BIGINT) AS positive_class,
  {means},
  (SELECT round_even(p95_channel_cvr, 6) FROM p95) AS p95_channel_cvr,
  (SELECT round_even(p95_campaign_cvr, 6) FROM p95) AS p95_campaign_cvr,
  (SELECT round_even(p95_engagement, 4) FROM p95) AS p95_engagement
FROM scored"""


@register("a10_scored_summary", features_with(P95, SCORED) + _a10_sql())
def q_scored_summary(spark, sf_dir):
    feats = feature_table(spark, sf_dir)
    params = C.p95_params(feats)
    return scored_build_summary(scored_from_features(feats, TV.COMPUTED_AT, params), params)


A11_SQL = """SELECT
  CAST(count(*) FILTER (WHERE converted = 1) AS BIGINT) AS n_pos,
  CAST(count(*) FILTER (WHERE converted = 0) AS BIGINT) AS n_neg,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE converted = 1) / count(*) ELSE 0.0 END AS positive_rate,
  CASE WHEN count(*) FILTER (WHERE converted = 1) > 0
       THEN round_even(count(*) FILTER (WHERE converted = 0) / count(*) FILTER (WHERE converted = 1), 2)
       ELSE 1.0 END AS scale_pos_weight
FROM scored WHERE split = 'train'"""


@register("a11_p5_class_balance_train", features_with(P95, SCORED) + A11_SQL)
def q_class_balance(spark, sf_dir):
    return S.class_balance(_scored(spark, sf_dir).where(F.col("split") == "train"), "converted")
