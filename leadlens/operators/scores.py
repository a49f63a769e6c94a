"""Composite 0–100 scores (C1–C7) and their p95 normalisers.

The normalisers are one exact-percentile row (``ordered.exact_quantiles``)
cross-joined to the feature table; a one-row side is the only broadcast here.
Final scores are not clipped (a future-dated lead ages above 100), matching
the source code rather than its README.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions.exprs import clip, exp_decay
from leadlens.operators.joins import attach_row
from leadlens.operators.ordered import exact_quantiles

SCORE_COLUMNS = ("eligibility_score", "demographic_score", "quality_score", "engagement_score",
                 "intent_score", "campaign_score", "lead_aging")

P95_SOURCES = {"p95_channel_cvr": "channel_historical_cvr",
               "p95_campaign_cvr": "campaign_historical_cvr",
               "p95_engagement": "engagement_intensity_score"}


def p95_params(features: DataFrame) -> DataFrame:
    """One row of p95 of the non-null values; a p95 ≤ 0 (or none) becomes 1.0."""
    q = exact_quantiles(features, list(P95_SOURCES.values()), [0.95])
    return q.select(*[
        F.when(F.col(f"{src}_q0") > 0, F.col(f"{src}_q0")).otherwise(F.lit(1.0)).alias(name)
        for name, src in P95_SOURCES.items()])


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def eligibility(df=None) -> Column:
    return (_d("is_employed_professional") * 25 + _d("has_ctc") * 20 + _d("has_experience") * 15
            + _d("has_salary_increment_goal") * 15 + _d("has_qualification") * 15
            + _d("is_domestic") * 10)


def demographic() -> Column:
    return (_d("profile_completeness_score") / 12 * 60 + _d("has_real_email") * 15
            + _d("has_alternate_mobile") * 10 + _d("has_best_time_to_call") * 10
            + _d("has_pain_points") * 5)


def quality(p95_channel: Column) -> Column:
    norm = clip(_d("channel_historical_cvr") / p95_channel, 0, 1)
    return ((1 - _d("is_duplicate")) * 30 + _d("has_real_email") * 20 + (1 - _d("is_chatbot")) * 15
            + norm * 25 + _d("is_repeat_contact") * 10)


def engagement(p95_engagement: Column) -> Column:
    norm = clip(_d("engagement_intensity_score") / p95_engagement, 0, 1)
    return (norm * 40 + _d("call_answer_rate") * 25 + _d("has_multi_channel_engagement") * 20
            + _d("has_positive_intent") * 15)


def intent() -> Column:
    norm = clip((clip(_d("net_intent_score"), -10, 15) + 10) / 25, 0, 1)
    return (norm * 35 + _d("contacted_within_1hr") * 25 + _d("has_positive_intent") * 20
            + (1 - _d("has_negative_intent")) * 20)


def campaign(p95_channel: Column, p95_campaign: Column) -> Column:
    ch = clip(_d("channel_historical_cvr") / p95_channel, 0, 1)
    cp = clip(_d("campaign_historical_cvr") / p95_campaign, 0, 1)
    return ch * 50 + cp * 40 + _d("has_campaign") * 10


def lead_aging() -> Column:
    return exp_decay(_d("lead_age_days"))


def score_table(features: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """Feature table → lead id, seven scores, ``converted``."""
    params = params if params is not None else p95_params(features)
    j = attach_row(features, params)
    return j.select(
        F.col("lead_id"),
        eligibility().alias("eligibility_score"),
        demographic().alias("demographic_score"),
        quality(F.col("p95_channel_cvr")).alias("quality_score"),
        engagement(F.col("p95_engagement")).alias("engagement_score"),
        intent().alias("intent_score"),
        campaign(F.col("p95_channel_cvr"), F.col("p95_campaign_cvr")).alias("campaign_score"),
        lead_aging().alias("lead_aging"),
        F.col("is_interested").cast("int").alias("converted"),
    )
