"""One-row summaries of built tables.

Each is a single global aggregate (partial per task, one tiny final merge);
nothing is collected.  Rounding of rates and means is half-even, like the
Python ``round`` of the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.operators.joins import attach_row

# Fixed value: the 20 features whose correlation with the target is reported.
CORRELATION_FEATURES = (
    "channel_historical_cvr", "campaign_historical_cvr", "owner_historical_cvr",
    "engagement_intensity_score", "profile_completeness_score", "net_intent_score",
    "minutes_to_first_contact", "total_call_duration_sec", "call_answer_rate",
    "followup_count", "lead_age_days", "contacted_within_1hr",
    "is_employed_professional", "has_positive_intent", "is_repeat_contact",
    "was_reassigned", "is_facebook_lead", "is_owner_active",
    "has_voicebot_interaction", "is_fresh_7d",
)


def _rate(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def build_stats(features: DataFrame) -> DataFrame:
    """Row counts, null/zero rates and means of the feature table."""
    n = F.count(F.lit(1))
    pos = F.sum("is_interested")
    return features.agg(
        n.alias("total_rows"),
        F.coalesce(pos, F.lit(0)).cast("long").alias("positive_class"),
        F.coalesce(F.bround(pos / F.nullif(n, F.lit(0)), 4), F.lit(0.0)).alias("positive_rate"),
        F.coalesce(F.sum("never_contacted"), F.lit(0)).cast("long").alias("never_contacted_count"),
        F.coalesce(F.sum("is_facebook_lead"), F.lit(0)).cast("long").alias("facebook_lead_count"),
        F.coalesce(F.sum("has_voicebot_interaction"), F.lit(0)).cast("long").alias("voicebot_lead_count"),
        F.bround(_rate(F.col("minutes_to_first_contact").isNull()), 3).alias("null_rate_first_contact"),
        F.bround(_rate(F.col("hours_to_first_followup").isNull()), 3).alias("null_rate_first_followup"),
        F.bround(_rate(F.col("hours_to_interested_stage").isNull()), 3).alias("null_rate_interested_stage"),
        F.bround(_rate(F.col("channel_historical_cvr") == 0), 3).alias("null_rate_channel_cvr"),
        F.bround(_rate(F.col("owner_historical_cvr") == 0), 3).alias("null_rate_owner_cvr"),
        F.bround(F.avg("lead_age_days"), 1).alias("avg_lead_age_days"),
        F.bround(F.avg("engagement_intensity_score"), 2).alias("avg_engagement_score"),
        F.bround(F.avg("profile_completeness_score"), 2).alias("avg_profile_score"),
        F.bround(F.avg("net_intent_score"), 3).alias("avg_net_intent_score"),
        F.bround(F.avg("total_call_duration_sec"), 0).alias("avg_total_call_duration_sec"),
    )


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; null if undefined.

    Built from population moments so a constant column yields null instead of
    the ANSI divide-by-zero that ``corr`` raises.
    """
    xm = F.when(F.col(y).isNotNull(), F.col(x).cast("double"))
    ym = F.when(F.col(x).isNotNull(), F.col(y).cast("double"))
    den = F.stddev_pop(xm) * F.stddev_pop(ym)
    return F.covar_pop(xm, ym) / F.when(den > 0, den)


def target_correlations(features: DataFrame, target: str = "is_interested",
                        columns: Sequence[str] = CORRELATION_FEATURES, top: int = 15) -> DataFrame:
    """A9 + O1: correlations with the target, undefined dropped, top by |r|."""
    present = [c for c in columns if c in features.columns]
    one = features.agg(*[F.bround(pearson(c, target), 4).alias(c) for c in present])
    pairs = ", ".join(f"'{c}', `{c}`" for c in present)
    long = one.selectExpr(f"stack({len(present)}, {pairs}) AS (feature, correlation)")
    return (long.where(F.col("correlation").isNotNull())
            .orderBy(F.abs("correlation").desc(), F.col("feature")).limit(top))


def scored_summary(scored: DataFrame, params: DataFrame,
                   score_columns: Sequence[str]) -> DataFrame:
    """A10: split sizes, positive rate and count, score means, normalisers."""
    s = scored.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "validation").alias("val_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.avg("converted").alias("positive_rate"),
        F.coalesce(F.sum("converted"), F.lit(0)).cast("long").alias("positive_class"),
        *[F.bround(F.avg(c), 4).alias(f"mean_{c}") for c in score_columns],
    )
    p = params.select(F.bround("p95_channel_cvr", 6).alias("p95_channel_cvr"),
                      F.bround("p95_campaign_cvr", 6).alias("p95_campaign_cvr"),
                      F.bround("p95_engagement", 4).alias("p95_engagement"))
    return attach_row(s, p)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives, rate and ``scale_pos_weight`` (1.0 without positives)."""
    y = F.coalesce(F.col(label).try_cast("double"), F.lit(0.0))
    agg = df.agg(F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg"),
                 F.count(F.lit(1)).alias("n_rows"))
    return agg.select(
        "n_pos", "n_neg",
        F.when(F.col("n_rows") > 0, F.col("n_pos") / F.col("n_rows")).otherwise(F.lit(0.0))
         .alias("positive_rate"),
        F.when(F.col("n_pos") > 0, F.bround(F.col("n_neg") / F.col("n_pos"), 2))
         .otherwise(F.lit(1.0)).alias("scale_pos_weight"),
    )
