"""Per-key aggregates of the CRM sources.

Each aggregate is a ``groupBy().agg()``; Spark runs a partial (map-side)
aggregate before the shuffle, so a hot key (one lead with a third of all
activities, one channel with a third of all leads) is reduced to one row per
task before it moves.  Distinct counts dedup on (key, value) first, which
shuffles on the pair and therefore spreads a hot key too.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.functions import exprs as X

# Keyword patterns of the activity text rules.  "not interested"
# also matches the positive "interested" and "fee" matches "coffee"; both are
# kept on purpose.
POSITIVE_DETAILS = ("interested", "want to enroll", "fee", "admission", "will join",
                    "joining", "callback", "ready to")
POSITIVE_DESCRIPTION = ("interested", "want to enroll", "fee")
NEGATIVE_DETAILS = ("not interested", "wrong number", "not responding", "do not call",
                    "not received", "switched off")
NEGATIVE_DESCRIPTION = ("not interested", "not responding")
ANSWERED_STATUSES = ("answered", "connected")
VOICEBOT_ID_PATH = "$.lead_id"
VOICEBOT_STARTED_STATUS = "202"


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


# A1 -------------------------------------------------------------------------
def activity_aggregate(
    activities: DataFrame,
    positive_details: Sequence[str] = POSITIVE_DETAILS,
    positive_description: Sequence[str] = POSITIVE_DESCRIPTION,
    negative_details: Sequence[str] = NEGATIVE_DETAILS,
    negative_description: Sequence[str] = NEGATIVE_DESCRIPTION,
) -> DataFrame:
    a = lower_columns(activities)
    has_fu = F.col("follow_up_id").isNotNull()
    pos = (X.contains_any("activity_details", positive_details)
           | X.contains_any("description", positive_description))
    neg = (X.contains_any("activity_details", negative_details)
           | X.contains_any("description", negative_description))
    main = a.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("total_activities"),
        F.count_if(F.col("call_status").isNotNull()).alias("total_calls_logged"),
        F.count_if(F.lower("call_status").isin(*ANSWERED_STATUSES)).alias("answered_calls"),
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_call_duration_sec"),
        F.avg(F.when(F.coalesce("duration", F.lit(0.0)) > 0, F.col("duration"))).alias("avg_call_duration_sec"),
        F.max("duration").alias("max_call_duration_sec"),
        F.count_if(F.col("call_recordings").isNotNull()).alias("calls_with_recording"),
        F.min(F.when(has_fu, F.col("created_at"))).alias("first_followup_at"),
        F.max(F.when(has_fu, F.col("created_at"))).alias("last_followup_at"),
        F.min("created_at").alias("first_activity_at"),
        F.max("created_at").alias("last_activity_at"),
        F.sum(F.when(pos, 1).otherwise(0)).cast("long").alias("positive_intent_kw_count"),
        F.sum(F.when(neg, 1).otherwise(0)).cast("long").alias("negative_intent_kw_count"),
    )
    # Both distinct counts come from one branch pruned to three columns: its
    # Expand only doubles those narrow rows (the wide measures above never
    # pass through it), the first shuffle keys on (lead, value) so a hot lead
    # spreads, and both results are hash-partitioned on lead_id, so the join
    # adds no exchange.
    distinct = (a.select("lead_id", "activity_id", "follow_up_id").groupBy("lead_id")
                .agg(F.count_distinct("activity_id").alias("unique_activity_types"),
                     F.count_distinct("follow_up_id").alias("followup_count")))
    # Activities without a lead are one group, which a plain equality would not find.
    distinct = distinct.withColumnRenamed("lead_id", "d_lead_id")
    out = main.join(distinct, main["lead_id"].eqNullSafe(distinct["d_lead_id"]), "left")
    return out.select("lead_id", "total_activities", "unique_activity_types", "total_calls_logged",
                      "answered_calls", "total_call_duration_sec", "avg_call_duration_sec",
                      "max_call_duration_sec", "calls_with_recording", "followup_count",
                      "first_followup_at", "last_followup_at", "first_activity_at", "last_activity_at",
                      "positive_intent_kw_count", "negative_intent_kw_count")


# A2 -------------------------------------------------------------------------
def facebook_aggregate(events: DataFrame) -> DataFrame:
    """``avg_fb_retry_count`` is produced but not used downstream (as in the source)."""
    e = lower_columns(events)
    return e.groupBy("lead_id").agg(
        F.count(F.lit(1)).alias("fb_events_count"),
        F.sum(F.when(F.col("success"), 1).otherwise(0)).cast("long").alias("fb_events_success"),
        F.round(F.avg(F.coalesce("retry_count", F.lit(0))), 2).alias("avg_fb_retry_count"),
    )


# A3 -------------------------------------------------------------------------
def voicebot_aggregate(logs: DataFrame, action_type: str,
                       id_path: str = VOICEBOT_ID_PATH) -> DataFrame:
    v = lower_columns(logs)
    lead = X.json_number("request", id_path)
    return (
        v.where((F.col("action_type") == action_type) & lead.isNotNull())
        .groupBy(lead.alias("lead_id"))
        .agg(F.count(F.lit(1)).alias("voicebot_call_count"),
             F.sum(F.when(F.col("status_code") == VOICEBOT_STARTED_STATUS, 1).otherwise(0))
              .cast("long").alias("voicebot_initiated_count"))
    )


# A4–A7 ----------------------------------------------------------------------
def ref_midnight(ref_date: _dt.date) -> F.Column:
    return X.ts_literal(ref_date)


def lead_group_stats(leads: DataFrame, ref_date: _dt.date, active_days: int = 30) -> DataFrame:
    """Channel, campaign and owner statistics in one scan (grouping sets).

    Columns: ``gid`` (0 channel, 1 campaign, 2 owner), ``key_channel``,
    ``key_campaign``, ``key_owner``, ``cvr``, ``volume``, ``tenure_days``,
    ``active_30d``.  Null channel and owner keys form their own group
    (A4, A6); blank campaigns are excluded (A5) and the campaign key is not
    trimmed.  Tenure is floor days from the earliest ``created_at`` to the
    reference midnight, null when every ``created_at`` is null.
    """
    ref = ref_midnight(ref_date)
    cutoff = X.ts_literal(_dt.datetime(ref_date.year, ref_date.month, ref_date.day)
                          - _dt.timedelta(days=active_days))
    base = leads.select(
        F.col("id"), F.col("is_interested"), F.col("created_at"), F.col("updated_at"),
        F.col("lead_channel").alias("key_channel"),
        F.when(X.non_blank("campaign_name"), F.col("campaign_name")).alias("key_campaign"),
        F.col("lead_owner").alias("key_owner"),
    )
    stats = (
        base.groupingSets([["key_channel"], ["key_campaign"], ["key_owner"]],
                          "key_channel", "key_campaign", "key_owner")
        .agg(
            F.grouping_id().alias("_gid"),
            F.avg("is_interested").alias("cvr"),
            F.count("id").alias("volume"),
            F.min("created_at").alias("_first_created"),
            F.count_if(F.col("updated_at") >= cutoff).alias("active_30d"),
        )
    )
    # grouping_id bit order follows the grouping columns: channel=4, campaign=2, owner=1.
    gid = (F.when(F.col("_gid") == 3, 0).when(F.col("_gid") == 5, 1).otherwise(2))
    tenure = F.floor(F.timestamp_diff("MICROSECOND", F.col("_first_created"), ref) / F.lit(8.64e10))
    stats = stats.select(
        gid.alias("gid"), "key_channel", "key_campaign", "key_owner", "cvr", "volume",
        tenure.cast("long").alias("tenure_days"), "active_30d",
    )
    return stats.where((F.col("gid") != 1) | F.col("key_campaign").isNotNull())


def channel_stats(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("gid") == 0).select(
        F.col("key_channel").alias("s_channel"), F.col("cvr").alias("channel_cvr"),
        F.col("volume").alias("channel_volume"))


def campaign_stats(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("gid") == 1).select(
        F.col("key_campaign").alias("s_campaign"), F.col("cvr").alias("campaign_cvr"),
        F.col("volume").alias("campaign_volume"))


def owner_stats(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("gid") == 2).select(
        F.col("key_owner").alias("s_owner"), F.col("cvr").alias("owner_cvr_overall"),
        F.col("volume").alias("owner_total_leads"), F.col("tenure_days").alias("owner_tenure_days"),
        F.col("active_30d").alias("owner_active_leads_30d"))
