"""Registered queries: sources, source aggregates, lookups, feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.operators import aggregates as A
from leadlens.operators import features as G
from leadlens.plans import oracle_features as OF
from leadlens.plans.feature_build import feature_table, test_view_keywords
from leadlens.plans.oracle_views import with_views
from leadlens.plans.registry import register
from leadlens.sources import testviews as TV


@register("features_full", OF.FEATURES_SQL)
def q_features_full(spark, sf_dir):
    return feature_table(spark, sf_dir)


@register("a1_activity_aggregate", with_views(OF.ACT_AGG) + "SELECT * FROM act")
def q_activity_aggregate(spark, sf_dir):
    return A.activity_aggregate(TV.activities_view(spark, sf_dir), **test_view_keywords())


@register("a2_facebook_aggregate", with_views(OF.FB_AGG) + "SELECT * FROM fb")
def q_facebook_aggregate(spark, sf_dir):
    return A.facebook_aggregate(TV.facebook_view(spark, sf_dir))


@register("a3_voicebot_aggregate", with_views(OF.VB_AGG) + "SELECT * FROM vb")
def q_voicebot_aggregate(spark, sf_dir):
    return (A.voicebot_aggregate(TV.voicebot_view(spark, sf_dir), TV.VOICEBOT_ACTION,
                                 TV.JSON_ID_PATH)
            .withColumn("lead_id", F.col("lead_id").cast("long")))


@register("a4_channel_cvr", with_views(OF.LD0, OF.CH) +
          "SELECT k AS lead_channel, cvr AS channel_cvr, vol AS channel_volume FROM ch")
def q_channel_cvr(spark, sf_dir):
    ld = G.prepare_leads(TV.leads_view(spark, sf_dir))
    return A.channel_stats(A.lead_group_stats(ld, TV.REF_DATE)).withColumnRenamed(
        "s_channel", "lead_channel")


@register("a5_campaign_cvr", with_views(OF.LD0, OF.CP) +
          "SELECT k AS campaign_name, cvr AS campaign_cvr, vol AS campaign_volume FROM cp")
def q_campaign_cvr(spark, sf_dir):
    ld = G.prepare_leads(TV.leads_view(spark, sf_dir))
    return A.campaign_stats(A.lead_group_stats(ld, TV.REF_DATE)).withColumnRenamed(
        "s_campaign", "campaign_name")


@register("a6_a7_owner_stats", with_views(OF.LD0, OF.OW) +
          "SELECT k AS lead_owner, cvr AS owner_cvr_overall, vol AS owner_total_leads, "
          "tenure AS owner_tenure_days, active AS owner_active_leads_30d FROM ow")
def q_owner_stats(spark, sf_dir):
    ld = G.prepare_leads(TV.leads_view(spark, sf_dir))
    return A.owner_stats(A.lead_group_stats(ld, TV.REF_DATE)).withColumnRenamed(
        "s_owner", "lead_owner")
