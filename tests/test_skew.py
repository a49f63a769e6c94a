"""Hot keys: one key holding a third of all rows.

Results are compared with a pandas brute force, and the activity aggregate's
plan is checked for a map-side (partial) aggregate under every shuffle, so a
hot lead is reduced to one row per task before it moves.
"""
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from leadlens.operators import aggregates as A
from leadlens.operators.ordered import exact_quantiles

N = 30_000


def _activities(spark):
    i = F.col("id")
    hot = (i % 3) == 0  # a third of all rows belong to lead 1
    return spark.range(N).select(
        F.when(hot, F.lit(1)).otherwise(i % 2000 + 2).cast("long").alias("lead_id"),
        (i % 7).alias("activity_id"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(F.lit("answered")).alias("call_status"),
        F.when(i % 4 == 0, F.lit(None)).otherwise((i % 50).cast("double")).alias("duration"),
        F.when(i % 6 == 0, F.lit("rec")).alias("call_recordings"),
        F.when(i % 2 == 0, i % 11).alias("follow_up_id"),
        F.timestamp_add("MINUTE", i % 5000, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
         .alias("created_at"),
        F.when(i % 9 == 0, F.lit("Interested in fee")).otherwise(F.lit("no")).alias("activity_details"),
        F.lit(None).cast("string").alias("description"),
    )


def test_hot_lead_activity_aggregate_matches_brute_force(spark):
    acts = _activities(spark)
    got = A.activity_aggregate(acts).toPandas().set_index("lead_id").sort_index()
    pdf = acts.toPandas()
    g = pdf.groupby("lead_id")
    exp = pd.DataFrame({
        "total_activities": g.size(),
        "unique_activity_types": g["activity_id"].nunique(),
        "followup_count": g["follow_up_id"].nunique(),
        "total_calls_logged": g["call_status"].count(),
        "total_call_duration_sec": g["duration"].sum(),
        "max_call_duration_sec": g["duration"].max(),
        "positive_intent_kw_count": g["activity_details"].apply(
            lambda s: s.str.lower().str.contains("interested").sum()),
    }).sort_index()
    assert got.loc[1, "total_activities"] == N // 3
    for c in exp.columns:
        assert np.allclose(got[c].astype(float), exp[c].astype(float), equal_nan=True), c


def test_activity_aggregate_combines_map_side(spark):
    plan = A.activity_aggregate(_activities(spark))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchanges = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges
    for k in exchanges:
        # the child of every shuffle is a (partial) hash aggregate
        assert "HashAggregate" in lines[k + 1], lines[k:k + 2]
    assert "partial_count" in plan


def test_null_channel_holding_a_third_of_leads(spark):
    i = F.col("id")
    leads = spark.range(N).select(
        i.alias("id"),
        (i % 2).cast("int").alias("is_interested"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("created_at"),
        F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz").alias("updated_at"),
        F.when(i % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), (i % 4).cast("string")))
         .alias("lead_channel"),
        F.when(i % 3 == 1, F.lit("hot")).otherwise(F.lit("cold")).alias("campaign_name"),
        F.when(i % 3 == 2, F.lit(None)).otherwise(i % 5).alias("lead_owner"),
    )
    stats = A.lead_group_stats(leads, dt.date(2024, 2, 1))
    ch = A.channel_stats(stats).toPandas()
    pdf = leads.toPandas()
    exp = pdf.groupby("lead_channel", dropna=False)["id"].count()
    null_row = ch[ch["s_channel"].isna()]
    assert int(null_row["channel_volume"].iloc[0]) == int(exp[exp.index.isna()].iloc[0]) == N // 3
    assert sorted(ch["channel_volume"].tolist()) == sorted(exp.tolist())
    own = A.owner_stats(stats).toPandas()
    assert int(own[own["s_owner"].isna()]["owner_total_leads"].iloc[0]) == N // 3


def test_exact_quantiles_with_a_hot_value(spark):
    i = F.col("id")
    df = spark.range(N).select(F.when(i % 3 == 0, F.lit(42.0)).otherwise((i * 7919 % 1000).cast("double"))
                               .alias("x"))
    row = exact_quantiles(df, ["x"], [0.25, 0.5, 0.95]).first()
    vals = df.toPandas()["x"].to_numpy()
    for j, p in enumerate([0.25, 0.5, 0.95]):
        assert abs(row[f"x_q{j}"] - np.percentile(vals, p * 100)) < 1e-9
