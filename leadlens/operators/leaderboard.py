"""Run leaderboard and promotion gate (R1, R2) over a table of run results.

A run-results table has one row per trained candidate: ``tier`` (string),
``run_id`` (string), ``seq`` (input order), ``metrics`` map<string,double>
and ``params`` map<string,string>.  It holds one row per training run, so
ranking it with an un-partitioned window is bounded by the number of runs,
not by data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.operators.joins import attach_row

PRIMARY_METRIC = "roc_auc"
PROMOTION_THRESHOLD = 0.0


def _metric(metric: str):
    return F.coalesce(F.element_at(F.col("metrics"), F.lit(metric)), F.lit(0.0))


def rank_runs(runs: DataFrame, metric: str = PRIMARY_METRIC) -> DataFrame:
    """Rank by the primary metric (missing → 0) desc, ties keep input order.

    Raises on an empty table.  Adds ``primary_metric``, ``rank`` and
    ``is_winner``.
    """
    if runs.isEmpty():
        raise ValueError("No model results to compare.")
    # One row per model run: this single-partition window is bounded by the number of fits.
    w = Window.orderBy(F.col("primary_metric").desc(), F.col("seq").asc())
    return (runs.withColumn("primary_metric", _metric(metric))
            .withColumn("rank", F.row_number().over(w))
            .withColumn("is_winner", F.col("rank") == 1))


def winner(runs: DataFrame, metric: str = PRIMARY_METRIC) -> DataFrame:
    return rank_runs(runs, metric).where(F.col("is_winner")).drop("is_winner")


def promotion_gate(challenger: DataFrame, champion: DataFrame, metric: str = PRIMARY_METRIC,
                   threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """R2: promote when challenger − champion ≥ threshold; no champion → promote.

    ``challenger`` and ``champion`` are run tables (at most one row each).
    """
    ch = challenger.select(F.col("run_id").alias("challenger_run_id"),
                           _metric(metric).alias("challenger_score"))
    cp = champion.select(F.col("run_id").alias("champion_run_id"),
                         _metric(metric).alias("champion_score"))
    j = attach_row(ch, cp)  # ≤ 1 row each; a missing champion leaves nulls
    delta = F.col("challenger_score") - F.col("champion_score")
    return j.select("challenger_run_id", "champion_run_id", "challenger_score", "champion_score",
                    delta.alias("delta"),
                    F.coalesce(delta >= F.lit(threshold), F.lit(True)).alias("promote"))
