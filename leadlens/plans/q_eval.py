"""Registered queries: metrics (E1–E5), leaderboard and gate (R1–R2), B3.

Predictions come from the scored table: each composite score divided by 100
is a candidate ranker (``intent_score`` is the reference candidate, with a
0.5 decision threshold), evaluated on the validation split.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.operators import leaderboard as R
from leadlens.operators import metrics as E
from leadlens.operators.scores import SCORE_COLUMNS
from leadlens.operators.scoring import batch_summary
from leadlens.plans.feature_build import stored_feature_table
from leadlens.plans.oracle_features import features_with
from leadlens.plans.q_scores import P95, SCORED
from leadlens.plans.registry import register
from leadlens.plans.scored_build import scored_from_features
from leadlens.sources import testviews as TV
from leadlens.sources.tables import stored

CANDIDATE = "intent_score"
CHAMPION = "campaign_score"


def scored(spark, sf_dir):
    return stored(spark, f"scored:{sf_dir}",
                  lambda: scored_from_features(stored_feature_table(spark, sf_dir), TV.COMPUTED_AT))


def validation(spark, sf_dir):
    return scored(spark, sf_dir).where(F.col("split") == "validation")


def predictions(spark, sf_dir, rows=validation):
    v = rows(spark, sf_dir)
    p = F.col(CANDIDATE) / 100.0
    return v.select("lead_id", "converted", p.alias("probability"),
                    (p >= 0.5).cast("int").alias("prediction"))


VAL = "val AS (SELECT * FROM scored WHERE split = 'validation')"
PRED = (f"pred AS (SELECT lead_id, converted, {CANDIDATE} / 100.0 AS probability, "
        f"CAST({CANDIDATE} / 100.0 >= 0.5 AS INTEGER) AS prediction FROM val)")
BASE = features_with(P95, SCORED, VAL, PRED)
#: The same over all splits, for what is no evaluation.
EVERY = features_with(P95, SCORED, PRED.replace("FROM val)", "FROM scored)"))

E1_SQL = """SELECT
  round_even(CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE converted = prediction)) / count(*) ELSE 0 END, 4) AS accuracy,
  round_even(CASE WHEN count(*) FILTER (WHERE prediction = 1) > 0
    THEN count(*) FILTER (WHERE converted = 1 AND prediction = 1) / count(*) FILTER (WHERE prediction = 1) ELSE 0 END, 4) AS precision,
  round_even(CASE WHEN count(*) FILTER (WHERE converted = 1) > 0
    THEN count(*) FILTER (WHERE converted = 1 AND prediction = 1) / count(*) FILTER (WHERE converted = 1) ELSE 0 END, 4) AS recall,
  round_even(CASE WHEN count(*) FILTER (WHERE prediction = 1) + count(*) FILTER (WHERE converted = 1) > 0
    THEN 2.0 * count(*) FILTER (WHERE converted = 1 AND prediction = 1)
         / (count(*) FILTER (WHERE prediction = 1) + count(*) FILTER (WHERE converted = 1)) ELSE 0 END, 4) AS f1
FROM pred"""


@register("e1_classification_metrics", BASE + E1_SQL)
def q_classification(spark, sf_dir):
    return E.classification_metrics(predictions(spark, sf_dir), "converted", "prediction")


def _rank_sql(score: str) -> str:
    return f"""SELECT '{score}' AS candidate,
  round_even(sum(pos * (neg_below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0), 4) AS roc_auc,
  round_even(sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0), 4) AS pr_auc
FROM (
  SELECT s, pos, neg,
    coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
    sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM (SELECT CAST({score} AS DOUBLE) AS s, sum(CAST(converted AS DOUBLE)) AS pos,
               sum(1 - CAST(converted AS DOUBLE)) AS neg
        FROM val WHERE {score} IS NOT NULL GROUP BY 1) g
) c"""


EVAL_SQL = " UNION ALL ".join(_rank_sql(s) for s in SCORE_COLUMNS)


@register("e2_e3_auc_ap_per_score", BASE + EVAL_SQL)
def q_auc(spark, sf_dir):
    return E.evaluate_scores(validation(spark, sf_dir), "converted", list(SCORE_COLUMNS))


@register("e4_confusion_matrix", BASE + "SELECT converted AS label, prediction, "
          "CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY 1, 2")
def q_confusion(spark, sf_dir):
    return E.confusion_matrix(predictions(spark, sf_dir), "converted", "prediction")


E5_SQL = f"""SELECT metric, value, threshold, value >= threshold AS passed FROM (
  SELECT 'roc_auc' AS metric, CAST(roc_auc AS DOUBLE) AS value, CAST(0.8 AS DOUBLE) AS threshold
    FROM ({_rank_sql(CANDIDATE)}) a
  UNION ALL
  SELECT 'f1', CAST(f1 AS DOUBLE), CAST(0.75 AS DOUBLE) FROM ({E1_SQL}) b
) t"""


@register("e5_threshold_check", BASE + E5_SQL)
def q_thresholds(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    cls = E.classification_metrics(pred, "converted", "prediction").select("f1")
    auc = E.ranking_metrics(validation(spark, sf_dir), "converted", CANDIDATE).select("roc_auc")
    from leadlens.operators.joins import attach_row
    return E.threshold_check(spark, attach_row(auc, cls))


def runs_table(spark, sf_dir):
    """One run per candidate score: tier = score name, metrics map, input order."""
    ev = E.evaluate_scores(validation(spark, sf_dir), "converted", list(SCORE_COLUMNS))
    order = F.create_map(*[x for i, s in enumerate(SCORE_COLUMNS) for x in (F.lit(s), F.lit(i))])
    return ev.select(
        F.col("candidate").alias("tier"), F.concat(F.lit("run_"), F.col("candidate")).alias("run_id"),
        F.element_at(order, F.col("candidate")).alias("seq"),
        F.create_map(F.lit("roc_auc"), F.col("roc_auc"), F.lit("pr_auc"), F.col("pr_auc")).alias("metrics"))


_SEQ = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(SCORE_COLUMNS))
RUNS_CTE = f"runs AS (SELECT candidate AS tier, 'run_' || candidate AS run_id, CASE candidate {_SEQ} END AS seq, " \
           f"roc_auc, pr_auc FROM ({EVAL_SQL}) e)"


@register("r1_leaderboard", BASE.rstrip() + ",\n" + RUNS_CTE + "\n" +
          "SELECT tier, run_id, coalesce(roc_auc, 0.0) AS primary_metric, "
          "row_number() OVER (ORDER BY coalesce(roc_auc, 0.0) DESC, seq) AS rank, "
          "row_number() OVER (ORDER BY coalesce(roc_auc, 0.0) DESC, seq) = 1 AS is_winner FROM runs")
def q_leaderboard(spark, sf_dir):
    return R.rank_runs(runs_table(spark, sf_dir)).select("tier", "run_id", "primary_metric",
                                                          F.col("rank").cast("bigint").alias("rank"),
                                                          "is_winner")


@register("r2_promotion_gate", BASE.rstrip() + ",\n" + RUNS_CTE + f"""
SELECT w.run_id AS challenger_run_id, c.run_id AS champion_run_id,
  coalesce(w.roc_auc, 0.0) AS challenger_score, coalesce(c.roc_auc, 0.0) AS champion_score,
  coalesce(w.roc_auc, 0.0) - coalesce(c.roc_auc, 0.0) AS delta,
  coalesce(coalesce(w.roc_auc, 0.0) - coalesce(c.roc_auc, 0.0) >= 0.0, true) AS promote
FROM (SELECT * FROM runs ORDER BY coalesce(roc_auc, 0.0) DESC, seq LIMIT 1) w
LEFT JOIN (SELECT * FROM runs WHERE tier = '{CHAMPION}') c ON true""")
def q_gate(spark, sf_dir):
    runs = runs_table(spark, sf_dir)
    return R.promotion_gate(R.winner(runs), runs.where(F.col("tier") == CHAMPION))


@register("b3_batch_summary", EVERY + """SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE probability >= 0.5) AS BIGINT) AS high_intent,
  CAST(floor(count(*) FILTER (WHERE probability >= 0.5) * 100.0 / count(*) + 0.5) AS BIGINT) AS high_intent_pct
FROM pred""")
def q_batch_summary(spark, sf_dir):
    p = predictions(spark, sf_dir, scored).withColumn("predicted_label", F.col("prediction") == 1)
    return batch_summary(p)


@register("s7_results_csv_rows", EVERY + """SELECT
  CAST(row_number() OVER (ORDER BY lead_id) AS BIGINT) AS row,
  printf('%.4f', probability) AS probability,
  CASE WHEN prediction = 1 THEN 'true' ELSE 'false' END AS predicted_label,
  printf('%.4f', greatest(probability, 1 - probability)) AS confidence,
  'v1.0.0' AS model_version,
  'pred_' || CAST(lead_id AS VARCHAR) AS prediction_id
FROM pred""")
def q_results_rows(spark, sf_dir):
    """Result rows numbered in lead order with 4-decimal text fields."""
    from leadlens.operators.scoring import MODEL_VERSION
    from leadlens.sources.csv_io import format_results

    p = predictions(spark, sf_dir, scored).select(
        "lead_id", "probability", (F.col("prediction") == 1).alias("predicted_label"),
        F.greatest(F.col("probability"), 1 - F.col("probability")).alias("confidence"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.concat(F.lit("pred_"), F.col("lead_id").cast("string")).alias("prediction_id"))
    return format_results(p, "lead_id")
