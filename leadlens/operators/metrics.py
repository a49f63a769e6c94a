"""Evaluation metrics (E1–E5) as aggregates over prediction tables.

* E1 – accuracy / precision / recall / F1 from one tp/fp/tn/fn aggregate,
  zero when undefined (``zero_division=0``), rounded to 4 half-even.
* E2 – ROC AUC, tie-aware: rows are grouped by score first (partial
  aggregation), then AUC = Σ pos_s·(neg_below_s + ½·neg_s) / (P·N), with
  ``neg_below`` from bucketed prefix sums over the distinct scores.
* E3 – PR AUC as *average precision* (step sum over descending thresholds),
  not MLlib's trapezoidal ``areaUnderPR``.
* E4 – confusion matrix as (label, prediction, n).
* E5 – threshold check joining ``min_<metric>`` limits to metric values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.operators.ordered import group_bounds, grouped_prefix_sums

# Minimum quality thresholds of the base configuration.
DEFAULT_THRESHOLDS = {"min_roc_auc": 0.8, "min_f1": 0.75}


def _y(label: str) -> Column:
    return F.col(label).cast("double")


def classification_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    y, p = _y(label), F.col(prediction).cast("double")
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"),
               F.count(F.lit(1)).alias("n"))
    tp, fp, fn, n = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "n"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    acc = F.when(n > 0, (F.col("tp") + F.col("tn")) / n).otherwise(F.lit(0.0))
    return c.select(F.bround(acc, digits).alias("accuracy"), F.bround(prec, digits).alias("precision"),
                    F.bround(rec, digits).alias("recall"), F.bround(f1, digits).alias("f1"))


def _stacked_groups(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """(``_ci``, ``_s``, ``_pos``, ``_neg``): one row per score column and distinct value."""
    pairs = ", ".join(f"{i}, CAST(`{s}` AS DOUBLE)" for i, s in enumerate(scores))
    long = df.select(F.expr(f"stack({len(scores)}, {pairs}) AS (_ci, _s)"), _y(label).alias("_y"))
    return (long.where(F.col("_s").isNotNull())
            .groupBy("_ci", "_s")
            .agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg")))


def _ranked_groups(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """Distinct values of every score column with inclusive ascending prefix counts.

    All score columns are stacked as (column index, value) and handled in one
    pass: bucket bounds for every column come from one ``approxQuantile``
    call and the prefix runs per column.  For a value s: negatives below s =
    ``_neg_cum − _neg``; true / false positives at threshold s (score ≥ s) =
    P − ``_pos_cum`` + ``_pos`` and N − ``_neg_cum`` + ``_neg``.  One prefix
    pass serves both AUC and AP.
    """
    from leadlens.sources.tables import materialized

    g = materialized(_stacked_groups(df, label, scores), "score-values")
    cum = grouped_prefix_sums(g, "_ci", "_s", ["_pos", "_neg"], group_bounds(g, "_ci", "_s", len(scores)))
    totals = g.groupBy("_ci").agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    # One row per score column: a bounded broadcast.
    return cum.join(F.broadcast(totals), "_ci", "left")


def _auc_expr() -> Column:
    below = F.col("_neg_cum") - F.col("_neg")
    pn = F.max(F.col("_P") * F.col("_N"))
    return F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))) / F.when(pn > 0, pn)


def _ap_expr() -> Column:
    tp = F.col("_P") - F.col("_pos_cum") + F.col("_pos")
    fp = F.col("_N") - F.col("_neg_cum") + F.col("_neg")
    p = F.max("_P")
    return F.sum(F.col("_pos") * tp / (tp + fp)) / F.when(p > 0, p)


def ranking_table(df: DataFrame, label: str, scores: Sequence[str],
                  digits: int | None = None) -> DataFrame:
    """(candidate, roc_auc, pr_auc) for several score columns in one pass.

    A column whose rows are all null, or that sees a single class, gets a
    null AUC (and a null AP without positives).
    """
    scores = list(scores)
    rnd = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    got = _ranked_groups(df, label, scores).groupBy("_ci").agg(
        rnd(_auc_expr()).alias("roc_auc"), rnd(_ap_expr()).alias("pr_auc"))
    names = df.sparkSession.range(len(scores)).select(
        F.col("id").cast("int").alias("_ci"),
        F.element_at(F.array(*[F.lit(s) for s in scores]), F.col("id").cast("int") + 1).alias("candidate"))
    # Every candidate appears, also one without any non-null score.
    return (names.join(got, "_ci", "left").select("candidate", "roc_auc", "pr_auc"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``roc_auc``; null when only one class is present."""
    return ranking_table(df, label, [score]).select("roc_auc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``pr_auc``: Σ_s (pos_s / P) · precision at threshold s (descending)."""
    return ranking_table(df, label, [score]).select("pr_auc")


def ranking_metrics(df: DataFrame, label: str, score: str, digits: int = 4) -> DataFrame:
    """E2 + E3 in one row from one prefix pass, rounded like the training report."""
    return ranking_table(df, label, [score], digits).select("roc_auc", "pr_auc")


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"),
                      F.col(prediction).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def metrics_long(metrics_row: DataFrame) -> DataFrame:
    """One-row wide metrics → (metric, value)."""
    cols = metrics_row.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return metrics_row.selectExpr(f"stack({len(cols)}, {pairs}) AS (metric, value)")


def threshold_check(spark: SparkSession, metrics_row: DataFrame,
                    thresholds: Mapping[str, float] = DEFAULT_THRESHOLDS) -> DataFrame:
    """E5: (metric, value, threshold, passed).

    Threshold keys are written ``min_<metric>`` while metrics are named
    ``<metric>``; the prefix is stripped so the check actually applies (the
    source compares the raw keys and therefore never fires).
    """
    t = spark.createDataFrame([(k[4:] if k.startswith("min_") else k, float(v))
                               for k, v in thresholds.items()], "metric string, threshold double")
    return (metrics_long(metrics_row).join(F.broadcast(t), "metric")
            .withColumn("passed", F.col("value") >= F.col("threshold")))


def evaluate_scores(df: DataFrame, label: str, scores: Sequence[str], digits: int = 4) -> DataFrame:
    """E2/E3 for several score columns: (candidate, roc_auc, pr_auc), one pass over ``df``."""
    return ranking_table(df, label, scores, digits)
