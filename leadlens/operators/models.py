"""Model tiers, training, importances and CV search (M1–M6) on MLlib.

Tier parameters follow the training script (``script``), or the configuration
file (``config``: boosting 100 × depth 3 and 100 × depth 6, step 0.1); where
MLlib differs the mapping is stated:

* baseline (M1) – L2 logistic regression (``operators.logit``, Newton steps to
  the optimum), C = 1, balanced class weights: ``regParam = 1/(C·Σw)`` (the
  weighted loss is averaged here and summed in sklearn), no scaling because the
  preprocessor already scales.
* challenger (M2) – gradient-boosted trees 200 × depth 4, step 0.05,
  subsample 0.8; (M3) random forest 100 trees, balanced weights, depth 30 for
  the unlimited depth.
* champion (M4) – second-order boosted trees (``operators.boosting``) 300 ×
  depth 6, step 0.05, rows and features 0.8 per tree, minimum child weight 5,
  positives weighted by ``scale_pos_weight``.

The search (M6) draws configurations from the source's ranges with a seed and
scores them on stratified folds of exact sizes; a configuration whose mean over
its first folds lies under the median of the finished ones is stopped.

Metrics come from ``operators.metrics`` (tie-aware AUC, average precision,
zero-division-safe precision/recall/F1).
"""

from __future__ import annotations

import math
import random
import statistics
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.operators import metrics as E
from leadlens.operators.boosting import SecondOrderTrees
from leadlens.operators.joins import attach_row
from leadlens.operators.logit import NewtonLogit
from leadlens.operators.split import in_quota
from leadlens.operators.summaries import class_balance
from leadlens.sources.tables import materialized

SEED = 42
TIERS = ("baseline", "challenger", "champion")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """w = n / (2 · n_class) per row (sklearn's ``class_weight='balanced'``); null for rows without a label."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("_n1"), F.count_if(F.col(label) == 0).alias("_n0"))
    j = attach_row(df, counts)
    own = F.when(F.col(label) == 1, F.col("_n1")).when(F.col(label) == 0, F.col("_n0"))
    return j.withColumn(out, (F.col("_n1") + F.col("_n0")) / (2.0 * own)).drop("_n1", "_n0")


def pos_weighted(df: DataFrame, label: str, spw: float, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


# Boosting parameters of the training script and of the configuration file.
BOOSTING = {
    "script": {"challenger": {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05},
               "champion": {"n_estimators": 300, "max_depth": 6, "learning_rate": 0.05, "min_child_weight": 5}},
    "config": {"challenger": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1},
               "champion": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "min_child_weight": 1}},
}
CHALLENGERS = ("gradient_boosting", "random_forest")


def build_classifier(tier: str, n_rows: int, spw: float, label: str = "label",
                     features: str = "features", weight: str = "weight",
                     challenger: str = "gradient_boosting", parameters: str = "script"):
    """Return (estimator, params dict) for a tier; ``parameters`` names a set of ``BOOSTING``."""
    if challenger not in CHALLENGERS:
        raise ValueError(f"challenger must be one of {CHALLENGERS}, not {challenger!r}")
    if tier == "baseline":
        return NewtonLogit(featuresCol=features, labelCol=label, weightCol=weight,
                           regParam=1.0 / max(n_rows, 1), maxIter=1000), \
            {"C": "1.0", "max_iter": "1000", "class_weight": "balanced"}
    if tier == "challenger" and challenger == "random_forest":
        return RandomForestClassifier(featuresCol=features, labelCol=label, weightCol=weight,
                                      numTrees=100, maxDepth=30, minInstancesPerNode=1, seed=SEED), \
            {"n_estimators": "100", "max_depth": "None", "class_weight": "balanced"}
    p = BOOSTING[parameters][tier]
    shown = {k: str(p[k]) for k in ("n_estimators", "max_depth", "learning_rate")}
    if tier == "challenger":
        return GBTClassifier(featuresCol=features, labelCol=label, maxIter=p["n_estimators"], maxDepth=p["max_depth"],
                             stepSize=p["learning_rate"], subsamplingRate=0.8, seed=SEED), shown
    return SecondOrderTrees(featuresCol=features, labelCol=label, weightCol=weight, maxIter=p["n_estimators"], maxDepth=p["max_depth"],
                            stepSize=p["learning_rate"], subsamplingRate=0.8, featureSubsetStrategy="0.8",
                            minChildWeight=float(p["min_child_weight"]), seed=SEED), {**shown, "scale_pos_weight": str(spw)}


def with_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("p1", vector_to_array(F.col("probability")).getItem(1))


def evaluate(model, df: DataFrame, label: str = "label") -> DataFrame:
    """One row: roc_auc, pr_auc, f1, precision, recall, accuracy (4 decimals)."""
    pred = with_probability(model.transform(df))
    rank = E.ranking_metrics(pred, label, "p1")
    cls = E.classification_metrics(pred, label, "prediction")
    return attach_row(rank, cls)


def train_tier(tier: str, train: DataFrame, eval_df: DataFrame, label: str = "label",
               features: str = "features", challenger: str = "gradient_boosting", parameters: str = "script"):
    """Fit one tier; returns (model, metrics_row_df, params)."""
    train = train.where(F.col(label).isNotNull())
    bal = class_balance(train, label).first()
    n_pos, n_neg = bal["n_pos"], bal["n_neg"]
    spw = bal["scale_pos_weight"]
    if tier == "baseline" or (tier == "challenger" and challenger == "random_forest"):
        data = balanced_weights(train, label)
    else:
        data = pos_weighted(train, label, spw if tier == "champion" else 1.0)
    clf, params = build_classifier(tier, n_pos + n_neg, spw, label, features,
                                   challenger=challenger, parameters=parameters)
    model = clf.fit(data)
    return model, evaluate(model, eval_df, label), params


def run_row(tier: str, seq: int, run_id: str, metrics_row: DataFrame, params: dict) -> DataFrame:
    """Run-results row: tier, run_id, seq, metrics map, params map."""
    m = metrics_row.columns
    kv = [x for c in m for x in (F.lit(c), F.col(c).cast("double"))]
    pk = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    return metrics_row.select(F.lit(tier).alias("tier"), F.lit(run_id).alias("run_id"),
                              F.lit(seq).alias("seq"), F.create_map(*kv).alias("metrics"),
                              F.create_map(*pk).alias("params"))


def train_tiers(train: DataFrame, eval_df: DataFrame, tiers: Sequence[str] = TIERS,
                label: str = "label", features: str = "features", challenger: str = "gradient_boosting",
                parameters: str = "script"):
    """Train every tier; returns (run_results_df, {tier: model})."""
    models, rows = {}, None
    for i, tier in enumerate(tiers):
        model, met, params = train_tier(tier, train, eval_df, label, features, challenger, parameters)
        models[tier] = model
        r = run_row(tier, i, f"{tier}-{i}", met, params)
        rows = r if rows is None else rows.unionByName(r)
    return rows, models


def feature_importance(model, names: Sequence[str], top_n: int | None = None, spark=None) -> DataFrame:
    """M5: (feature, importance) sorted desc; |coefficients| for linear models."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in model.coefficients.toArray().tolist()]
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(names, [float(v) for v in vals])), "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.limit(top_n) if top_n else df


# M6 -------------------------------------------------------------------------
# Search ranges per model type (low, high[, "log"]).
SEARCH_SPACES = {
    "logistic_regression": {"C": (1e-3, 10.0, "log"), "max_iter": (200, 2000)},
    "gradient_boosting": {"n_estimators": (50, 300), "max_depth": (2, 8),
                          "learning_rate": (0.01, 0.3, "log"), "subsample": (0.5, 1.0)},
    "random_forest": {"n_estimators": (50, 300), "max_depth": (3, 20),
                      "min_samples_split": (2, 20)},
    "xgboost": {"n_estimators": (50, 200), "max_depth": (3, 10),
                "learning_rate": (0.01, 0.3, "log"), "subsample": (0.5, 1.0),
                "colsample_bytree": (0.5, 1.0)},
}


def _draw(rng: random.Random, spec):
    lo, hi = spec[0], spec[1]
    if len(spec) > 2:
        return math.exp(rng.uniform(math.log(lo), math.log(hi)))
    if isinstance(lo, int) and isinstance(hi, int):
        return rng.randint(lo, hi)
    return rng.uniform(lo, hi)


#: Finished configurations that the median rule needs before it stops any.
WARM_UP_TRIALS = 2


def stratified_folds(df: DataFrame, id_col: str, label: str, folds: int, seed: int = SEED, out: str = "fold") -> DataFrame:
    """Adds the fold 0..folds−1 of each row; the sizes of a class's folds differ by one at most.

    Rows of a class are taken in (hash of id, id) order, fold by fold (``split.in_quota``), so folds don't depend on
    partitions.  Rows without a label are a class of their own.
    """
    quotas = [lambda n, i=i: F.floor(n * F.lit(i) / F.lit(folds)) for i in range(1, folds)]
    marked, inside = in_quota(df, id_col, label, quotas, seed)
    fold = F.lit(folds - 1)
    for i in reversed(range(folds - 1)):
        fold = F.when(inside[i], F.lit(i)).otherwise(fold)
    return marked.withColumn(out, fold).select(*[c for c in df.columns if c != out], out)


@dataclass
class SearchResult:
    """Configurations in the order drawn: mean AUC over the folds that ran, AUC by fold, whether it was stopped early."""

    params: list[dict]
    avgMetrics: list[float]  # noqa: N815 (as CrossValidatorModel names it)
    foldMetrics: list[list[float]]  # noqa: N815
    stopped: list[bool]
    best: int
    bestModel: object  # noqa: N815


def stops(scores: Sequence[float], finished: Sequence[Sequence[float]]) -> bool:
    """Whether a configuration with these first folds lies under the median of the finished ones on as many folds."""
    if len(finished) < WARM_UP_TRIALS:
        return False
    k = len(scores)
    return sum(scores) / k < statistics.median(sum(f[:k]) / k for f in finished)


def _candidate(model_type: str, drawn: dict, rows: int, label: str, features: str, seed: int):
    """The estimator of a drawn configuration for ``rows`` training rows (their balanced weights add up to as many)."""
    common = {"featuresCol": features, "labelCol": label}
    if model_type == "logistic_regression":
        return LogisticRegression(**common, weightCol="weight", elasticNetParam=0.0, standardization=False,
                                  regParam=1.0 / (drawn["C"] * max(rows, 1)), maxIter=int(drawn["max_iter"]))
    if model_type == "random_forest":
        return RandomForestClassifier(**common, weightCol="weight", seed=seed, numTrees=int(drawn["n_estimators"]),
                                      maxDepth=int(drawn["max_depth"]), minInstancesPerNode=max(1, int(drawn["min_samples_split"]) // 2))
    trees = {"maxIter": int(drawn["n_estimators"]), "maxDepth": int(drawn["max_depth"]), "stepSize": float(drawn["learning_rate"]),
             "subsamplingRate": float(drawn["subsample"]), "seed": seed}
    if model_type == "xgboost":
        return SecondOrderTrees(**common, **trees, featureSubsetStrategy=f"{drawn['colsample_bytree']:.3f}")
    return GBTClassifier(**common, **trees)


def search(train: DataFrame, model_type: str = "xgboost", n_trials: int = 10, folds: int = 5,
           label: str = "label", features: str = "features", parallelism: int = 4,
           seed: int = SEED) -> SearchResult:
    """Seeded random search with stratified k-fold CV on exact ROC AUC and early stopping of weak configurations.

    ``parallelism`` configurations run side by side; they are held against those of earlier rounds, so the outcome does
    not depend on which ends first.  The best finished configuration is fitted on all rows.
    """
    rng = random.Random(seed)
    drawn = [{k: _draw(rng, s) for k, s in SEARCH_SPACES[model_type].items()} for _ in range(n_trials)]
    numbered = materialized(train.where(F.col(label).isNotNull()).select(features, label)
                            .withColumn("_row", F.monotonically_increasing_id()), "search-rows")
    data = materialized(stratified_folds(numbered, "_row", label, folds, seed), "search-folds")
    sizes = {r["fold"]: r["count"] for r in data.groupBy("fold").count().collect()}
    weighted = model_type in ("logistic_regression", "random_forest")

    def fitted(config: dict, rows: DataFrame, n: int):
        return _candidate(model_type, config, n, label, features, seed).fit(balanced_weights(rows, label) if weighted else rows)

    def run(config: dict, finished: list[list[float]]) -> tuple[list[float], bool]:
        scores: list[float] = []
        for f in range(folds):
            model = fitted(config, data.where(F.col("fold") != f), sum(n for k, n in sizes.items() if k != f))
            held = with_probability(model.transform(data.where(F.col("fold") == f)))
            scores.append(E.roc_auc(held, label, "p1").first()[0] or 0.0)
            if f + 1 < folds and stops(scores, finished):
                return scores, True
        return scores, False

    results: list[tuple[list[float], bool]] = []
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        for at in range(0, n_trials, max(1, parallelism)):
            finished = [s for s, early in results if not early]
            results += pool.map(lambda c, seen=finished: run(c, seen), drawn[at:at + max(1, parallelism)])
    means = [sum(s) / len(s) for s, _ in results]
    best = max((i for i, (_, early) in enumerate(results) if not early), key=lambda i: means[i])
    return SearchResult(drawn, means, [s for s, _ in results], [early for _, early in results], best,
                        fitted(drawn[best], data, sum(sizes.values())))
