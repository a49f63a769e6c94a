"""Lifecycle B: feature table → scored table (C1–C7, D2) + summary (A10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from leadlens.functions.exprs import ts_literal
from leadlens.operators import scores as C
from leadlens.operators import split as D
from leadlens.operators.summaries import scored_summary
from leadlens.plans.feature_build import feature_table
from leadlens.sources import testviews as TV


def scored_from_features(features: DataFrame, scored_at: _dt.datetime,
                         params: DataFrame | None = None, seed: int = D.DEFAULT_SEED) -> DataFrame:
    params = params if params is not None else C.p95_params(features)
    scored = C.score_table(features, params)
    scored = D.exact_three_way_split(scored, "lead_id", "converted", seed)
    return scored.withColumn("scored_at", ts_literal(scored_at))


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from_features(feature_table(spark, sf_dir), TV.COMPUTED_AT)


def scored_build_summary(scored: DataFrame, params: DataFrame) -> DataFrame:
    return scored_summary(scored, params, C.SCORE_COLUMNS)
