"""Lifecycle A: CRM sources → feature table (+ build statistics).

``feature_table`` is the lazy plan; ``run_feature_build`` writes it (S4) and
computes the build statistics (A8) and correlations (A9) from the written
copy, so the sources are scanned once per build.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from leadlens.operators import features as G
from leadlens.sources import testviews as TV


def test_view_keywords() -> dict:
    return dict(positive_details=TV.POSITIVE_DETAILS,
                positive_description=TV.POSITIVE_DESCRIPTION,
                negative_details=TV.NEGATIVE_DETAILS,
                negative_description=TV.NEGATIVE_DESCRIPTION)


def feature_table(spark: SparkSession, sf_dir: str, ref_date: _dt.date = TV.REF_DATE,
                  computed_at: _dt.datetime = TV.COMPUTED_AT) -> DataFrame:
    """Feature table over the retail-backed CRM views of ``sf_dir``."""
    t = TV.crm_tables(spark, sf_dir)
    return G.build_features(
        t.leads, t.activities, t.contacts, t.facebook_events, t.voicebot_logs, t.users,
        t.status_master, ref_date=ref_date, computed_at=computed_at,
        keywords=test_view_keywords(), voicebot_action=TV.VOICEBOT_ACTION,
        voicebot_id_path=TV.JSON_ID_PATH)


def run_feature_build(tables: TV.CrmTables, output_path: str, ref_date: _dt.date,
                      computed_at: _dt.datetime, keywords: dict | None = None,
                      **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lifecycle A: build the feature table, write it (S4), read it back.

    Returns ``(features, build_stats, correlations)``.  The statistics (A8)
    and correlations (A9/O1) are lazy aggregates over the written copy, so
    the CRM sources are scanned once per build.  ``kw`` passes voicebot and
    broadcast options through to ``build_features``.
    """
    from leadlens.operators import summaries as S
    from leadlens.sources.tables import tasks_by_bytes, write_table

    t = tables
    with tasks_by_bytes(t.leads.sparkSession, input_size(t)):
        feats = G.build_features(t.leads, t.activities, t.contacts, t.facebook_events, t.voicebot_logs,
                                 t.users, t.status_master, ref_date=ref_date, computed_at=computed_at,
                                 keywords=keywords, **kw)
        write_table(feats, output_path)
    stored = feats.sparkSession.read.parquet(output_path)
    return stored, S.build_stats(stored), S.target_correlations(stored)


def input_size(tables: TV.CrmTables) -> int:
    """Bytes of the files behind the CRM tables, a file that several of them read counted for each."""
    from leadlens.sources.tables import input_bytes

    return sum(input_bytes(getattr(tables, f.name)) for f in fields(tables))


def stored_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written once per application (S4) and read back.

    Downstream steps (scores, summaries, preprocessing, training) read this
    copy, as the source pipeline reads its written feature table.
    """
    from leadlens.sources.tables import stored, tasks_by_bytes

    with tasks_by_bytes(spark, input_size(TV.crm_tables(spark, sf_dir))):
        return stored(spark, f"features:{sf_dir}", lambda: feature_table(spark, sf_dir))
