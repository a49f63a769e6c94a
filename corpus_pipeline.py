"""The corpus pipeline: five stages over ``documents``, each by one operator of ``leadlens.llm``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of ``docs``; the last one adds tokens, rate and copies.  ``run``
writes each stage's result as Parquet and rereads it as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlens.llm import op2_mixing, op4_exact_dedup, op5_toxicity, op6_decontaminate, op7_minhash
from leadlens.llm.common import materialized, table
from leadlens.llm.queries import MIX_WEIGHTS, quality_domains


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go; all others stay, labelled or not."""
    return op5_toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts the one with the smallest id stays."""
    return op4_exact_dedup.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more one stays."""
    return op7_minhash.drop_near_copies(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    return op6_decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens, its rate and how often it is to be repeated."""
    return op2_mixing.with_rates(docs, quality_domains(table(spark, sf_dir, "labels")), MIX_WEIGHTS)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Trees and their calibration can't be written in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set itself: the rows of ``run`` as often as their ``copies`` say."""
    rows = run(spark, sf_dir)
    return op2_mixing.drawn(rows, rows.columns[-1])  # with_rates adds copies last, whatever it is called
