"""Lead-table generators (S9, S10) built on ``spark.range`` + seeded ``rand``.

Rows are generated in parallel on executors; the seed makes every run
produce the same table for the same ``n`` and partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Category levels of the generators.
INDUSTRIES = ("Technology", "Finance", "Healthcare", "Retail")
COMPANY_TYPES = ("SaaS", "Enterprise", "Startup", "SMB")
LOCATIONS = ("US", "EU", "APAC", "LATAM")
PRODUCTS = ("Enterprise", "SMB", "Startup")
SOURCES = ("LinkedIn", "Direct", "Partner", "Event")
STAGES = ("Awareness", "Consideration", "Decision", "Qualification")
SAMPLE_INDUSTRIES = INDUSTRIES + ("Manufacturing",)
SAMPLE_COMPANY_TYPES = COMPANY_TYPES + ("Fortune500",)
SAMPLE_LOCATIONS = LOCATIONS + ("Canada",)
SAMPLE_PRODUCTS = PRODUCTS + ("Premium",)
SAMPLE_SOURCES = SOURCES + ("Webinar",)
SAMPLE_STAGES = STAGES + ("Nurture",)


def _uniform(lo: float, hi: float, seed: int) -> Column:
    return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * F.rand(seed)


def _randint(lo: int, hi_exclusive: int, seed: int) -> Column:
    return (F.lit(lo) + F.floor(F.rand(seed) * (hi_exclusive - lo))).cast("int")


def _choice(levels: Sequence[str], seed: int) -> Column:
    arr = F.array(*[F.lit(v) for v in levels])
    return F.element_at(arr, (F.floor(F.rand(seed) * len(levels)) + 1).cast("int"))


def learnable_leads(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """intent = 0.4·score/100 + 0.3·eng/100 + 0.2·(1 − rt/48) + 0.1·click + N(0, .12) > .5."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    df = base.select(
        F.col("id"),
        _uniform(0, 100, seed).alias("lead_score"),
        _randint(5, 1000, seed + 1).alias("company_size"),
        _uniform(0, 100, seed + 2).alias("engagement_score"),
        _uniform(0, 48, seed + 3).alias("response_time_hours"),
        _uniform(0, 1, seed + 4).alias("email_open_rate"),
        _uniform(0, 1, seed + 5).alias("email_click_rate"),
        _randint(0, 100, seed + 6).alias("page_views"),
        _randint(0, 365, seed + 7).alias("time_since_signup_days"),
        _choice(INDUSTRIES, seed + 8).alias("industry"),
        _choice(COMPANY_TYPES, seed + 9).alias("company_type"),
        _choice(LOCATIONS, seed + 10).alias("location"),
        _choice(PRODUCTS, seed + 11).alias("product_interest"),
        _choice(SOURCES, seed + 12).alias("source"),
        _choice(STAGES, seed + 13).alias("sales_stage"),
        F.randn(seed + 14).alias("_noise"),
    )
    signal = (0.40 * F.col("lead_score") / 100 + 0.30 * F.col("engagement_score") / 100
              + 0.20 * (1 - F.col("response_time_hours") / 48) + 0.10 * F.col("email_click_rate"))
    return (df.withColumn("intent_label", (signal + 0.12 * F.col("_noise") > 0.5).cast("int"))
            .drop("_noise"))


def sample_leads(spark: SparkSession, n: int, seed: int = 42, positive_rate: float = 0.3) -> DataFrame:
    """Uniform columns, five levels per category, ~30 % positives, ids from 1."""
    return spark.range(1, n + 1).select(
        F.col("id"),
        _uniform(0, 100, seed).alias("lead_score"),
        _randint(1, 5000, seed + 1).alias("company_size"),
        _uniform(0, 100, seed + 2).alias("engagement_score"),
        _uniform(0, 48, seed + 3).alias("response_time_hours"),
        _uniform(0, 1, seed + 4).alias("email_open_rate"),
        _uniform(0, 1, seed + 5).alias("email_click_rate"),
        _randint(0, 200, seed + 6).alias("page_views"),
        _randint(0, 365, seed + 7).alias("time_since_signup_days"),
        _choice(SAMPLE_INDUSTRIES, seed + 8).alias("industry"),
        _choice(SAMPLE_COMPANY_TYPES, seed + 9).alias("company_type"),
        _choice(SAMPLE_LOCATIONS, seed + 10).alias("location"),
        _choice(SAMPLE_PRODUCTS, seed + 11).alias("product_interest"),
        _choice(SAMPLE_SOURCES, seed + 12).alias("source"),
        _choice(SAMPLE_STAGES, seed + 13).alias("sales_stage"),
        (F.rand(seed + 14) < positive_rate).cast("int").alias("intent_label"),
    )
