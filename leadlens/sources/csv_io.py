"""Batch CSV source and result sink (S6, S7) with the browser tool's rules.

Source rules: a header row is required and must name all 14 request fields;
every field is split on ',' (no quote handling), trimmed and stripped of one
leading and one trailing double quote; blank lines are dropped; float fields
take the longest numeric prefix (JavaScript ``parseFloat``), int fields the
integer prefix (``parseInt``), and anything unparsable becomes 0; other
fields stay strings.  Spark's CSV reader is used with quoting disabled so
the split matches a plain comma split, and the file is read in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.functions.exprs import strip_ws
from leadlens.operators.ordered import row_numbers

# Request fields, in order, and their numeric kinds.
FLOAT_FIELDS = ("lead_score", "engagement_score", "response_time_hours", "email_open_rate",
                "email_click_rate")
INT_FIELDS = ("company_size", "page_views", "time_since_signup_days")
ALL_FIELDS = ("lead_score", "company_size", "engagement_score", "response_time_hours",
              "email_open_rate", "email_click_rate", "page_views", "time_since_signup_days",
              "industry", "company_type", "location", "product_interest", "source", "sales_stage")

FLOAT_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"
INT_PREFIX = r"^\s*([+-]?\d+)"


def _clean(c: Column) -> Column:
    return F.regexp_replace(strip_ws(F.coalesce(c, F.lit(""))), r'^"|"$', "")


def parse_float(c: Column) -> Column:
    v = F.regexp_extract(c, FLOAT_PREFIX, 1).try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (v == 0), F.lit(0.0)).otherwise(v)


def parse_int(c: Column) -> Column:
    v = F.regexp_extract(c, INT_PREFIX, 1).try_cast("long")
    return F.coalesce(v, F.lit(0)).cast("long")


def read_leads_csv(spark: SparkSession, path: str, fields: Sequence[str] = ALL_FIELDS) -> DataFrame:
    raw = (spark.read.option("header", True).option("quote", "\u0000")
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
           .option("inferSchema", False).csv(path))
    names = [c.strip().strip('"') if c else c for c in raw.columns]
    # strip exactly one quote at each end, like the browser code
    names = [c.strip() for c in raw.columns]
    names = [c[1:] if c.startswith('"') else c for c in names]
    names = [c[:-1] if c.endswith('"') else c for c in names]
    missing = [f for f in fields if f not in names]
    if missing:
        raise ValueError(f"Missing columns: {', '.join(missing)}")
    raw = raw.toDF(*[f"_c{i}" for i in range(len(names))])
    idx = {n: i for i, n in enumerate(names)}
    cleaned = {f: _clean(F.col(f"_c{idx[f]}")) for f in fields}
    out = []
    for f in fields:
        if f in FLOAT_FIELDS:
            out.append(parse_float(cleaned[f]).alias(f))
        elif f in INT_FIELDS:
            out.append(parse_int(cleaned[f]).alias(f))
        else:
            out.append(cleaned[f].alias(f))
    # The reader leaves out blank lines; a line of commas only is a row of zeros and empty strings.
    return raw.select(*out)


def format_results(pred: DataFrame, order_key: str) -> DataFrame:
    """Result rows with a 1-based ``row`` in ``order_key`` order and 4-decimal text."""
    numbered = row_numbers(pred, order_key, name="row")
    return numbered.select(
        F.col("row"),
        F.format_string("%.4f", F.col("probability")).alias("probability"),
        F.when(F.col("predicted_label"), F.lit("true")).otherwise(F.lit("false")).alias("predicted_label"),
        F.when(F.col("confidence").isNotNull(), F.format_string("%.4f", F.col("confidence")))
         .otherwise(F.lit("")).alias("confidence"),
        F.coalesce(F.col("model_version"), F.lit("")).alias("model_version"),
        F.coalesce(F.col("prediction_id"), F.lit("")).alias("prediction_id"),
    )


def write_results_csv(pred: DataFrame, order_key: str, path: str) -> None:
    """Write formatted results as CSV part files (ordered within and across parts)."""
    (format_results(pred, order_key).repartitionByRange("row").sortWithinPartitions("row")
     .write.mode("overwrite").option("header", True).csv(path))
