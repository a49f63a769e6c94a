"""Batch scoring (B1) and batch summary.

The source scores a batch with a per-row loop; here one ``transform`` of a
fitted pipeline scores the whole table.  Prediction ids are
``pred_<request>_<i>`` with ``i`` the 0-based position in an explicit order
(bucketed row numbers, no single-partition window).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.operators.ordered import row_numbers

# Fixed value: the version string the scoring service reports.
MODEL_VERSION = "v1.0.0"


def score_batch(model, df: DataFrame, order_key: str, request_id: str,
                version: str = MODEL_VERSION, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fitted pipeline → (prediction_id, probability, predicted_label, model_version, confidence)."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability")).getItem(1)
    numbered = row_numbers(out.select(order_key, *keep, p.alias("_p"), F.col("prediction")),
                           order_key, name="_row")
    return numbered.select(
        *keep, order_key,
        F.concat(F.lit(f"pred_{request_id}_"), (F.col("_row") - 1).cast("string")).alias("prediction_id"),
        F.col("_p").alias("probability"),
        (F.col("prediction") == 1).alias("predicted_label"),
        F.lit(version).alias("model_version"),
        F.greatest(F.col("_p"), 1 - F.col("_p")).alias("confidence"),
    )


def score_rows(model, df: DataFrame, request_id: str, version: str = MODEL_VERSION,
               key_col: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Stateless per-row scoring (used by the streaming path, no ordering).

    Every row is one request, so each gets its own id: ``pred_<key>`` from
    ``key_col`` when given, else ``pred_<request_id>_<batch>_<n>`` with ``n``
    unique within the micro-batch.
    """
    out = model.transform(df)
    p = vector_to_array(F.col("probability")).getItem(1)
    if key_col is not None:
        pid = F.concat(F.lit("pred_"), F.col(key_col).cast("string"))
    else:
        prefix = f"pred_{request_id}_" + ("" if batch_id is None else f"{batch_id}_")
        pid = F.concat(F.lit(prefix), F.monotonically_increasing_id().cast("string"))
    return out.select(
        *df.columns,
        pid.alias("prediction_id"),
        p.alias("probability"),
        (F.col("prediction") == 1).alias("predicted_label"),
        F.lit(version).alias("model_version"),
        F.greatest(p, 1 - p).alias("confidence"),
    )


def batch_summary(pred: DataFrame) -> DataFrame:
    """Total, high-intent count and its rounded percentage (half up)."""
    agg = pred.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(F.col("predicted_label")).alias("high_intent"))
    pct = F.floor(F.col("high_intent") * 100.0 / F.col("total") + 0.5).cast("bigint")
    return agg.select("total", "high_intent", F.when(F.col("total") > 0, pct).alias("high_intent_pct"))
