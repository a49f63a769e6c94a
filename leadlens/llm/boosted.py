"""Boosted trees with isotonic calibration over an array of dense features."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Raw scores are rounded to 1 / GRID for the calibration, which so sees at most GRID + 1 rows.
GRID = 10_000


class Boosted:
    """Trees fitted on ``fit`` rows and a calibration fitted on ``calibrate`` rows.

    Both are ``(features array<double>, label int)``.  Without rows of both
    labels among the ``fit`` rows there are no trees: every score is the share
    of label 1 among them, or 0 without any row.
    """

    def __init__(self, fit: DataFrame, calibrate: DataFrame, rounds: int = 20, depth: int = 3, seed: int = 7):
        seen = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
        self.constant = seen.get(1, 0) / max(sum(seen.values()), 1)
        self.trees = self.curve = None
        if len(seen) < 2:
            return
        rows = fit.select(array_to_vector("features").alias("vector"), F.col("label").cast("double").alias("label"))
        self.trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3,
                                   minInstancesPerNode=2, maxBins=64, seed=seed, checkpointInterval=-1).fit(rows)
        points = self.raw(calibrate).groupBy(F.round(F.col("raw") * GRID).alias("g")).agg(
            F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"),
            F.max("label").alias("top"), F.min("label").alias("low")).select(
            (F.col("g") / GRID).alias("raw"), "label", "weight", "top", "low").toPandas()
        if len(points) and points["top"].max() == 1 and points["low"].min() == 0:
            known = fit.sparkSession.createDataFrame(points[["raw", "label", "weight"]])
            self.curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight",
                                            predictionCol="calibrated").fit(known)

    def raw(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the trees' probability of label 1."""
        if self.trees is None:
            return rows.withColumn("raw", F.lit(float(self.constant)))
        out = self.trees.transform(rows.withColumn("vector", array_to_vector("features")))
        return out.withColumn("raw", vector_to_array("probability")[1]).drop(
            "vector", "probability", "rawPrediction", "prediction")

    def score(self, rows: DataFrame, name: str = "score") -> DataFrame:
        """``rows`` with the calibrated score; within a flat part of the curve the raw one still orders."""
        out = self.raw(rows)
        if self.curve is None:
            return out.withColumn(name, F.col("raw")).drop("raw")
        out = self.curve.transform(out)
        return out.withColumn(name, blended(F.col("calibrated"), F.col("raw"))).drop("calibrated", "raw")


def blended(calibrated: Column, raw: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * calibrated + 0.001 * raw))
