"""Ridge-penalised logistic regression by iteratively reweighted least squares (M1).

The objective is MLlib's: the weighted mean of the logistic loss plus
``regParam`` / 2 times the squared coefficients; the intercept goes without a
penalty.  Each Newton step is one pass over the stored rows: tasks add up the
loss, the gradient X'w(p - y) and the Gram matrix X'wp(1 - p)X of their Arrow
batches, Spark adds up the tasks' sums cell by cell, and the driver solves one
system of as many unknowns as there are features (``MAX_FEATURES`` at most,
an error beyond: 8 MB).  A step that raises the loss is halved.  The fit ends
where no part of the gradient exceeds ``tol``, or at an error after ``maxIter``
passes; so its result can be checked against the optimality conditions.

Rows without a label or with a null weight take no part.  Labels of one class
only have no optimum without a penalised intercept: an error, as an empty
table is.  Null, NaN and infinite
features are an error.  Repeated rows count each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasRegParam, HasStandardization, HasTol, HasWeightCol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.sources.tables import materialized

MAX_FEATURES = 1_000


class _Logit(HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasTol, HasRegParam, HasStandardization, HasPredictionCol,
             HasProbabilityCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "coefficients, then the intercept (JSON)", typeConverter=TypeConverters.toString)

    def __init__(self, **kw):
        super().__init__()
        self._setDefault(maxIter=100, tol=1e-10, regParam=0.0, standardization=False, fitted="[0.0]")
        self._set(**{k: v for k, v in kw.items() if v is not None})


class NewtonLogitModel(Model, _Logit):
    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(json.loads(self.getOrDefault(self.fitted))[:-1])

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault(self.fitted))[-1]

    def _transform(self, df: DataFrame) -> DataFrame:
        own = F.array(*[F.lit(float(b)) for b in self.coefficients])
        terms = F.zip_with(vector_to_array(F.col(self.getFeaturesCol())), own, lambda x, b: x * b)
        out = df.withColumn("_margin", F.aggregate(terms, F.lit(float(self.intercept)), lambda a, t: a + t))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return out.select(*df.columns, array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))).alias(self.getRawPredictionCol()),
                          array_to_vector(F.array(1.0 - p, p)).alias(self.getProbabilityCol()),
                          (F.col("_margin") > 0).cast("double").alias(self.getPredictionCol()))


class NewtonLogit(Estimator, _Logit):
    def _fit(self, df: DataFrame) -> NewtonLogitModel:
        if self.getStandardization():
            raise ValueError("scale the features before the fit; standardization is not done here")
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) else F.lit(1.0)
        rows = materialized(df.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"),
                                      F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
                            .where("y IS NOT NULL AND w IS NOT NULL"), "logit-rows")
        seen = rows.agg(F.min("y"), F.max("y"), F.sum("w"), F.min(F.size("x")), F.max(F.size("x"))).first()
        low, high, mass, width, widest = seen
        if low is None or (low, high) != (0.0, 1.0):
            raise ValueError("labels of both classes, 0 and 1, are needed")
        if width != widest or width > MAX_FEATURES:
            raise ValueError(f"{width} to {widest} features; rows need the same number, {MAX_FEATURES} at most")
        ridge = np.append(np.full(width, self.getRegParam()), 0.0)

        def at(point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            loss, slope, curve = _sums(rows, point)
            return (loss / mass + 0.5 * ridge @ (point * point), slope / mass + ridge * point, curve / mass + np.diag(ridge))

        point = np.zeros(width + 1)
        here, slope, curve = at(point)
        if not np.isfinite(curve).all():
            raise ValueError("features or weights are null, NaN or infinite")
        for _ in range(self.getMaxIter()):
            if np.abs(slope).max() <= self.getTol():
                break
            # The pseudo-inverse leaves directions alone in which the loss is flat (equal columns without a penalty).
            step = -np.linalg.lstsq(curve, slope, rcond=1e-14)[0]
            length, found = 1.0, at(point + step)
            while not found[0] <= here + 1e-14 * abs(here) and length > 1e-9:
                length /= 2
                found = at(point + length * step)
            if length <= 1e-9:  # no lower loss downhill: settled to rounding
                break
            point, (here, slope, curve) = point + length * step, found
        else:
            raise RuntimeError(f"the fit has not settled in {self.getMaxIter()} steps")
        model = NewtonLogitModel()
        self._copyValues(model)
        return model._set(fitted=json.dumps(point.tolist()))


def _sums(rows: DataFrame, point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Gram matrix over all ``rows(x, y, w)``; the intercept is the last feature."""
    width = len(point)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, curve = 0.0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width - 1)
            x = np.hstack([x, np.ones((len(x), 1))])
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            m = x @ point
            p = 0.5 * (1.0 + np.tanh(0.5 * m))
            loss += float(w @ (np.logaddexp(0.0, m) - y * m))
            slope += x.T @ (w * (p - y))
            curve += (x * (w * p * (1.0 - p))[:, None]).T @ x
        whole = np.vstack([curve, slope, np.append(np.full(width - 1, 0.0), loss)])
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 2), pa.int32()), pa.array(whole.tolist(), pa.list_(pa.float64()))],
                                         ["i", "cells"])

    parts = rows.mapInArrow(run, "i int, cells array<double>")
    total = parts.select("i", F.posexplode("cells").alias("j", "c")).groupBy("i", "j").agg(F.sum("c").alias("c"))
    # (width + 2) x width cells, whatever the number of rows.
    found = np.zeros((width + 2, width))
    for i, j, c in total.collect():
        found[i, j] = c
    return float(found[-1, -1]), found[-2], found[:-2]
