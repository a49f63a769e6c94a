"""Second-order gradient-boosted trees for a binary label (M4, M5), trained by Spark aggregates.

The logistic loss is expanded to second order: a row has a gradient
g = w (p - y) and a hessian h = w p (1 - p).  Features are binned once at their
quantiles (the stored table holds a small integer per feature and row).  A
level of a tree is one aggregate: the sums of g and h by (node, feature, bin),
pre-aggregated in the tasks, and one window over these few sums that finds each
node's best split.  Only the chosen splits come to the driver.

* gain = GL^2/(HL + lambda) + GR^2/(HR + lambda) - G^2/(H + lambda), a leaf's
  weight is -G/(H + lambda) times the step size;
* a child needs a summed hessian of ``minChildWeight`` at least;
* rows (``subsamplingRate``) and features (``featureSubsetStrategy``, a share
  as text) are drawn once per tree; rows by a hash of their number, so that a
  retried task draws the same;
* missing values (null, NaN) have a bin of their own that goes to the side
  with the higher gain;
* margins are written to a fresh table every ``TREES_PER_STORE`` trees, which
  cuts the lineage.

Importances are the mean gain of a feature's splits, as shares.  Rows without
a label or with a null weight take no part.  Equal gains go to the feature and
bin that come first.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasSeed, HasStepSize, HasWeightCol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.sources.tables import materialized

TREES_PER_STORE = 8


class _Boosting(HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize, HasSeed, HasPredictionCol, HasProbabilityCol,
                HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", typeConverter=TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows per tree", typeConverter=TypeConverters.toFloat)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "share of features per tree, as text",
                                  typeConverter=TypeConverters.toString)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least summed hessian of a child", typeConverter=TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf weights", typeConverter=TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "a split needs more gain", typeConverter=TypeConverters.toFloat)
    trees = Param(Params._dummy(), "trees", "fitted trees (JSON)", typeConverter=TypeConverters.toString)

    def __init__(self, **kw):
        super().__init__()
        self._setDefault(maxIter=100, maxDepth=6, maxBins=256, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="1.0",
                         minChildWeight=1.0, regLambda=1.0, minGain=0.0, seed=42, trees="[]")
        self._set(**{k: v for k, v in kw.items() if v is not None})

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def getSubsamplingRate(self) -> float:
        return self.getOrDefault(self.subsamplingRate)

    def getFeatureSubsetStrategy(self) -> str:
        return self.getOrDefault(self.featureSubsetStrategy)

    def getMinChildWeight(self) -> float:
        return self.getOrDefault(self.minChildWeight)

    #: What MLlib's trees name the least size of a child; here it is a summed hessian.
    getMinInstancesPerNode = getMinChildWeight


# A tree maps a node's number to its split {"f", "b", "cut", "missing_left", "gain"} or {"leaf"}; node i has 2i+1 and 2i+2 below.

def _route(tree: dict[int, dict], end, node: int = 0) -> Column:
    """``end(number, node)`` of the node that a row's ``bins`` lead to."""
    own = tree.get(node)
    if own is None or "leaf" in own:
        return end(node, own)
    b = F.col("bins")[own["f"]]
    left = (b <= own["b"]) & ((b > 0) | F.lit(own["missing_left"]))
    return F.when(left, _route(tree, end, 2 * node + 1)).otherwise(_route(tree, end, 2 * node + 2))


def _quantile_edges(rows: DataFrame, n_features: int, bins: int) -> list[list[float]]:
    """Ascending cut values of each feature: at most ``bins`` - 2 of its own values."""
    probs = [i / (bins - 1) for i in range(1, bins - 1)]
    edges: list[list[float]] = []
    for at in range(0, n_features, 64):
        part = rows.select(*[F.col("x")[i].alias(f"f{i}") for i in range(at, min(at + 64, n_features))])
        edges += [sorted(set(found)) for found in part.approxQuantile(part.columns, probs, min(1e-3, 0.25 / bins))]
    return edges


def _binned(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """(row, y, w, bins, margin): bin 0 for missing, else 1 + the number of edges below the value."""
    cuts = [np.array(e) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float)
            x = flat.reshape(-1, len(cuts)) if len(cuts) else np.zeros((batch.num_rows, 0))
            found = np.zeros(x.shape, np.int16)
            for i, cut in enumerate(cuts):
                found[:, i] = np.where(np.isnan(x[:, i]), 0, 1 + np.searchsorted(cut, x[:, i], "left"))
            offsets = pa.array(np.arange(batch.num_rows + 1) * len(cuts), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("y"), batch.column("w"),
                 pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.int16())), pa.array(np.zeros(batch.num_rows))],
                names=["row", "y", "w", "bins", "margin"])

    return rows.mapInArrow(run, "row long, y double, w double, bins array<smallint>, margin double")


def _best_splits(rows: DataFrame, features: list[int], penalty: float, least: float) -> dict[int, dict]:
    """Best split and totals of each ``node`` of ``rows(node, bins, g, h)``; a row per node comes to the driver."""
    cells = (rows.select("node", "g", "h", F.posexplode(F.array(*[F.col("bins")[f] for f in features])).alias("k", "b"))
             .groupBy("node", "k", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
    own = Window.partitionBy("node", "k")
    upto = own.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)

    def summed(c: str, w) -> Column:
        return F.sum(c).over(w)

    def missing(c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("b") == 0, F.col(c))).over(own), F.lit(0.0))

    def score(g: Column, h: Column) -> Column:
        return g * g / (h + penalty)

    tables = cells.select("node", "k", "b", summed("g", own).alias("G"), summed("h", own).alias("H"),
                          summed("g", upto).alias("to_g"), summed("h", upto).alias("to_h"),
                          missing("g").alias("no_g"), missing("h").alias("no_h"))
    sides = []
    for to_left in (0, 1):  # running sums hold the missing ones, which come first
        gl = F.col("to_g") - (0 if to_left else F.col("no_g"))
        hl = F.col("to_h") - (0 if to_left else F.col("no_h"))
        gr, hr = F.col("G") - gl, F.col("H") - hl
        gain = F.when((F.col("b") > 0) & (hl >= least) & (hr >= least) & (hl > 0) & (hr > 0),
                      score(gl, hl) + score(gr, hr) - score(F.col("G"), F.col("H")))
        sides.append(F.struct(F.coalesce(gain, F.lit(-1.0)).alias("gain"), (-F.col("k")).alias("k"), (-F.col("b")).alias("b"),
                              F.lit(-to_left).alias("m"), gl.alias("gl"), hl.alias("hl"), F.col("G").alias("G"), F.col("H").alias("H")))
    best = tables.groupBy("node").agg(F.max(F.greatest(*sides)).alias("s")).select("node", "s.*")
    return {r["node"]: r.asDict() | {"k": features[-r["k"]], "b": -r["b"], "m": r["m"] < 0} for r in best.collect()}


class SecondOrderTreesModel(Model, _Boosting):
    def margins(self):
        """A pandas UDF from the features array to the margin."""
        packed = [[[(t[n].get("f", -1), t[n].get("cut", 0.0), t[n].get("missing_left", False), t[n].get("leaf", 0.0)) for n in sorted(t)],
                   sorted(t)] for t in self.fitted()]

        @F.pandas_udf("double")
        def margin(xs: pd.Series) -> pd.Series:
            x = np.stack([np.asarray(v, float) for v in xs]) if len(xs) else np.zeros((0, 1))
            out = np.zeros(len(xs))
            for nodes, numbers in packed:
                place = {n: k for k, n in enumerate(numbers)}
                f, cut, missing, leaf = (np.array(c) for c in zip(*nodes, strict=True))
                left = np.array([place.get(2 * n + 1, 0) for n in numbers])
                right = np.array([place.get(2 * n + 2, 0) for n in numbers])
                at = np.zeros(len(xs), int)
                while (inner := np.flatnonzero(f[at] >= 0)).size:
                    v = x[inner, f[at[inner]]]
                    to_left = np.where(np.isnan(v), missing[at[inner]], v <= cut[at[inner]])
                    at[inner] = np.where(to_left, left[at[inner]], right[at[inner]])
                out += leaf[at]
            return pd.Series(out)

        return margin

    def fitted(self) -> list[dict[int, dict]]:
        return [{int(n): v for n, v in t.items()} for t in json.loads(self.getOrDefault(self.trees))]

    @property
    def getNumTrees(self) -> int:  # noqa: N802 (a property, as in MLlib's models)
        return len(self.fitted())

    @property
    def featureImportances(self):  # noqa: N802 (as MLlib's tree models name it)
        total, n = {}, {}
        for tree in self.fitted():
            for node in (v for v in tree.values() if "f" in v):
                total[node["f"]] = total.get(node["f"], 0.0) + node["gain"]
                n[node["f"]] = n.get(node["f"], 0) + 1
        mean = {f: total[f] / n[f] for f in total}
        whole = sum(mean.values()) or 1.0
        width = max((t[0]["width"] for t in self.fitted()), default=0)
        return Vectors.sparse(width, {f: v / whole for f, v in mean.items()})

    def _transform(self, df: DataFrame) -> DataFrame:
        m = self.margins()(vector_to_array(F.col(self.getFeaturesCol())))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        out = df.withColumn("_margin", m)
        return out.select(*df.columns, array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))).alias(self.getRawPredictionCol()),
                          array_to_vector(F.array(1.0 - p, p)).alias(self.getProbabilityCol()),
                          (F.col("_margin") > 0).cast("double").alias(self.getPredictionCol()))


class SecondOrderTrees(Estimator, _Boosting):
    def _fit(self, df: DataFrame) -> SecondOrderTreesModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) else F.lit(1.0)
        rows = materialized(df.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"),
                                      weight.alias("w")).where("y IS NOT NULL AND w IS NOT NULL")
                            .withColumn("row", F.monotonically_increasing_id()), "boosting-rows")
        first = rows.first()
        if first is None:
            raise ValueError("no rows with a label to fit trees on")
        width = len(first["x"])
        edges = _quantile_edges(rows, width, self.getOrDefault(self.maxBins))
        data, kept, trees = materialized(_binned(rows, edges), "boosting-bins"), [], []
        rng = random.Random(self.getSeed())
        share = float(self.getFeatureSubsetStrategy())
        for k in range(self.getMaxIter()):
            if len(kept) == TREES_PER_STORE:
                data, kept = materialized(self._advanced(data, kept), "boosting-bins"), []
            features = sorted(rng.sample(range(width), max(1, math.floor(share * width)))) if share < 1 else list(range(width))
            tree = self._grown(self._advanced(data, kept), features, edges, k)
            tree[0]["width"] = width
            trees.append(tree)
            kept.append(tree)
        model = SecondOrderTreesModel()
        self._copyValues(model)
        return model._set(trees=json.dumps(trees))

    @staticmethod
    def _advanced(data: DataFrame, trees: list[dict]) -> DataFrame:
        margin = F.col("margin")
        for t in trees:
            margin = margin + _route(t, lambda _, own: F.lit(float(own["leaf"])))
        return data.withColumn("margin", margin)

    def _grown(self, data: DataFrame, features: list[int], edges: list[list[float]], number: int) -> dict[int, dict]:
        rate, penalty, step = self.getSubsamplingRate(), self.getOrDefault(self.regLambda), self.getStepSize()
        if rate < 1:
            draw = F.pmod(F.xxhash64("row", F.lit(self.getSeed()), F.lit(number)), F.lit(1 << 30))
            data = data.where(draw < int(rate * (1 << 30)))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        rows = data.select("bins", (F.col("w") * (p - F.col("y"))).alias("g"),
                           F.greatest(F.col("w") * p * (1 - p), F.lit(1e-16)).alias("h"))
        tree: dict[int, dict] = {}
        open_nodes = {0}
        for depth in range(self.getMaxDepth() + 1):
            placed = rows.withColumn("node", _route(tree, lambda n, own: F.lit(n) if own is None else F.lit(None).cast("int")))
            if depth < self.getMaxDepth():
                found = _best_splits(placed.where("node IS NOT NULL"), features, penalty, self.getMinChildWeight())
            if depth == 0 and not found:
                return {0: {"leaf": 0.0}}
            below = {}
            for n in sorted(open_nodes):
                s = found[n]
                if s["gain"] > self.getOrDefault(self.minGain):
                    tree[n] = {"f": s["k"], "b": s["b"], "missing_left": s["m"], "gain": s["gain"],
                               "cut": edges[s["k"]][s["b"] - 1] if s["b"] <= len(edges[s["k"]]) else math.inf}
                    below[2 * n + 1], below[2 * n + 2] = (s["gl"], s["hl"]), (s["G"] - s["gl"], s["H"] - s["hl"])
                else:
                    tree[n] = {"leaf": -s["G"] / (s["H"] + penalty) * step}
            open_nodes = set(below)
            if depth + 1 >= self.getMaxDepth() or not below:
                tree.update({n: {"leaf": -g / (h + penalty) * step} for n, (g, h) in below.items()})
                break
        return tree
