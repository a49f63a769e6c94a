import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from leadlens.operators import boosting as B
from leadlens.operators import models as M


def rows(n, seed, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5 > 0).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y, rng.choice([1.0, 2.0], n)


def frame(spark, x, y, w):
    df = spark.createDataFrame(pd.DataFrame({**{f"x{i}": x[:, i] for i in range(x.shape[1])}, "label": y, "weight": w, "id": range(len(y))}))
    return VectorAssembler(inputCols=[f"x{i}" for i in range(x.shape[1])], outputCol="features", handleInvalid="keep").transform(df).repartition(4)


def plain_trees(x, y, w, edges, n_trees, depth, step, penalty=1.0, least=1.0):
    """Margins by the same rules, one node at a time over all rows."""
    bins = np.stack([np.where(np.isnan(c), 0, 1 + np.searchsorted(e, c, "left")) for c, e in zip(x.T, edges)], 1)
    margin = np.zeros(len(y))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        todo, add = [(np.arange(len(y)), 0)], np.zeros(len(y))
        while todo:
            at, d = todo.pop()
            G, H = g[at].sum(), h[at].sum()
            best = (0.0, None)
            for f in range(x.shape[1]) if d < depth else ():
                for b in range(1, len(edges[f]) + 2):
                    for to_left in (False, True):
                        left = (bins[at, f] <= b) & ((bins[at, f] > 0) | to_left)
                        gl, hl = g[at][left].sum(), h[at][left].sum()
                        if left.any() and not left.all() and min(hl, H - hl) >= least:
                            gain = gl ** 2 / (hl + penalty) + (G - gl) ** 2 / (H - hl + penalty) - G ** 2 / (H + penalty)
                            if gain > best[0] + 1e-9:
                                best = (gain, left)
            if best[1] is None:
                add[at] = -G / (H + penalty) * step
            else:
                todo += [(at[best[1]], d + 1), (at[~best[1]], d + 1)]
        margin += add
    return margin


@pytest.mark.parametrize("missing", [0.0, 0.1])
def test_equals_plain_trees_on_500_rows(spark, missing):
    x, y, w = rows(500, 1, missing)
    df = frame(spark, x, y, w)
    model = B.SecondOrderTrees(maxIter=3, maxDepth=3, maxBins=16, stepSize=0.3, weightCol="weight").fit(df)
    got = {r.id: r.rawPrediction[1] for r in model.transform(df).collect()}
    kept = df.select("id", "features").orderBy("id").collect()
    assert [r.id for r in kept] == list(range(500))
    from pyspark.ml.functions import vector_to_array
    edges = B._quantile_edges(df.select(vector_to_array("features").alias("x")), 4, 16)
    want = plain_trees(x, y, w, edges, 3, 3, 0.3)
    assert np.allclose([got[i] for i in range(500)], want, atol=1e-6)


def test_draws_once_per_tree_and_saves(spark, tmp_path):
    x, y, w = rows(400, 2)
    df = frame(spark, x, y, w)
    est = B.SecondOrderTrees(maxIter=10, maxDepth=2, maxBins=16, subsamplingRate=0.8, featureSubsetStrategy="0.5", minChildWeight=5.0)
    model = est.fit(df)
    used = [{v["f"] for v in t.values() if "f" in v} for t in model.fitted()]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2
    again = est.fit(df.repartition(1).sortWithinPartitions("id"))
    assert [{v["f"] for v in t.values() if "f" in v} for t in again.fitted()][0] <= {0, 1, 2, 3}
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and len(shares) == 4
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).stages[0]
    a, b = (sorted((r.id, r.probability[1]) for r in m.transform(df).collect()) for m in (model, back))
    assert a == b and M.evaluate(model, df).first().roc_auc > 0.8


def test_odd_rows(spark):
    x, y, w = rows(60, 3)
    x[:, 3] = np.nan
    df = frame(spark, x, y, w).withColumn("label", F.when(F.col("id") % 10 != 0, F.col("label")))
    model = B.SecondOrderTrees(maxIter=2, maxDepth=2, maxBins=8).fit(df)
    assert 3 not in {v.get("f") for t in model.fitted() for v in t.values()} and model.transform(df).count() == 60
    one = B.SecondOrderTrees(maxIter=2).fit(df.where("label = 1"))
    assert all(r.prediction == 1 for r in one.transform(df).collect())
    with pytest.raises(ValueError):
        B.SecondOrderTrees(maxIter=1).fit(df.where("label IS NULL"))
