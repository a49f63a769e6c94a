"""Preprocessing estimators (T1–T7) as MLlib pipeline stages.

Each estimator fits with one aggregate (or one distinct scan for category
levels) and keeps only the fitted constants – a few numbers per column –
which the model applies as column expressions.  They compose with MLlib
classifiers in a ``Pipeline`` and save/load with it.

* ``PopulationScaler`` (T1): (x − mean) / population std; a zero std divides
  by 1.  (MLlib's ``StandardScaler`` uses the sample std.)
* ``OneHot`` (T2/T3): sorted levels, optional drop-first, unseen → zeros.
* ``MedianImputer`` (T4): exact median fitted on the training rows.
* ``ConstantImputer`` (T4): null → constant (``"missing"``).
* ``VarianceFilter`` (T6): keeps columns with population variance > t.
* ``FeaturePipeline`` (T5/T7): routing + assembling, "not fitted" error.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.operators.ordered import exact_quantiles
from leadlens.operators.quality import missing_as_null

MISSING = "missing"


class _Fitted(Params):
    stats = Param(Params._dummy(), "stats", "fitted constants (JSON)", typeConverter=TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "variance threshold", typeConverter=TypeConverters.toFloat)
    dropFirst = Param(Params._dummy(), "dropFirst", "drop the first level", typeConverter=TypeConverters.toBoolean)
    fillValue = Param(Params._dummy(), "fillValue", "constant fill", typeConverter=TypeConverters.toString)

    def _stats(self) -> dict:
        return json.loads(self.getOrDefault(self.stats))


class _Stage(HasInputCols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols: Sequence[str] | None = None, **kw):
        super().__init__()
        self._setDefault(threshold=0.0, dropFirst=False, fillValue=MISSING, stats="{}")
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        for k, v in kw.items():
            if v is not None:
                self._set(**{k: v})

    def _copy_to(self, model):
        for p in ("inputCols", "threshold", "dropFirst", "fillValue"):
            if self.isSet(getattr(self, p)):
                model._set(**{p: self.getOrDefault(getattr(self, p))})
        return model


# T1 -------------------------------------------------------------------------
class PopulationScalerModel(Model, _Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._stats()
        cols = []
        for c in df.columns:
            if c in st:
                mean, std = st[c]
                value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
                cols.append(((value - F.lit(mean or 0.0)) / F.lit(std or 1.0)).alias(c))
            else:
                cols.append(F.col(c))
        return df.select(*cols)


class PopulationScaler(Estimator, _Stage):
    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        df = missing_as_null(df, cols)
        row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
        st = {c: [row[f"m_{c}"], (row[f"s_{c}"] if row[f"s_{c}"] else 1.0)] for c in cols}
        return self._copy_to(PopulationScalerModel(cols, stats=json.dumps(st)))


# T2 / T3 --------------------------------------------------------------------
class OneHotModel(Model, _Stage):
    def output_columns(self) -> list[str]:
        st = self._stats()
        return [f"{c}_{v}" for c in self.getInputCols() for v in st[c]]

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._stats()
        out = [F.col(c) for c in df.columns]
        for c in self.getInputCols():
            for v in st[c]:
                out.append(F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}"))
        return df.select(*out)


# Largest level count per column that one-hot encoding accepts; every level
# becomes an output column and part of the fitted state on the driver.
MAX_LEVELS = 100_000


class OneHot(Estimator, _Stage):
    """Levels are the sorted distinct non-null values; the level list per
    column is the fitted state (its size is the column's cardinality).

    Fitting takes two passes over all columns at once: a fixed-memory
    cardinality estimate (HyperLogLog) that rejects a column with more than
    ``maxLevels`` levels, then one ``collect_set`` aggregate whose size that
    check has bounded.  No level is ever dropped.
    """

    maxLevels = Param(Params._dummy(), "maxLevels", "largest accepted level count per column",
                      typeConverter=TypeConverters.toInt)

    def __init__(self, inputCols: Sequence[str] | None = None, **kw):
        super().__init__(inputCols, **kw)
        self._setDefault(maxLevels=MAX_LEVELS)

    def _fit(self, df: DataFrame) -> OneHotModel:
        cols = self.getInputCols()
        limit = self.getOrDefault(self.maxLevels)
        est = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
        # approx_count_distinct has ~5 % relative error; only a clear excess fails.
        too_many = {c: est[c] for c in cols if est[c] > limit * 1.1}
        if too_many:
            raise ValueError(f"too many categories for one-hot encoding (limit {limit}): {too_many}")
        row = df.agg(*[F.collect_set(c).alias(c) for c in cols]).first()
        st = {}
        for c in cols:
            levels = sorted(row[c])
            if len(levels) > limit:
                raise ValueError(f"too many categories for one-hot encoding in {c}: {len(levels)} > {limit}")
            st[c] = levels[1:] if self.getOrDefault(self.dropFirst) else levels
        return self._copy_to(OneHotModel(cols, stats=json.dumps(st)))


# T4 -------------------------------------------------------------------------
class MedianImputerModel(Model, _Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        # A column without any value to learn from is filled with 0.
        st = self._stats()
        null = F.lit(None).cast("double")
        return df.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), null), F.lit(st[c] or 0.0)).alias(c)
                           if c in st else F.col(c) for c in df.columns])


class MedianImputer(Estimator, _Stage):
    def _fit(self, df: DataFrame) -> MedianImputerModel:
        cols = self.getInputCols()
        row = exact_quantiles(df, cols, [0.5]).first()
        st = {c: row[f"{c}_q0"] for c in cols}
        return self._copy_to(MedianImputerModel(cols, stats=json.dumps(st)))


class ConstantImputer(Transformer, _Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        v = self.getOrDefault(self.fillValue)
        cols = set(self.getInputCols())
        return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(v)).alias(c) if c in cols
                           else F.col(c) for c in df.columns])


# T6 -------------------------------------------------------------------------
class VarianceFilterModel(Model, _Stage):
    def kept(self) -> list[str]:
        return self._stats()["kept"]

    def _transform(self, df: DataFrame) -> DataFrame:
        dropped = set(self.getInputCols()) - set(self.kept())
        return df.drop(*dropped)


def variance_table(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """(column_name, variance, kept): population variance of each column, kept if > t."""
    one = missing_as_null(df, cols).agg(*[F.var_pop(c).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = one.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, variance)")
    return long.withColumn("kept", F.coalesce(F.col("variance") > F.lit(float(threshold)), F.lit(False)))


class VarianceFilter(Estimator, _Stage):
    def _fit(self, df: DataFrame) -> VarianceFilterModel:
        cols = self.getInputCols()
        t = self.getOrDefault(self.threshold)
        rows = {r["column_name"]: r["kept"] for r in variance_table(df, cols, t).collect()}
        kept = [c for c in cols if rows.get(c)]
        return self._copy_to(VarianceFilterModel(cols, stats=json.dumps({"kept": kept})))


# T5 / T7 ----------------------------------------------------------------------
def preprocessor(numeric: Sequence[str], categorical: Sequence[str], drop_first: bool = False,
                 impute: bool = True, scale: bool = True) -> list:
    """Stages for the training preprocessor: median-impute + scale numerics,
    constant-impute + one-hot categoricals.  Assembly happens after fitting,
    when the one-hot level names are known."""
    stages: list = []
    if numeric:
        if impute:
            stages.append(MedianImputer(numeric))
        if scale:
            stages.append(PopulationScaler(numeric))
    if categorical:
        if impute:
            stages.append(ConstantImputer(categorical))
        stages.append(OneHot(categorical, dropFirst=drop_first))
    return stages


def assembled_columns(fitted_stages, numeric: Sequence[str]) -> list[str]:
    cols = list(numeric)
    for st in fitted_stages:
        if isinstance(st, OneHotModel):
            cols += st.output_columns()
    return cols


class FeaturePipeline:
    """Fit on training rows, then transform any rows into a ``features`` vector.

    Numeric columns are scaled (population std), categoricals one-hot encoded
    with the first level dropped, the remainder dropped, then a variance
    filter (threshold 0.01) selects columns before assembly.

    ``sparse`` encodes categoricals into one sparse vector from a stored level
    dictionary, for columns of any cardinality; the variance filter then acts
    on the levels' shares.  ``columns`` names the vector instead of the levels.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str],
                 variance_threshold: float = 0.01, drop_first: bool = True,
                 impute: bool = False, output_col: str = "features", sparse: bool = False):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.variance_threshold, self.drop_first = variance_threshold, drop_first
        self.impute, self.output_col, self.sparse = impute, output_col, sparse
        self.model = None
        self.columns: list[str] = []

    def fit(self, df: DataFrame) -> FeaturePipeline:
        if self.sparse:
            return self._fit_sparse(df)
        stages = preprocessor(self.numeric, self.categorical, self.drop_first, impute=self.impute)
        prep = Pipeline(stages=stages).fit(df)
        cols = assembled_columns(prep.stages, self.numeric)
        var = VarianceFilter(cols, threshold=self.variance_threshold).fit(prep.transform(df))
        self.columns = var.kept()
        assembler = VectorAssembler(inputCols=self.columns, outputCol=self.output_col,
                                    handleInvalid="keep")
        from pyspark.ml import PipelineModel
        self.model = PipelineModel(stages=[*prep.stages, var, assembler])
        return self

    def _fit_sparse(self, df: DataFrame) -> FeaturePipeline:
        from pyspark.ml import PipelineModel

        from leadlens.operators.sparse_onehot import SparseOneHot

        prep = Pipeline(stages=preprocessor(self.numeric, [], impute=self.impute)).fit(df)
        kept = VarianceFilter(self.numeric, threshold=self.variance_threshold).fit(prep.transform(df)).kept() if self.numeric else []
        fills = [ConstantImputer(self.categorical)] if self.impute and self.categorical else []
        source = fills[0].transform(df) if fills else df
        levels = [SparseOneHot(self.categorical, dropFirst=self.drop_first, minVariance=self.variance_threshold,
                               outputCol="_levels").fit(source)] if self.categorical else []
        self.columns = [*kept, *["_levels" for _ in levels]]
        assembler = VectorAssembler(inputCols=self.columns, outputCol=self.output_col, handleInvalid="keep")
        self.model = PipelineModel(stages=[*prep.stages, *fills, *levels, assembler])
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("this feature pipeline is not fitted yet: fit it on training rows before transforming")
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
