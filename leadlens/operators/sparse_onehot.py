"""One-hot encoding of columns with any number of levels.

The fitted state is a stored table, the level dictionary: one row per column
and level with the level's slot in the output vector.  No level list comes to
the driver and no column is made per level, so a column may have millions:

* fit counts the levels (one aggregate over all columns, pre-aggregated in the
  tasks), numbers them in (column, level) order by bucketed prefix counts and
  writes the dictionary;
* transform joins each column with its part of the dictionary, which Spark
  broadcasts where the stored table is small and else shuffles (a frequent
  level is split by AQE's skew join), and builds one sparse vector per row with
  MLlib's ``OneHotEncoderModel`` and ``VectorAssembler``.

Nulls and levels that the fit did not see are all zeros.  ``dropFirst`` leaves
out the smallest level of each column.  ``minVariance`` leaves out levels whose
indicator has a population variance p(1 - p) of that or less, which is what a
variance filter over the indicator columns would do (T6).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.operators.ordered import row_numbers
from leadlens.operators.prep import _Stage
from leadlens.session import checkpoint_dir
from leadlens.sources.tables import materialized


class _Sparse(_Stage):
    dictionary = Param(Params._dummy(), "dictionary", "folder of the level dictionary", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the vector", typeConverter=TypeConverters.toString)
    minVariance = Param(Params._dummy(), "minVariance", "levels need more variance", typeConverter=TypeConverters.toFloat)

    def __init__(self, inputCols: Sequence[str] | None = None, **kw):
        super().__init__(inputCols, **kw)
        self._setDefault(outputCol="onehot")

    def _copy_to(self, model):
        if self.isSet(self.outputCol):
            model._set(outputCol=self.getOrDefault(self.outputCol))
        return super()._copy_to(model)


class SparseOneHotModel(Model, _Sparse):
    """``stats`` holds the number of slots of each column; slots of the columns follow each other in the vector."""

    def levels(self) -> DataFrame:
        """(column, level, slot): slot counts over all columns, null where a level has none."""
        return SparkSession.active().read.parquet(self.getOrDefault(self.dictionary))

    def size(self) -> int:
        return sum(self._stats().values())

    def _joined(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_slot_<i>`` per column: its place among the column's own slots, null for none."""
        table, sizes, before = self.levels(), self._stats(), 0
        for i, c in enumerate(self.getInputCols()):
            own = table.where(F.col("column") == c).where("slot IS NOT NULL").select(
                F.col("level").alias(f"_level_{i}"), (F.col("slot") - before).alias(f"_slot_{i}"))
            df = df.join(own, F.col(c).cast("string") == F.col(f"_level_{i}"), "left").drop(f"_level_{i}")
            before += sizes[c]
        return df

    def slots(self, df: DataFrame, output: str = "slots") -> DataFrame:
        """``df`` with the array of the slots that are 1 in each row."""
        sizes, before, found = self._stats(), 0, []
        for i, c in enumerate(self.getInputCols()):
            found.append(F.col(f"_slot_{i}") + before)
            before += sizes[c]
        return self._joined(df).select(*[F.col(c) for c in df.columns], F.array_compact(F.array(*found)).alias(output))

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes = self._stats()
        used = [(i, c) for i, c in enumerate(self.getInputCols()) if sizes[c]]
        names, vectors = [f"_slot_{i}" for i, _ in used], [f"_vector_{i}" for i, _ in used]
        joined = self._joined(df)
        # A place beyond the last is "invalid", which dropLast turns into zeros.
        placed = joined.select(*[F.col(c) for c in df.columns], *[
            F.coalesce(F.col(n), F.lit(sizes[c])).cast("double").alias(n, metadata={
                "ml_attr": {"type": "nominal", "name": n, "num_vals": sizes[c]}}) for n, (_, c) in zip(names, used, strict=True)])
        if used:
            encoder = OneHotEncoder(inputCols=names, outputCols=vectors, dropLast=True, handleInvalid="keep")
            placed = encoder.fit(placed).transform(placed)  # sizes come from the metadata: no job
        out = VectorAssembler(inputCols=vectors, outputCol=self.getOrDefault(self.outputCol)).transform(placed)
        return out.select(*df.columns, self.getOrDefault(self.outputCol))


class SparseOneHot(Estimator, _Sparse):
    """Without ``dictionary`` the level table goes to a fresh folder in the checkpoint folder."""

    def _fit(self, df: DataFrame) -> SparseOneHotModel:
        cols = self.getInputCols()
        pairs = ", ".join(f"{i}, CAST(`{c}` AS STRING)" for i, c in enumerate(cols))
        counted = materialized(
            df.selectExpr(f"stack({len(cols)}, {pairs}) AS (_column, level)").groupBy("_column", "level")
            .agg(F.count(F.lit(1)).alias("rows")), "levels")
        total = counted.where("_column = 0").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        known = counted.where("level IS NOT NULL")
        kept = F.lit(True)
        if self.isDefined(self.minVariance):
            share = F.col("rows") / F.lit(max(total, 1))
            kept = share * (1 - share) > F.lit(self.getOrDefault(self.minVariance))
        if self.getOrDefault(self.dropFirst):
            first = F.broadcast(known.groupBy("_column").agg(F.min("level").alias("_first")))  # a row per column
            known = known.join(first, "_column").withColumn("_kept", kept & (F.col("level") != F.col("_first"))).drop("_first")
        else:
            known = known.withColumn("_kept", kept)
        named = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_column") + 1).alias("column")
        # Left out levels have no number, so the others are numbered among themselves.
        placed = row_numbers(known.where("_kept").select("_column", "level"), "_column", "_n", tie_breakers=["level"])
        slots = placed.select(named, "level", (F.col("_n") - 1).cast("long").alias("slot"))
        rest = known.where("NOT _kept").select(named, "level", F.lit(None).cast("long").alias("slot"))
        path = self.getOrDefault(self.dictionary) if self.isDefined(self.dictionary) else (
            f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{df.sparkSession.sparkContext.applicationId}/"
            f"dictionary-{uuid.uuid4().hex}")
        slots.unionByName(rest).write.mode("overwrite").parquet(path)
        sizes = {r["column"]: r["n"] for r in df.sparkSession.read.parquet(path).groupBy("column").agg(
            F.count("slot").alias("n")).collect()}
        model = SparseOneHotModel(cols, stats=json.dumps({c: sizes.get(c, 0) for c in cols}))
        model._set(dictionary=path)
        return self._copy_to(model)
