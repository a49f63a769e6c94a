"""Catalogue and profile of tables (S8): what there is, types, row and null counts, sample rows.

* ``folder_tables`` / ``catalogue_tables`` find the tables of a folder or of a
  database, so that no list is written by hand.
* ``profile`` – one aggregate per table (``count`` plus one ``count_if`` per
  column, then ``stack`` to one row per column).
* ``summary`` – one row per table: rows, columns and a sample of the first rows
  as an array of structs.  The sample is an ordered ``limit`` of all columns,
  so it is the same in each run; only ``n`` rows per task are sorted and moved.

Frames of several tables are unions, so one job profiles them all.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.operators.joins import attach_row


def folder_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables of a folder by name: files and folders called ``<name>.<fmt>`` or, if folders, just ``<name>``.

    Names that begin with ``_`` or ``.`` are not tables, as for Spark's readers.  A folder without tables gives none.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = {}
    for entry in store.listStatus(path):
        name = entry.getPath().getName()
        own = name.removesuffix(f".{fmt}")
        if name[0] not in "._" and (own != name or entry.isDirectory()):
            found[own] = spark.read.format(fmt).load(entry.getPath().toString())
    return dict(sorted(found.items()))


def catalogue_tables(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The tables and views that the session's catalogue lists, temporary views included, by name."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()

    def full(t) -> str:
        return ".".join(f"`{p}`" for p in ([] if t.isTemporary else [*(t.namespace or [])]) + [t.name])

    return {t.name: spark.table(full(t)) for t in sorted(listed, key=lambda t: t.name)}


def profile(df: DataFrame, table_name: str) -> DataFrame:
    cols = df.columns
    types = dict(df.dtypes)
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"{i}, '{c}', '{types[c]}', `__n{i}`" for i, c in enumerate(cols))
    return one.selectExpr(
        f"'{table_name}' AS table_name", "__rows AS row_count",
        f"stack({len(cols)}, {parts}) AS (ordinal, column_name, data_type, null_count)")


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        p = profile(df, name)
        out = p if out is None else out.unionByName(p)
    return out


def sample(df: DataFrame, n: int = 3, order_by: str | None = None) -> DataFrame:
    """A stable preview (O3): the first ``n`` rows by ``order_by`` (first column by default)."""
    return df.orderBy(order_by or df.columns[0]).limit(n)


def summary(df: DataFrame, table_name: str, n: int = 3) -> DataFrame:
    """One row: table_name, row_count, n_columns, sample array<struct of the table's columns> (``n`` first rows, nulls first)."""
    first = df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in df.columns if _orderable(df, c)]).limit(n)
    rows = first.agg(F.sort_array(F.collect_list(F.struct(F.struct("*").alias("row")))).alias("rows")) if _orderable(df) else \
        first.agg(F.collect_list(F.struct(F.struct("*").alias("row"))).alias("rows"))
    return attach_row(df.agg(F.count(F.lit(1)).alias("row_count")), rows).select(
        F.lit(table_name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("n_columns"),
        F.transform("rows", lambda r: r["row"]).alias("sample"))


def _orderable(df: DataFrame, column: str | None = None) -> bool:
    """Whether Spark can order the column (or all columns): not maps and variants, at any depth."""
    kinds = dict(df.dtypes)
    return not any(mark in kinds[c] for c in ([column] if column else df.columns) for mark in ("map<", "variant"))


def summaries(tables: Mapping[str, DataFrame], n: int = 3) -> DataFrame:
    """``summary`` of all tables in one frame; a sample row is its JSON text, as structs of different tables have no common type."""
    def told(rows: str) -> Column:
        return F.transform(rows, lambda r: F.to_json(r, {"ignoreNullFields": "false"})).alias(rows)

    return reduce(DataFrame.unionByName, [summary(df, name, n).withColumn("sample", told("sample")) for name, df in tables.items()])
