"""Scans and sinks.

* ``read_table``   – S1: full scan with lower-cased column names.  Column
  pruning and predicate pushdown happen in the parquet scan as soon as a
  caller selects/filters.
* ``query``        – S2: a SQL text scan over registered views.
* ``scan_limit``   – S3: scan with an optional row cap (0/None = no cap).
* ``write_table``  – S4: overwrite of a table folder; the old rows stay until the new ones are complete.
* ``stored``       – write once into the shared checkpoint folder and read the
  stored copy back: the lineage is cut and a lost executor re-reads files
  instead of recomputing the whole build.
* ``materialized`` – the same for an unnamed computed side (group statistics).
* ``tasks_by_bytes`` – shuffles whose tasks stay small however large the input is.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from leadlens.session import checkpoint_dir


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a table folder/file and lower-case its column names."""
    return lower_names(spark.read.format(fmt).load(path))


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL against registered views; names lower-cased like S1."""
    return lower_names(spark.sql(sql))


def scan_limit(df: DataFrame, limit: int | None, order_by: list[str] | None = None) -> DataFrame:
    """S3: ``limit`` rows (ordered by ``order_by`` for a stable pick); 0/None = all."""
    if not limit:
        return df
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(int(limit))


def _write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Drop-and-create that keeps the old rows until the new ones are complete.

    The new table is written beside the old one, under a name that Spark's
    readers skip, and takes its place by renaming.  A write that fails or is
    killed leaves the old table, and a table may be overwritten with rows read
    from itself.  Between the two renames a reader finds no table; a rename
    that fails puts the old one back.
    """
    spark = df.sparkSession
    folder, _, name = path.rstrip("/").rpartition("/")
    beside, mark = f"{folder}/" if folder or path.startswith("/") else "", uuid.uuid4().hex
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh, old = (new_path(p) for p in (path.rstrip("/"), f"{beside}_{name}.new-{mark}", f"{beside}_{name}.old-{mark}"))
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        _write(df, fresh.toString(), fmt, partition_by)
        replaced = store.exists(target)
        if replaced and not store.rename(target, old):
            raise OSError(f"cannot move the table at {path} aside")
        if not store.rename(fresh, target):
            if replaced:
                store.rename(old, target)
            raise OSError(f"cannot move the new table to {path}")
        if replaced:
            store.delete(old, True)
    finally:
        store.delete(fresh, True)


#: Bytes that a task of ``tasks_by_bytes`` reads of a shuffle and of files, and of input for each partition of its shuffles.
TASK_BYTES, SCAN_BYTES, PARTITION_BYTES = 16 << 20, 32 << 20, 4 << 20
MAX_PARTITIONS = 20_000


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads."""
    spark = df.sparkSession
    conf, new_path = spark._jsparkSession.sessionState().newHadoopConf(), spark._jvm.org.apache.hadoop.fs.Path
    paths = [new_path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


@contextmanager
def tasks_by_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it, tasks read ``TASK_BYTES`` of a shuffle and ``SCAN_BYTES`` of a file at most, for an input of ``size`` bytes.

    Rows take many times their stored bytes in memory: in fewer, larger tasks their sorts and hash tables spill.  The
    session's own settings come back at the end; finer ones stay as they are.
    """
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    most = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES, "spark.sql.files.maxPartitionBytes": SCAN_BYTES}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    own = {k: spark.conf.get(k, None) for k in most}
    parts = int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    with settings(spark, {k: min(in_bytes(own[k]) if own[k] else bound, bound) for k, bound in most.items()}
                  | {first: max(parts, min(MAX_PARTITIONS, math.ceil(size / PARTITION_BYTES)))}):
        yield


@contextmanager
def settings(spark: SparkSession, values: dict[str, int]) -> Iterator[None]:
    """The session with these settings, and its own ones again afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_STORED: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build once per application, write under ``spark.checkpoint.dir``, read back."""
    app = spark.sparkContext.applicationId
    key = (app, name)
    if key not in _STORED:
        safe = "".join(ch if ch.isalnum() else "_" for ch in name)
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{app}/{safe}"
        _write(build(), path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def materialized(df: DataFrame, label: str = "side") -> DataFrame:
    """Write ``df`` once to a fresh folder under the checkpoint folder; read it back.

    Like ``stored`` but unnamed: for computed intermediate sides.  The read-back
    copy carries file-size statistics for the optimiser, and a lost executor
    re-reads files instead of recomputing the lineage.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{app}/{label}-{uuid.uuid4().hex}"
    _write(df, path)
    return spark.read.parquet(path)


def load_training(spark: SparkSession, path: str, numeric: list[str], categorical: list[str],
                  fmt: str = "parquet", validate: bool = True):
    """Scan a training table (NaN reads as null) and validate it (V1–V4).

    Returns ``(df, report)`` where ``report`` holds the lazy duplicate-row and
    null-count frames plus the schema warnings; V1 raises on an empty table.
    """
    from leadlens.operators import quality as Q

    df = Q.missing_as_null(read_table(spark, path, fmt))
    if not validate:
        return df, {}
    Q.check_shape(df)
    report = {"duplicates": Q.duplicate_rows(df), "nulls": Q.null_counts(df),
              "dtype_warnings": Q.dtype_warnings(df, numeric, categorical)}
    return df, report
