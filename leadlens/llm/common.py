"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.sources.tables import materialized

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["UPPER", "ascii_lower", "broadcast_if_small", "drop_rows", "keep_rows", "materialized", "removed", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def removed(stored: DataFrame) -> None:
    """Delete the folder of a ``materialized`` table that nothing reads any more."""
    spark = stored.sparkSession
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` has a fast path for ASCII but also changes other letters, so it
    only serves values without any multi-byte character.
    """
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def broadcast_if_small(side: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a stored side of at most ``max_rows`` rows; else leave a shuffle join.

    ``side`` must be a stored table: counting it then reads file footers only.
    """
    return F.broadcast(side) if side.count() <= max_rows else side


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``keep(keep_id, keep_text)`` names, each once.

    ``keep`` is a stored table with one row per row to keep: its id and the
    xxhash64 of its text.  Ids are unique in a sound corpus, so a semi-join
    on the id is enough; where an id repeats, id and text hash decide and a
    repeated row stays once.  Null ids match null ids.
    """
    repeats = keep.groupBy("keep_id").count().where("count > 1").limit(1).count()
    total = docs.select(id_col).groupBy(id_col).count().where("count > 1").limit(1).count()
    if not repeats and not total:
        side = keep.select("keep_id")
        return docs.join(side, docs[id_col].eqNullSafe(side["keep_id"]), "left_semi")
    # A struct holds the row, so that no column name can clash.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs[id_col].alias("row_id"),
                       F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("row_text"))
    kept = rows.join(keep, F.col("row_id").eqNullSafe(F.col("keep_id"))
                     & (F.col("row_text") == F.col("keep_text")), "left_semi")
    return kept.dropDuplicates(["row_id", "row_text"]).select("row.*")


def drop_rows(docs: DataFrame, bad: DataFrame, id_col: str, text_col: str, max_broadcast: int = 500_000) -> DataFrame:
    """``docs`` without the rows that the stored ``bad(bad_id, bad_text)`` names by id and text hash."""
    own = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    # 16 bytes a row: 500,000 are some 8 MB.
    side = broadcast_if_small(bad.select("bad_id", "bad_text"), max_broadcast)
    return docs.join(side, docs[id_col].eqNullSafe(side["bad_id"]) & (own == side["bad_text"]), "left_anti")
