"""Left lookups.

All joins in the feature build are left joins from the lead table to a
side keyed on a unique value.  Two physical shapes are used:

* ``bounded_broadcast`` / ``bounded_lookup`` – for group statistics and lookup
  tables whose size is unknown up front.  One narrow aggregate adds up the
  bytes that the side's rows take in memory, and the side is only hinted when
  they are within ``max_bytes``; file sizes and plan estimates are no bound,
  because encoded columns grow by any factor when read.  Beyond it the join
  shuffles, AQE's skew-join splits hot keys, and rows with a null key (they
  match nothing) are spread over all tasks instead of meeting in one.
* plain equi-joins on the lead id for the per-lead aggregates; those sides
  arrive hash-partitioned on ``lead_id`` by their own aggregation, so the lead
  table is shuffled once and every aggregate joins without another exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType, ArrayType, MapType, VariantType

# Broadcast limit in bytes of rows in memory for lookup/statistics sides.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
#: Rows with a null key go to this many different keys of a shuffled lookup.
NULL_SPREAD = 100_003


def _variable_bytes(name: str, kind: DataType) -> Column:
    """Bytes of a value beyond its eight-byte slot; nested values count as their JSON text."""
    value = F.col(f"`{name}`")
    if isinstance(kind, StringType | BinaryType):
        size = F.octet_length(value)
    elif isinstance(kind, StructType | ArrayType | MapType | VariantType):
        size = 8 * F.octet_length(F.to_json(F.struct(value)))
    else:
        return F.lit(0)
    return F.coalesce(size + 8, F.lit(0))


def bytes_in_memory(side: DataFrame) -> tuple[int, int]:
    """(rows, bytes) that ``side`` takes as a broadcast relation: slots, null bits, a pointer each, variable parts."""
    fields = side.schema.fields
    fixed = 8 * len(fields) + 8 * (1 + len(fields) // 64) + 16
    each = sum((_variable_bytes(f.name, f.dataType) for f in fields), F.lit(fixed))
    row = side.agg(F.count(F.lit(1)), F.sum(each)).first()
    return row[0], int(row[1] or 0)


def fits_broadcast(side: DataFrame, max_rows: int | None = None, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    rows, size = bytes_in_memory(side)
    return size <= max_bytes and (max_rows is None or rows <= max_rows)


def bounded_broadcast(side: DataFrame, max_rows: int | None = None, materialize: bool = False,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``side`` only after adding up its bytes (and counting its rows, where a bound is given).

    ``materialize=True`` is for computed sides (group statistics): the side is
    written as a table under the shared checkpoint folder and read back, so the
    check and the join read the same stored rows, the lineage is cut, and a
    lost executor does not force the aggregate to be recomputed.
    """
    if materialize:
        from leadlens.sources.tables import materialized

        side = materialized(side, "broadcast-side")
    return F.broadcast(side) if fits_broadcast(side, max_rows, max_bytes) else side


def bounded_lookup(df: DataFrame, side: DataFrame, left_key: str | Column, right_key: str, spread_by: str,
                   max_rows: int | None = None, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, fits: bool | None = None) -> DataFrame:
    """``df ⟕ side`` on one key, nulls matching nothing, without the side's key.

    A side within the bounds is broadcast.  Otherwise both sides shuffle on
    (key, number), where the number is 0 but for null keys of ``df``: these get
    one from a hash of ``spread_by``, so that they don't meet in one task.
    ``fits`` is the outcome of the check, where the caller has made it.
    """
    if fits_broadcast(side, max_rows, max_bytes) if fits is None else fits:
        return left_lookup(df, F.broadcast(side), left_key, right_key)
    key = F.col(left_key) if isinstance(left_key, str) else left_key
    # One type on both sides, as a plain comparison would have.
    kind = df.select(key.alias("k")).union(side.select(right_key)).schema[0].dataType
    part = F.when(key.isNull(), 1 + F.pmod(F.xxhash64(spread_by), F.lit(NULL_SPREAD))).otherwise(F.lit(0).cast("long"))
    left = F.struct(key.cast(kind).alias("key"), part.alias("part"))
    right = F.struct(side[right_key].cast(kind).alias("key"), F.lit(0).cast("long").alias("part"))
    return df.join(side, left == right, "left").drop(side[right_key])


def unique_key(side: DataFrame, key: str, label: str) -> DataFrame:
    """``side``, after making sure that no key repeats; a repeated key would multiply rows."""
    again = side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    row = again.first()
    if row is not None:
        raise ValueError(f"{label}: key {row[key]} occurs {row['n']} times")
    return side


def prefixed(side: DataFrame, prefix: str) -> DataFrame:
    return side.select([F.col(c).alias(prefix + c) for c in side.columns])


def left_lookup(df: DataFrame, side: DataFrame, left_key: str | Column, right_key: str,
                null_safe: bool = False, drop_key: bool = True) -> DataFrame:
    """``df ⟕ side`` on one key; ``null_safe`` matches null to null (pandas merge)."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    rk = side[right_key]
    cond = lk.eqNullSafe(rk) if null_safe else (lk == rk)
    out = df.join(side, cond, "left")
    return out.drop(rk) if drop_key else out


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (fitted constants) to every row.

    ``row`` comes from a global aggregate, so it has exactly one row.  It is
    evaluated once, as a scalar subquery whose value is a constant of the plan.
    """
    fitted = "_fitted_row"
    out = df.withColumn(fitted, row.select(F.struct(*row.columns).alias(fitted)).scalar())
    return out.select(*[F.col(c) for c in df.columns], *[F.col(fitted)[c].alias(c) for c in row.columns])
