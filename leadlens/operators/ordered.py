"""Order-dependent computations without a single-partition window.

A window with an ORDER BY but no PARTITION BY pulls every row into one task.
The helpers here split the order key into ``n`` ranges instead:

1. range boundaries: of numbers and times, which are read as a number that
   keeps their order (``order_number``), by ``approxQuantile``; of text keys and
   of keys with tie-breakers by a sample in their own types and order
   (``typed_bounds``).  n−1 boundaries come to the driver;
2. a row's bucket is found by binary search (``Bucketizer``, or a tree of
   comparisons) – a pure function of the key, so that ties always share a bucket
   and every pass agrees on it.  Null keys come before all others;
3. the window runs inside each bucket (``partitionBy(bucket)``);
4. one carry row per bucket (a total, or a last/first non-null value) is
   prefixed over the ≤ n bucket rows and joined back as a broadcast whose
   size is bounded by ``n``.

The key must be nearly unique, or the input pre-aggregated per key with the
boundaries drawn from the aggregated values (AUC groups by score first).  Then
a hot value can't take the boundaries for itself and leave the rest in one
bucket.  Quantiles need no order at all (``selection``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.operators.selection import double_sql as _double_sql
from leadlens.operators.selection import values_at_ranks

BUCKET = "_bucket"
_KEY = "_order_number"


def default_buckets(df: DataFrame) -> int:
    """As many buckets as the session's shuffles have partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def order_number(df: DataFrame, key: str) -> Column:
    """A double that never falls as the key (a number, date or time) rises; dates and times count microseconds.

    Equal numbers share a bucket, where the key itself orders.
    """
    kind, k = df.schema[key].dataType, F.col(key)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(k.cast("timestamp")).cast("double")
    return k.cast("double")


#: Sampled rows per bucket, and the most buckets that a tree of comparisons finds.
SAMPLE_PER_BUCKET, MAX_TYPED_BUCKETS = 64, 1024


def typed_bounds(df: DataFrame, keys: Sequence[str], n: int) -> list[tuple]:
    """Up to n−1 ascending tuples of ``keys`` that split the rows about evenly, in the keys' own types and order.

    The sample is taken by a hash of the keys, so it does not depend on partitions, and is counted per key within the
    tasks before it moves.
    """
    total = df.count()
    if total == 0:
        return []
    least = min(1.0, SAMPLE_PER_BUCKET * n / total)
    hashed = F.pmod(F.xxhash64(*keys, F.lit(7)), F.lit(1 << 30))
    sample = df.select(*keys).where(hashed < int(least * (1 << 30)) + 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Some SAMPLE_PER_BUCKET * n distinct keys at most: one task may order them.
    order = Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    placed = sample.withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_all", F.sum("_n").over(Window.partitionBy()))
    bucket = F.least(F.floor((F.col("_upto") - F.col("_n")) * n / F.col("_all")), F.lit(n - 1))
    firsts = (placed.groupBy(bucket.alias("_b")).agg(F.min(F.struct(*keys)).alias("_k"))
              .where("_b > 0").orderBy("_b").collect())
    return [tuple(r["_k"]) for r in firsts]


def typed_bucket(df: DataFrame, keys: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """0 for rows below the first bound, else the number of the last bound that the row's keys reach."""
    key = F.struct(*keys)
    types = [df.schema[k].dataType for k in keys]
    edges = [F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, b, types, strict=True)]) for b in bounds]

    def pick(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high + 1) // 2
        return F.when(key >= edges[mid - 1], pick(mid, high)).otherwise(pick(low, mid - 1))

    return pick(0, len(edges))


def _clean(bounds) -> list[float]:
    return sorted({float(x) for x in (bounds or []) if x is not None and not math.isnan(x)})


def _splits(bounds: Sequence[float]) -> list[float]:
    inside = [b for b in _clean(bounds) if not math.isinf(b)]
    return [-math.inf, *(inside or [0.0]), math.inf]


def bound_error(n: int) -> float:
    """Relative rank error for ``n`` buckets: a quarter of one bucket's share.

    Bounds stay balanced to within ±25 % of a bucket at any bucket count;
    the quantile summary grows with 1/error, i.e. a few numbers per bucket.
    """
    return min(1e-3, 0.25 / n)


def with_range_bucket(df: DataFrame, key: str, n: int | None = None, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Adds ``BUCKET``, ascending with ``key`` (and ``tie_breakers``, which split a frequent key).

    Null keys without tie-breakers are in bucket -1, NaN in the last.
    """
    n = n or default_buckets(df)
    keys = [key, *[c for c in tie_breakers if c != key]]
    if len(keys) > 1 or isinstance(df.schema[key].dataType, T.StringType):
        bounds = typed_bounds(df, keys, min(n, MAX_TYPED_BUCKETS))
        found = typed_bucket(df, keys, bounds)
        return df.withColumn(BUCKET, F.when(F.col(key).isNull(), -1).otherwise(found) if len(keys) == 1 else found)
    d = df.withColumn(_KEY, order_number(df, key))
    splits = _splits(d.approxQuantile(_KEY, [i / n for i in range(1, n)], bound_error(n)))
    found = Bucketizer(splits=splits, inputCol=_KEY, outputCol=BUCKET, handleInvalid="keep").transform(d)
    return found.withColumn(BUCKET, F.when(F.col(key).isNull(), -1).otherwise(
        F.col(BUCKET).cast("int"))).drop(_KEY)


def prefix_sums(df: DataFrame, key: str, values: Sequence[str], inclusive: bool = True,
                descending: bool = False, n: int | None = None,
                suffix: str = "_cum", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Running sums of ``values`` in ``key`` order (key unique per row).

    Adds ``<v><suffix>`` per value.  ``inclusive`` includes the current row;
    ``descending`` accumulates from the largest key down.  ``tie_breakers``
    order rows that share a key value, and split them into buckets.
    """
    d = with_range_bucket(df, key, n, tie_breakers)
    if descending:
        d = d.withColumn(BUCKET, -F.col(BUCKET))
    totals = d.groupBy(BUCKET).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    # ≤ n rows: a single-partition window here is bounded by n.
    wb = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(BUCKET, *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_c_{v}")
                                    for v in values])
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in (key, *tie_breakers)]
    frame_end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    out = d.join(F.broadcast(carry), BUCKET, "left")
    sums = [(F.coalesce(F.sum(v).over(w), F.lit(0)) + F.col(f"_c_{v}")).alias(v + suffix) for v in values]
    return out.select(*[F.col(c) for c in df.columns if c not in {v + suffix for v in values}], *sums)


def with_group_bucket(df: DataFrame, group: str, key: str, bounds: Sequence[Sequence[float]]) -> DataFrame:
    """Adds ``BUCKET``: the range of ``key`` by the bounds of its row's group index 0..k−1."""
    if not bounds:
        return df.withColumn(BUCKET, F.lit(0))
    inputs, outputs = ([f"{p}{i}" for i in range(len(bounds))] for p in ("_key_", "_range_"))
    d = df.withColumns({c: F.when(F.col(group) == i, F.col(key).cast("double")) for i, c in enumerate(inputs)})
    found = Bucketizer(splitsArray=[_splits(b) for b in bounds], inputCols=inputs, outputCols=outputs,
                       handleInvalid="keep").transform(d)
    chosen = F.coalesce(*[F.when(F.col(group) == i, F.col(c)) for i, c in enumerate(outputs)], F.lit(0.0))
    return found.withColumn(BUCKET, chosen.cast("int")).drop(*inputs, *outputs)


def group_bounds(df: DataFrame, group: str, key: str, groups: int, n: int | None = None) -> list[list[float]]:
    """Bucket bounds of ``key`` for each group index, from one pass over ``df``.

    ``df`` holds each value of a group once, so a frequent value counts as one.
    ``n`` is the bucket count per group; by default the groups share the
    session's bucket count, about what the stacked pass needs in total.
    """
    n = n or max(2, -(-default_buckets(df) // max(1, groups)))
    own = df.select(*[F.when(F.col(group) == i, F.col(key).cast("double")).alias(f"_v{i}") for i in range(groups)])
    return own.approxQuantile(own.columns, [i / n for i in range(1, n)], bound_error(n)) if groups else []


def grouped_prefix_sums(df: DataFrame, group: str, key: str, values: Sequence[str],
                        bounds: Sequence[Sequence[float]], suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``values`` in ascending ``key`` order within each group.

    ``group`` holds indices 0..k−1 and ``bounds[i]`` are group i's bucket
    bounds (``group_bounds``).  Several stacked columns are thus handled in
    one pass; the carry table has at most k·n rows.  ``key`` must be unique
    within a group (pre-aggregate per value first).
    """
    d = with_group_bucket(df, group, key, bounds)
    totals = d.groupBy(group, BUCKET).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wb = Window.partitionBy(group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(group, BUCKET, *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_c_{v}")
                                           for v in values])
    w = (Window.partitionBy(group, BUCKET).orderBy(F.col(key).asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = d.join(F.broadcast(carry), [group, BUCKET], "left")
    sums = [(F.coalesce(F.sum(v).over(w), F.lit(0)) + F.col(f"_c_{v}")).alias(v + suffix) for v in values]
    return out.select(*[F.col(c) for c in df.columns if c not in {v + suffix for v in values}], *sums)


def row_numbers(df: DataFrame, key: str, name: str = "row", n: int | None = None,
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """1-based position of each row in (key, tie_breakers) order."""
    out = prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), key, ["_one"], n=n,
                      tie_breakers=tie_breakers)
    return out.withColumnRenamed("_one_cum", name).drop("_one")


def fill_forward_backward(df: DataFrame, key: str, columns: Sequence[str], n: int | None = None,
                          tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Forward fill then backward fill of ``columns`` in (``key``, ``tie_breakers``) order.

    Rows that agree in all of these are ordered by the filled columns
    themselves, so that the result does not depend on partitions.

    A null that is left after the forward fill has no value before it, so the
    backward fill gives it the first value of the whole order: one sort serves
    both.  Each bucket is filled by itself and stored; its last row then holds
    what it hands on, its last and its first value, and these few rows fill
    what is left.
    """
    from leadlens.sources.tables import materialized

    d = with_range_bucket(df, key, n, tie_breakers)
    order = [key, *tie_breakers, *[c for c in columns if c not in (key, *tie_breakers)]]
    rows = Window.partitionBy(BUCKET).orderBy(*[F.col(c).asc() for c in order])
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    # One projection for all columns: Catalyst then plans one Window operator.
    last = F.lead(F.lit(1)).over(rows).isNull()
    own = materialized(d.select(
        *[F.col(c) for c in df.columns if c not in columns], BUCKET, last.alias("_last"),
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in columns],
        *[F.when(last, F.first(c, ignorenulls=True).over(upto)).alias(f"_first_{c}") for c in columns]), "filled-buckets")
    # One row per bucket: bounded single-partition windows and a bounded broadcast.
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = own.where("_last").select(F.col(BUCKET).alias("_carried"), *[
        F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(f"_first_{c}", ignorenulls=True).over(whole)).alias(f"_carry_{c}")
        for c in columns])
    out = own.join(F.broadcast(carry), F.col(BUCKET) == F.col("_carried"), "left")
    return out.select(*[F.coalesce(c, f"_carry_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    n: int | None = None, stored: bool = False) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy's default), one row.

    Output columns ``<col>_q<i>`` for the i-th probability; null for a column
    with no non-null value.  All columns are handled together by narrowing
    (``selection.values_at_ranks``): a sketch, a count, and a pass that moves
    the few values around the wanted ranks.  Unless ``df`` is a stored table
    already (``stored``), its wanted columns are stored first, so that what it
    is made of runs once.  ``n`` bounds the rows that one rank brings to the
    last pass.
    """
    from leadlens.sources.tables import materialized

    spark, cols = df.sparkSession, list(columns)
    if not cols:
        return spark.range(1).select()
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    if not stored:
        values = materialized(values, "quantile-columns")

    def ranks(_: str, rows: int, p: float) -> tuple[int, int]:
        low = math.floor((rows - 1) * p)
        return low, min(low + 1, rows - 1)

    wanted = sorted({float(p) for p in probs})
    count, found = values_at_ranks(values, wanted, ranks, n)
    out = []
    for i, c in enumerate(cols):
        for j, p in enumerate(map(float, probs)):
            if (f"c{i}", p) not in found:
                out.append(F.lit(None).cast("double").alias(f"{c}_q{j}"))
                continue
            low, high = found[f"c{i}", p]
            h = (count[f"c{i}"] - 1) * p
            part = h - math.floor(h)
            exact = low if part == 0 or low == high else low + part * (high - low)  # infinite ends have no way between
            out.append(F.expr(_double_sql(exact)).alias(f"{c}_q{j}"))
    return spark.range(1, numPartitions=1).select(*out)
