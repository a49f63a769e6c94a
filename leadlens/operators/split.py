"""Deterministic stratified splits.

A row's band comes from a hash of ``seed || ':' || id``: the first 8 hex digits of
its MD5 as a fraction in [0, 1).  The fraction is independent of the class,
so every class is split in the same proportions in expectation, with no
shuffle and no dependence on partitioning.  (The source's shuffled
``train_test_split`` cannot be reproduced bit for bit; this rule is its
reproducible, distributed replacement, and is exactly expressible in SQL.)

``exact=True`` gives exact per-class quotas: the rows of a class with the
smallest hashes leave it.  The hash at which each class is cut is found by
exact selection (``selection.values_at_ranks``) over the hashes alone, and rows
are compared with it: no window, no shuffle of rows.  Only rows whose hash
equals a cut that falls among equal hashes are ordered by id.  A label with
many classes is ranked by bucketed prefix counts (``ordered.row_numbers``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.operators.ordered import row_numbers
from leadlens.operators.selection import double_sql, values_at_ranks

DEFAULT_SEED = 42


def hash_fraction(id_col: str | Column, seed: int = DEFAULT_SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def band(fraction: Column, cutoffs: Sequence[float], names: Sequence[str]) -> Column:
    """names[i] where fraction < cutoffs[i] (first match); last name otherwise."""
    expr = None
    for cut, name in zip(cutoffs, names):
        expr = (F.when(fraction < F.lit(cut), F.lit(name)) if expr is None
                else expr.when(fraction < F.lit(cut), F.lit(name)))
    return expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])


def three_way_split(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED,
                    holdout: float = 0.30, test_share_of_holdout: float = 1 / 3) -> DataFrame:
    """Train / validation / test = 70 / 20 / 10 by default."""
    f = hash_fraction(id_col, seed)
    train_cut = 1 - holdout
    val_cut = train_cut + holdout * (1 - test_share_of_holdout)
    return df.withColumn("split", band(f, [train_cut, val_cut], ["train", "validation", "test"]))


def train_test_split(df: DataFrame, id_col: str, test_size: float = 0.2,
                     seed: int = DEFAULT_SEED, label_col: str | None = None,
                     exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test).  ``exact`` enforces per-class counts of round(n·test_size)."""
    if not exact:
        f = hash_fraction(id_col, seed)
        return df.where(f >= test_size), df.where(f < test_size)
    if label_col is None:
        raise ValueError("exact split needs label_col")
    flagged = exact_test_flag(df, id_col, label_col, test_size, seed)
    return (flagged.where(~F.col("_is_test")).drop("_is_test"),
            flagged.where(F.col("_is_test")).drop("_is_test"))


#: A label with more classes than this is no class label (the class table is one task's work).
MAX_CLASSES = 10_000


def class_table(df: DataFrame, label_col: str) -> DataFrame:
    """(_class, _index, _cls_n, _off) per class, null being a class of its own: a few rows."""
    counts = df.groupBy(F.col(label_col).alias("_class")).agg(F.count(F.lit(1)).alias("_cls_n"))
    classes = counts.limit(MAX_CLASSES + 1).count()
    if classes > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} values: not a class label")
    order = Window.orderBy(F.col("_class").asc_nulls_first())
    return counts.select("_class", "_cls_n", F.row_number().over(order).alias("_index"),
                         F.coalesce(F.sum("_cls_n").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("_off"))


def ranked_in_class(df: DataFrame, id_col: str, label_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Adds ``_rank`` (1-based, by hash within the class) and ``_cls_n``.

    Rows are numbered once in (class index, hash, id) order by bucketed prefix
    counts, so no class is pulled into one task; a class's offset is the
    number of rows of the classes before it in that same order.
    """
    classes = class_table(df, label_col)
    named = df.join(F.broadcast(classes), F.col(label_col).eqNullSafe(F.col("_class"))).drop("_class")
    keyed = named.withColumn("_k", F.col("_index") * 2.0 + hash_fraction(id_col, seed))
    ranked = row_numbers(keyed, "_k", name="_rn", tie_breakers=[id_col])
    return ranked.withColumn("_rank", F.col("_rn") - F.col("_off")).drop("_k", "_index", "_off", "_rn")


#: Up to so many classes get a column each for the selection of their cuts.
MAX_CUT_CLASSES = 64


def in_quota(df: DataFrame, id_col: str, label_col: str, quotas: Sequence[Callable[[Column], Column]],
             seed: int = DEFAULT_SEED) -> tuple[DataFrame, list[Column]]:
    """(``df`` with helper columns, for each quota whether a row is among the first of its class by (hash, id)).

    ``quotas`` give the number of rows from a class's size.  Rows without a label are a class of their own, rows without
    an id come first.  Rows that repeat an id share its hash and are taken in any order.
    """
    from leadlens.sources.tables import materialized

    counts = df.groupBy(F.col(label_col).alias("_class")).agg(F.count(F.lit(1)).alias("_cls_n"))
    known = [tuple(r) for r in counts.select(
        "_class", "_cls_n", *[q(F.col("_cls_n")).cast("long") for q in quotas]).limit(MAX_CUT_CLASSES + 1).collect()]
    if len(known) > min(MAX_CUT_CLASSES, MAX_CLASSES):
        ranked = ranked_in_class(df, id_col, label_col, seed)
        return ranked, [F.col("_rank") <= q(F.col("_cls_n")) for q in quotas]
    spread = F.coalesce(hash_fraction(id_col, seed), F.lit(-1.0))
    values = materialized(df.select(*[F.when(F.col(label_col).eqNullSafe(F.lit(c)), spread).alias(f"c{k}")
                                      for k, (c, *_) in enumerate(known)]), "split-hashes")
    # A cut is the hash of the last row within a quota; a quota of nothing or all needs none.
    wanted = {(f"c{k}", q / n): q for k, (_, n, *own) in enumerate(known) for q in own if 0 < q < n}
    cuts = _cuts(values, wanted) if wanted else {}
    hashed = df.withColumn("_hash", spread)
    split = F.lit(False)  # rows at a cut that takes some of the rows of its hash only
    for k, (c, n, *own) in enumerate(known):
        for cut, need, at in {cuts[f"c{k}", q / n] for q in own if 0 < q < n}:
            if need < at:
                split |= F.col(label_col).eqNullSafe(F.lit(c)) & (F.col("_hash") == cut)
    if any(need < at for _, need, at in cuts.values()):
        w = Window.partitionBy(label_col, "_hash").orderBy(id_col)
        hashed = (hashed.where(~split).withColumn("_place", F.lit(0))
                  .unionByName(hashed.where(split).withColumn("_place", F.row_number().over(w))))
    inside = []
    for i in range(len(quotas)):
        test = F.lit(False)
        for k, (c, n, *own) in enumerate(known):
            if own[i] <= 0:
                continue
            own_class = F.col(label_col).eqNullSafe(F.lit(c))
            if own[i] >= n:
                test |= own_class
                continue
            cut, need, at = cuts[f"c{k}", own[i] / n]
            reached = F.col("_hash") <= cut if need == at else (
                (F.col("_hash") < cut) | (F.col("_hash") == cut) & (F.col("_place") <= need))
            test |= own_class & reached
        inside.append(test)
    return hashed, inside


def _cuts(values: DataFrame, wanted: dict[tuple[str, float], int]) -> dict[tuple[str, float], tuple[float, int, int]]:
    """(hash of the last row of each wanted number, how many rows of that hash are within, how many there are)."""
    _, found = values_at_ranks(values, sorted({p for _, p in wanted}), lambda c, n, p: (
        wanted.get((c, p), min(n, max(1, round(n * p)))) - 1,) * 2)
    tests = [(c, double_sql(found[c, p][0])) for c, p in wanted]
    row = values.agg(*[F.expr(f"COUNT_IF({c} {sign} {cut})") for c, cut in tests for sign in "<="]).first()
    return {key: (found[key][0], q - row[2 * j], row[2 * j + 1]) for j, (key, q) in enumerate(wanted.items())}


def exact_test_flag(df: DataFrame, id_col: str, label_col: str, test_size: float,
                    seed: int = DEFAULT_SEED) -> DataFrame:
    """Per class, the round(n_class·test_size) rows with the smallest hash are test.

    Rows without a label are a class like any other.  No row is dropped.
    """
    marked, (test,) = in_quota(df, id_col, label_col, [lambda n: F.round(n * F.lit(test_size))], seed)
    return marked.withColumn("_is_test", test).select(*df.columns, "_is_test")


def exact_three_way_split(df: DataFrame, id_col: str, label_col: str, seed: int = DEFAULT_SEED,
                          holdout: float = 0.30, test_share_of_holdout: float = 1 / 3) -> DataFrame:
    """D2 stratified: per class round(n·holdout) rows leave training, and a third of those is the test split."""
    def out(n: Column) -> Column:
        return F.round(n * F.lit(holdout))

    marked, (test, held) = in_quota(df, id_col, label_col, [
        lambda n: F.round(out(n) * F.lit(test_share_of_holdout)), out], seed)
    return marked.withColumn("split", F.when(test, "test").when(held, "validation").otherwise("train")).select(
        *[c for c in df.columns if c != "split"], "split")
