"""Exact order statistics by narrowing.

Wanted are the values at given ranks of given columns.  Nothing is sorted and
no column is shuffled:

1. a quantile sketch of all columns (``approxQuantile``, one pass) gives a
   bracket around each wanted rank; its error is bounded, so that the bracket
   holds a few thousandths of the rows;
2. one aggregate counts the rows below and inside each bracket, which says
   exactly which ranks the bracket holds;
3. only the values inside the brackets are moved: counted per value in each
   task, then per value, and cumulated per bracket.

A bracket with more than ``LAST_ROWS`` rows is narrowed again by a sketch of
its own rows.  A bracket of one single value (a frequent one) is its own
answer and moves nothing.  Nulls and NaN are no values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of a sketch, as a share of the rows; a bracket spans some six times this.
ERROR = 1e-3
#: Rows of one bracket that are cumulated in one task at most (unless they are all a few values).
LAST_ROWS = 1_000_000


def double_sql(x: float) -> str:
    """A DOUBLE literal that parses back to exactly ``x``."""
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
    return f"{x!r}D"


@dataclass
class Bracket:
    """The ranks ``first`` and ``second`` (from 0) of a column lie among its values from ``low`` to ``high``."""

    column: str
    share: float
    first: int = 0
    second: int = 0
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0

    @property
    def holds(self) -> bool:
        return self.below <= self.first and self.second < self.below + self.inside

    @property
    def test(self) -> str:
        return f"{self.column} >= {double_sql(self.low)} AND {self.column} <= {double_sql(self.high)}"


def _count(values: DataFrame, brackets: Sequence[Bracket], totals: Sequence[str] = ()) -> dict[str, int]:
    """Sets ``below`` and ``inside`` of all brackets in one aggregate; returns the number of values of ``totals``."""
    aggs = [F.expr(f"COUNT({c})").alias(f"n_{c}") for c in totals]
    for i, b in enumerate(brackets):
        aggs += [F.expr(f"COUNT_IF({b.column} < {double_sql(b.low)})").alias(f"below_{i}"),
                 F.expr(f"COUNT_IF({b.test})").alias(f"inside_{i}")]
    row = values.agg(*aggs).first()
    for i, b in enumerate(brackets):
        b.below, b.inside = row[f"below_{i}"], row[f"inside_{i}"]
    return {c: row[f"n_{c}"] for c in totals}


def _narrowed(values: DataFrame, brackets: Sequence[Bracket]) -> bool:
    """One more round for ``brackets``: a sketch of the rows inside each, then the counts; False if that changed nothing."""
    inner = values.selectExpr(*[f"CASE WHEN {b.test} THEN {b.column} END AS b{i}" for i, b in enumerate(brackets)])
    spans = [((b.first - b.below) / b.inside - 2 * ERROR, (b.second + 1 - b.below) / b.inside + 2 * ERROR) for b in brackets]
    wanted = sorted({min(max(p, 0.0), 1.0) for s in spans for p in s})
    found = inner.approxQuantile(inner.columns, wanted, ERROR)
    tried = []
    for b, at, (p, q) in zip(brackets, found, spans, strict=True):
        at = dict(zip(wanted, at, strict=True))
        tried.append(Bracket(b.column, b.share, b.first, b.second, at[min(max(p, 0.0), 1.0)], at[min(max(q, 0.0), 1.0)]))
    _count(values, tried)
    moved = False
    for b, t in zip(brackets, tried, strict=True):
        if t.holds and t.inside < b.inside:
            b.low, b.high, b.below, b.inside, moved = t.low, t.high, t.below, t.inside, True
    return moved


def values_at_ranks(values: DataFrame, shares: Sequence[float], ranks: Callable[[str, int, float], tuple[int, int]],
                    most: int | None = None) -> tuple[dict[str, int], dict[tuple[str, float], tuple[float, float]]]:
    """(number of values of each column, the two values at ``ranks(column, n, share)`` for each column and share).

    ``values`` holds double columns; it is read three times, so it should be a stored table or a plain scan.  ``ranks``
    gives two ranks from 0 (the second the same or the next one) near ``share`` of the ``n`` values.  A column without a
    value has no entry.
    """
    columns, limit = values.columns, LAST_ROWS if most is None else most
    clean = values.selectExpr(*[f"CASE WHEN NOT isnan(`{c}`) THEN `{c}` END AS v{i}" for i, c in enumerate(columns)])
    names = clean.columns
    near = sorted({min(max(p + d, 0.0), 1.0) for p in shares for d in (-2 * ERROR, 2 * ERROR)})
    sketch = clean.approxQuantile(names, near, ERROR)
    brackets = []
    for c, at in zip(names, sketch, strict=True):
        at = dict(zip(near, at, strict=True)) if at else {}
        brackets += [Bracket(c, p, low=at[min(max(p - 2 * ERROR, 0.0), 1.0)], high=at[min(max(p + 2 * ERROR, 0.0), 1.0)])
                     for p in shares if at]
    n = _count(clean, brackets, names)
    for b in brackets:
        b.first, b.second = ranks(columns[names.index(b.column)], n[b.column], b.share)
        if not b.holds:  # a few rows only, or ranks further from the share: start from all
            b.low, b.high, b.below, b.inside = -math.inf, math.inf, 0, n[b.column]
    while wide := [b for b in brackets if b.inside > limit and b.low < b.high]:
        if not _narrowed(clean, wide):
            break
    found = {id(b): (b.low, b.low) for b in brackets if b.low == b.high}
    found |= _cumulated(clean, [b for b in brackets if b.low < b.high])
    return ({columns[i]: n[c] for i, c in enumerate(names)},
            {(columns[names.index(b.column)], b.share): found[id(b)] for b in brackets})


def _cumulated(values: DataFrame, brackets: Sequence[Bracket]) -> dict[int, tuple[float, float]]:
    """The values at each bracket's two ranks, from the rows inside the brackets alone."""
    if not brackets:
        return {}
    inside = ", ".join(f"{i}, CASE WHEN {b.test} THEN {b.column} END" for i, b in enumerate(brackets))
    counts = (values.selectExpr(f"stack({len(brackets)}, {inside}) AS (_b, _v)").where("_v IS NOT NULL")
              .groupBy("_b", "_v").agg(F.count(F.lit(1)).alias("_n")))
    upto = F.sum("_n").over(Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    picks = " OR ".join(f"(_b = {i} AND _to > {r - b.below} AND _to - _n <= {r - b.below})"
                        for i, b in enumerate(brackets) for r in (b.first, b.second))
    # At most two rows a bracket.
    rows = counts.withColumn("_to", upto).where(picks).collect()
    out = {}
    for i, b in enumerate(brackets):
        own = [(r["_to"] - r["_n"] + b.below, r["_to"] + b.below, r["_v"]) for r in rows if r["_b"] == i]
        out[id(b)] = tuple(next(v for s, e, v in own if s <= r < e) for r in (b.first, b.second))
    return out
