"""Mixing to target weights by soft membership.

1. *Classifier.*  Surface features of every document are counted and binned.
   A labelled table (id, domain) gives, for each domain, feature and bin, the
   smoothed share of its documents; a naive Bayes sum over the features gives
   each document's posterior over the domains, to three decimals.
2. *Fit.*  Document i has tokens n_i, posteriors p_id and a rate r_i >= 0.
   The expected tokens of domain d are m_d = sum_i r_i n_i p_id.  The rates
   minimise the least squares

       1/2 sum_d (m_d - T_d)^2 / M_d

   over r >= 0 (T_d are the targets, M_d the domain's tokens at rate 1) by
   projected gradient from rate 1.  Measured by tokens, the gradient at
   document i is sum_d p_id (m_d - T_d) / M_d, and its Lipschitz constant is
   at most 1, so a step

       r_i = max(0, r_i - a sum_d p_id (m_d - T_d) / M_d)

   of length a = 1 always goes down.  Longer ones (Barzilai and Borwein's
   length, from the last step) are taken as long as the loss falls below the
   largest of the last ten; so weakly separated posteriors take few steps too.
   A document's rate depends on its posteriors alone: documents are summed up
   by their posteriors once, and each step is one aggregate over that table of
   cells, which brings m_d and the length of the step to the driver.  For two
   domains the grid of posteriors bounds it by 1,001 cells, for more domains
   it is as large as their distinct posteriors, and stays a table.  The fit
   ends where all targets are met to TOLERANCE of the domain's tokens, or,
   where no rates meet them, where a step of length 1 moves the rates by less
   than TOLERANCE (root mean square by tokens).  As long as no rate comes to 0, the
   rates that meet the targets are those nearest to 1; else they are those
   that the steps lead to.  There is no upper bound of a rate unless the caller
   gives a ``cap``, onto which the steps then project.  Far-off targets of three or
   more domains that no rates meet can take over STEPS steps; the fit then
   ends with a warning, and the miss is reported as below.
3. *Rates.*  The steps, a few numbers each, give any document its rate by one
   fold over them, without a join.  ``copies`` rounds the rate up or down by a
   hash of the id; ``drawn`` repeats rows by it.

Where the optimum misses a target by more than UNMET of the token budget, a
warning names the tokens reached, or an error is raised if the caller asks so;
``unmet`` is the largest miss as a share of the budget.

A domain that no document can belong to is left out of the fit.  Without any
labelled row all posteriors are equal.  A null or empty text has no tokens,
and a rate like others of its posteriors.  Null ids are allowed.  Labelled ids
that repeat count once, with their largest domain; repeated documents count each.
An empty table gives an empty result.  Added columns that exist already get an underscore.

The main path is DataFrame functions only.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import materialized, removed

BINS = 24
#: Pseudo-count of each bin.
SMOOTH = 1.0
DECIMALS = 3
#: Steps at most (a warning beyond), exactness at the end, and upper bound of the rates (none).
STEPS, TOLERANCE, CAP = 500, 1e-8, None
UNMET = 1e-3
#: A longer step has to fall below the largest of so many losses, and the cells' rates are stored each so many steps.
LOSSES, STORED = 10, 16


def counted(text: Column) -> dict[str, Column]:
    """Raw counts from which the features are made."""
    return {
        "n_chars": F.length(text),
        "n_tokens": F.regexp_count(text, F.lit(r"\S+")).cast("long"),
        "n_marks": F.regexp_count(text, F.lit(r"[#$%&*+/<=>@\\^_|~]")),
        "n_loud": F.regexp_count(text, F.lit(r"!|[A-Z]{2,}")),
        "n_digits": F.regexp_count(text, F.lit(r"[0-9]+")),
        "n_lines": F.regexp_count(text, F.lit(r"\n")),
        "n_ends": F.regexp_count(text, F.lit(r"[.?,;:]")),
        "n_distinct": F.size(F.array_distinct(F.split(text, " "))),
    }


def bins() -> list[Column]:
    """Bin of each feature, 0 to BINS - 1."""
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))

    def rate(name):  # logarithmic in the count per thousand tokens
        return F.floor(2 * F.log2(1 + 1000.0 * F.col(name) / tokens))

    raw = [F.floor(1.5 * F.log2(1.0 + F.col("n_tokens"))), F.floor(2.0 * F.col("n_chars") / tokens),
           *[rate(n) for n in ("n_marks", "n_loud", "n_digits", "n_lines", "n_ends")],
           F.floor((BINS - 1.0) * F.col("n_distinct") / tokens)]
    return [F.least(F.greatest(b, F.lit(0)), F.lit(BINS - 1)).cast("int") for b in raw]


def featured(docs: DataFrame, text_col: str) -> list[Column]:
    return [c.alias(n) for n, c in counted(F.coalesce(F.col(text_col), F.lit(""))).items()]


class SoftMix:
    """What has been fitted: domains, log shares by feature and bin, the steps of the rates."""

    def __init__(self, domains: list[str], prior: list[float], shares: list[list[list[float]]]):
        self.domains, self.prior, self.shares = domains, prior, shares
        self.steps: list[list[float]] = []
        self.cap: float | None = None
        self.reached: list[float] = []
        self.unmet = 0.0

    def posteriors(self, binned: list[Column]) -> list[Column]:
        """Posterior of each domain but the last, to DECIMALS places; the last one is the rest."""
        logits = []
        for d, prior in enumerate(self.prior):
            total = F.lit(prior)
            for f, b in enumerate(binned):
                total = total + F.element_at(F.array(*[F.lit(x) for x in self.shares[f][d]]), b + 1)
            logits.append(total)
        if len(logits) == 1:
            return []
        top = F.greatest(*logits)
        weights = [F.exp(x - top) for x in logits]
        whole = sum(weights[1:], weights[0])
        return [F.round(w / whole, DECIMALS) for w in weights[:-1]]

    def rate(self, p: list[Column], start: Column | None = None, steps: list[list[float]] | None = None) -> Column:
        """The rate from the posteriors of all domains: all steps from rate 1, or ``steps`` from ``start``."""
        def inside(rate):
            rate = F.greatest(F.lit(0.0), rate)
            return rate if self.cap is None else F.least(F.lit(float(self.cap)), rate)

        def moved(rate, step):
            for d, x in enumerate(p):
                rate = rate - x * step[d]
            return inside(rate)

        steps = self.steps if steps is None else steps
        start = inside(F.lit(1.0)) if start is None else start
        return F.aggregate(F.lit(steps), start, moved) if steps else start


def learned(binned: DataFrame, labels: DataFrame, domains: list[str]) -> SoftMix:
    """The classifier, from ``binned(doc_id, bins)`` and ``labels(doc_id, domain)``."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy(
        F.col("doc_id").alias("label_id")).agg(F.max("domain").alias("domain"))
    rows = binned.join(own, F.col("doc_id") == F.col("label_id")).select("domain", F.posexplode("bins").alias("f", "b"))
    # At most domains x features x bins rows.
    table = rows.groupBy("domain", "f", "b").agg(F.count(F.lit(1)).alias("n")).collect()
    count = {(r["domain"], r["f"], r["b"]): r["n"] for r in table}
    per = {d: sum(n for (x, f, _), n in count.items() if x == d and f == 0) for d in domains}
    whole = sum(per.values()) + len(domains)
    shares = [[[math.log((count.get((d, f, b), 0) + SMOOTH) / (per[d] + SMOOTH * BINS)) for b in range(BINS)]
               for d in domains] for f in range(len(bins()))]
    return SoftMix(domains, [math.log((per[d] + 1) / whole) for d in domains], shares)


def fitted(mix: SoftMix, cells: DataFrame, weights: dict[str, float], tokens: float | None, cap: float | None = CAP,
           must_meet: bool = False) -> SoftMix:
    """Projected gradient over ``cells(p, n)``: posteriors and the tokens of the documents that have them."""
    mix.cap, mix.steps = cap, []
    p, n = [F.col("p")[d] for d in range(len(mix.domains))], F.col("n")
    base, pending = cells.select("p", "n", mix.rate(p).alias("rate")), []

    def sums(step: list[float] | None) -> tuple[list[float], float]:
        """Expected tokens by domain after the step, and the step's squared length by tokens."""
        old = base.select("p", "n", mix.rate(p, F.col("rate"), pending).alias("before"))
        rows = old.select("*", mix.rate(p, F.col("before"), [step] if step else []).alias("after"))
        far = F.col("after") - F.col("before")
        found = rows.agg(*[F.sum(n * F.col("after") * x) for x in p], F.sum(n * far * far)).first()
        found = [float(x or 0.0) for x in found]
        return found[:-1], found[-1]

    mass = [float(x or 0.0) for x in cells.agg(*[F.sum(n * x) for x in p]).first()]
    budget = sum(mass) if tokens is None else float(tokens)
    whole = sum(weights[d] for d, m in zip(mix.domains, mass, strict=True) if m > 0) or 1.0
    target = [budget * weights[d] / whole for d in mix.domains]

    def misses(now: list[float]) -> list[float]:
        return [(x - t) / m if m > 0 else 0.0 for x, t, m in zip(now, target, mass, strict=True)]

    def loss(miss: list[float]) -> float:
        return 0.5 * sum(m * e * e for m, e in zip(mass, miss, strict=True))

    (now, _), length, stored = sums(None), 1.0, None
    miss = misses(now)
    losses = [loss(miss)]
    exact = [TOLERANCE * max(1.0, t / m) if m > 0 else 1.0 for t, m in zip(target, mass, strict=True)]
    settled = False
    while not settled and any(abs(e) > x for e, x in zip(miss, exact, strict=True)):
        if len(mix.steps) == STEPS:
            warnings.warn(f"The mixing rates have not settled in {STEPS} steps", stacklevel=2)
            break
        while True:
            step = [length * e for e in miss]
            after, far = sums(step)
            if length == 1.0 or loss(misses(after)) <= max(losses[-LOSSES:]) - 1e-4 * far / length:
                break
            length = max(1.0, length / 4)
        # A longer step moves no less than one of length 1 would.
        settled = far <= TOLERANCE ** 2 * sum(mass)
        bend = sum((x - y) ** 2 / m for x, y, m in zip(after, now, mass, strict=True) if m > 0)
        length = min(max(far / bend, 1.0), 1e12) if bend > 0 else 1.0
        now, miss = after, misses(after)
        losses.append(loss(miss))
        mix.steps.append(step)
        pending.append(step)
        if len(pending) == STORED:
            old, stored = stored, materialized(base.select("p", "n", mix.rate(p, F.col("rate"), pending).alias("rate")), "mix-rates")
            base, pending = stored, []
            if old is not None:
                removed(old)
    if stored is not None:
        removed(stored)
    mix.reached = now
    mix.unmet = max((abs(x - t) for x, t, m in zip(now, target, mass, strict=True) if m > 0), default=0.0) / budget if budget > 0 else 0.0
    if mix.unmet > UNMET:
        said = ", ".join(f"{d}: {r:.0f} of {t:.0f}" for d, r, t in zip(mix.domains, now, target, strict=True))
        if must_meet:
            raise ValueError(f"No rates meet the mixing targets; tokens reached {said}")
        warnings.warn(f"No rates meet the mixing targets; tokens reached {said}", stacklevel=2)
    return mix


def soft_mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], tokens: float | None = None,
             id_col: str = "doc_id", text_col: str = "text", cap: float | None = CAP,
             must_meet: bool = False) -> tuple[SoftMix, DataFrame]:
    """Learn and fit; returns the fit and the stored (doc_id, n_tokens, p) of every document."""
    domains = sorted(weights)
    counts = docs.select(F.col(id_col).alias("doc_id"), *featured(docs, text_col))
    binned = materialized(counts.select("doc_id", "n_tokens", F.array(*bins()).alias("bins")), "mix-bins")
    mix = learned(binned, labels, domains)
    first = mix.posteriors([F.col("bins")[f] for f in range(len(bins()))])
    last = F.round(F.greatest(F.lit(1.0) - sum(first, F.lit(0.0)), F.lit(0.0)), DECIMALS)
    soft = materialized(binned.select("doc_id", "n_tokens", F.array(*first, last).alias("p")), "mix-posteriors")
    cells = materialized(soft.groupBy("p").agg(F.sum("n_tokens").cast("double").alias("n")), "mix-cells")
    return fitted(mix, cells, weights, tokens, cap, must_meet), soft


def decided(mix: SoftMix, rows: DataFrame, id_col: str = "doc_id") -> dict[str, Column]:
    """Rate and copies of rows that have ``p``."""
    rate = mix.rate([F.col("p")[d] for d in range(len(mix.domains))])
    chance = F.pmod(F.xxhash64(F.lit("mix"), F.col(id_col)), F.lit(1_000_000)) / 1e6
    return {"rate": F.round(rate, 6), "copies": (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("long")}


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float], tokens: float | None = None,
                    id_col: str = "doc_id", text_col: str = "text", cap: float | None = CAP,
                    must_meet: bool = False) -> DataFrame:
    """doc_id, n_tokens, one p_<domain> each, rate, copies, unmet (the same in all rows)."""
    mix, soft = soft_mix(docs, labels, weights, tokens, id_col, text_col, cap, must_meet)
    new = decided(mix, soft)
    out = soft.withColumn("rate", new["rate"]).withColumn("copies", new["copies"])
    return out.select("doc_id", "n_tokens", *[F.col("p")[d].alias(f"p_{name}") for d, name in enumerate(mix.domains)],
                      "rate", "copies", F.lit(mix.unmet).alias("unmet"))


def with_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float], tokens: float | None = None,
               id_col: str = "doc_id", text_col: str = "text", cap: float | None = CAP,
               must_meet: bool = False) -> DataFrame:
    """The rows of ``docs`` with all their columns, n_tokens, rate and copies; texts don't move."""
    mix, _ = soft_mix(docs, labels, weights, tokens, id_col, text_col, cap, must_meet)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("doc_id"),
                      *featured(docs, text_col))
    binned = row.select("row", "doc_id", "n_tokens", F.array(*bins()).alias("bins"))
    first = mix.posteriors([F.col("bins")[f] for f in range(len(bins()))])
    last = F.round(F.greatest(F.lit(1.0) - sum(first, F.lit(0.0)), F.lit(0.0)), DECIMALS)
    soft = binned.select("row", "doc_id", "n_tokens", F.array(*first, last).alias("p"))
    new = decided(mix, soft)
    out = soft.withColumn("rate", new["rate"]).withColumn("copies", new["copies"])
    names = {}
    for c in ("n_tokens", "rate", "copies"):
        names[c] = c
        while names[c].lower() in [x.lower() for x in docs.columns]:
            names[c] += "_"
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns], *[F.col(c).alias(n) for c, n in names.items()])


def drawn(rows: DataFrame, copies_col: str = "copies") -> DataFrame:
    """The mixture itself: each row of ``with_rates`` as often as its copies say, without those that have none."""
    # A struct holds the row, so that no column name can clash.
    times = F.explode(F.sequence(F.lit(1), F.col(copies_col).cast("int")))
    return rows.where(F.col(copies_col) > 0).select(F.struct("*").alias("row"), times.alias("time")).select("row.*")
