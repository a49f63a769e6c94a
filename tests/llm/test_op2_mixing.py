import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import op2_mixing as M
from tests.llm.helpers import AWKWARD, docs_of, prose

GOOD = [prose(i, 40 + i) + "." for i in range(60)]
BAD = [" ".join(f"{w}!!" for w in prose(500 + i, 30).upper().split()) for i in range(30)]


def labels_of(spark, n=90):
    return spark.createDataFrame([(i, "high" if i < 60 else "low") for i in range(n) if i % 2], "doc_id long, domain string")


def test_targets_are_met_and_the_fit_equals_numpy(spark):
    docs = docs_of(spark, GOOD + BAD)
    weights = {"high": 0.5, "low": 0.5}
    out = M.mixed_documents(docs, labels_of(spark), weights).toPandas().sort_values("doc_id")
    n, p = out.n_tokens.to_numpy(float), out[["p_high", "p_low"]].to_numpy()
    assert out.p_high[out.doc_id < 60].min() > 0.9 and out.p_low[out.doc_id >= 60].min() > 0.9
    mass = (n[:, None] * p).sum(0)
    target, r = n.sum() * np.array([0.5, 0.5]), np.ones(len(n))
    for _ in range(M.STEPS):
        off = ((n * r) @ p - target) / mass
        if abs(off).max() <= M.TOLERANCE:
            break
        r = np.clip(r - p @ off, 0, M.CAP)
    assert np.allclose(out.rate, r, atol=1e-5)
    assert np.allclose((n * out.rate) @ p, target, rtol=1e-3)
    assert ((out.copies - out.rate).abs() < 1).all()


def test_rates_stop_at_zero_and_reach_the_constrained_optimum(spark):
    # Both kinds of cells hold some of both domains, so a target of 1 : 0 can't be met.
    cells = spark.createDataFrame([([0.9, 0.1], 800.0), ([0.3, 0.7], 200.0)], "p array<double>, n double")
    mix = M.fitted(M.SoftMix(["a", "b"], [0, 0], []), cells, {"a": 1.0, "b": 0.0}, None)
    rates = {r.n: r.rate for r in cells.withColumn("rate", mix.rate([F.col("p")[0], F.col("p")[1]])).collect()}
    mass = np.array([780.0, 220.0])
    p, n = np.array([[0.9, 0.1], [0.3, 0.7]]), np.array([800.0, 200.0])
    loss = lambda r: ((((n * r) @ p - [1000, 0]) ** 2) / mass).sum()
    best = min(loss(np.array([a, b])) for a in np.linspace(0, 2, 401) for b in np.linspace(0, 2, 41))
    assert rates[200.0] == 0.0 and loss(np.array([rates[800.0], 0.0])) <= best + 1e-3


def test_awkward_rows_missing_labels_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, domain string")
    out = M.mixed_documents(docs_of(spark, AWKWARD), none, {"high": 0.9, "low": 0.1}).toPandas()
    assert len(out) == len(AWKWARD) and (out.p_high == 0.5).all()
    docs = docs_of(spark, [*GOOD[:5], (None, None), (1, GOOD[1])], extra=True)
    kept = M.with_rates(docs, labels_of(spark), {"high": 0.9, "low": 0.1})
    assert kept.columns == [*docs.columns, "n_tokens_", "rate_", "copies_"]
    assert kept.count() == 7 and kept.where("rate_ is null").count() == 0
    assert M.mixed_documents(docs_of(spark, []), none, {"high": 1.0}).count() == 0
    twice = labels_of(spark).unionByName(labels_of(spark)).unionByName(
        spark.createDataFrame([(None, "high"), (3, None)], "doc_id long, domain string"))
    one, two = (M.mixed_documents(docs_of(spark, GOOD + BAD), x, {"high": 0.7, "low": 0.3}).orderBy("doc_id").collect()
                for x in (labels_of(spark), twice))
    assert one == two


def test_plan_has_no_python(spark, capsys):
    M.mixed_documents(docs_of(spark, GOOD), labels_of(spark), {"high": 0.9, "low": 0.1}).explain()
    assert "Python" not in (text := capsys.readouterr().out) and "Arrow" not in text


@pytest.mark.parametrize("weights", [{"high": 1.0, "low": 0.0}, {"high": 0.2, "low": 0.8}])
def test_totals_keep_the_budget(spark, weights):
    out = M.mixed_documents(docs_of(spark, GOOD + BAD), labels_of(spark), weights, tokens=2000.0).toPandas()
    assert abs((out.n_tokens * out.rate).sum() - 2000) < 20


CELLS = "p array<double>, n double"


def test_rates_have_no_cap_unless_given_and_weak_separation_is_settled(spark, recwarn):
    small = [([1.0, 0.0], 100.0), ([0.0, 1.0], 9900.0)]
    weak = [([0.55, 0.45], 500.0), ([0.45, 0.55], 500.0)]
    for cells, weights in ((small, {"a": 0.9, "b": 0.1}), (weak, {"a": 0.54, "b": 0.46})):
        frame = spark.createDataFrame(cells, CELLS)
        mix = M.fitted(M.SoftMix(["a", "b"], [0, 0], []), frame, weights, None, must_meet=True)
        rows = frame.withColumn("rate", mix.rate([F.col("p")[0], F.col("p")[1]])).collect()
        total = sum(n for _, n in cells)
        got = [sum(r.n * r.rate * r.p[d] for r in rows) / total for d in range(2)]
        assert got == pytest.approx(list(weights.values()), abs=1e-6) and mix.unmet < 1e-6
        assert min(r.rate for r in rows) >= 0
    assert not [w for w in recwarn if "mixing targets" in str(w.message)]
    capped = M.fitted(M.SoftMix(["a", "b"], [0, 0], []), spark.createDataFrame(small, CELLS), {"a": 0.9, "b": 0.1}, None, cap=20.0)
    assert capped.unmet == pytest.approx(0.7) and capped.reached == pytest.approx([2000.0, 1000.0], rel=1e-4)


def test_unmet_targets_are_reported_or_raise(spark):
    cells = spark.createDataFrame([([0.9, 0.1], 800.0), ([0.3, 0.7], 200.0)], CELLS)
    with pytest.warns(UserWarning, match="mixing targets"):
        mix = M.fitted(M.SoftMix(["a", "b"], [0, 0], []), cells, {"a": 1.0, "b": 0.0}, None)
    assert mix.unmet > 0.05
    with pytest.raises(ValueError, match="tokens reached"):
        M.fitted(M.SoftMix(["a", "b"], [0, 0], []), cells, {"a": 1.0, "b": 0.0}, None, must_meet=True)


def test_weak_separation_gives_the_rates_nearest_to_one_and_three_domains_with_zeros_the_least_loss(spark):
    rng = np.random.default_rng(5)
    q = 0.45 + 0.1 * rng.random(200).round(3)
    p, n = np.column_stack([q, 1 - q]), rng.integers(1, 100, 200).astype(float)
    mass = n @ p
    target = n.sum() * np.array([0.503, 0.497])
    # Without zeros the nearest rates solve a system of two equations.
    want = 1 - p @ np.linalg.solve(p.T @ (n[:, None] * p), mass - target)
    frame = spark.createDataFrame([(x.tolist(), float(w)) for x, w in zip(p, n, strict=True)], CELLS)
    mix = M.fitted(M.SoftMix(["a", "b"], [0, 0], []), frame, {"a": 0.503, "b": 0.497}, None, must_meet=True)
    got = [r.rate for r in frame.select(mix.rate([F.col("p")[0], F.col("p")[1]]).alias("rate")).collect()]
    assert want.min() > 0 and np.allclose(sorted(got), sorted(want), atol=1e-5) and len(mix.steps) < 40

    p = (0.8 * rng.dirichlet([0.6, 0.6, 0.6], 12) + 0.2 / 3).round(3)  # all hold some of the third
    p /= p.sum(1, keepdims=True)
    n = rng.integers(1, 100, 12).astype(float)
    mass = n @ p
    target = n.sum() * np.array([0.9, 0.1, 0.0])
    frame = spark.createDataFrame([(x.tolist(), float(w)) for x, w in zip(p, n, strict=True)], CELLS)
    with pytest.warns(UserWarning, match="mixing targets"):
        mix = M.fitted(M.SoftMix(["a", "b", "c"], [0] * 3, []), frame, {"a": 0.9, "b": 0.1, "c": 0.0}, None)
    got = np.array([r.rate for r in frame.select(mix.rate([F.col("p")[d] for d in range(3)]).alias("rate")).collect()])
    assert got.min() == 0 and np.allclose((n * got) @ p, mix.reached)
    # Numbers with p @ bound >= 0 for every document bound the least loss from below (the dual problem).
    miss = (np.array(mix.reached) - target) / mass
    bound = miss + max(0.0, -(p @ miss).min())
    loss = 0.5 * (mass * miss * miss).sum()
    assert loss + 0.5 * (mass * bound * bound).sum() + bound @ target <= 1e-6 * loss


def test_steps_over_stored_rates_give_the_same_fit(spark, monkeypatch):
    cells = spark.createDataFrame([([0.55, 0.45, 0.0], 500.0), ([0.4, 0.5, 0.1], 500.0), ([0.1, 0.2, 0.7], 40.0)], CELLS)
    fits = []
    for stored in (1, 16):
        monkeypatch.setattr(M, "STORED", stored)
        fits.append(M.fitted(M.SoftMix(["a", "b", "c"], [0] * 3, []), cells, {"a": 0.48, "b": 0.45, "c": 0.07}, None))
    assert np.allclose(fits[0].reached, fits[1].reached) and fits[0].unmet < 1e-6 > fits[1].unmet


def test_posteriors_equal_a_count_in_python(spark):
    docs = docs_of(spark, GOOD + BAD)
    labels = labels_of(spark)
    mix, soft = M.soft_mix(docs, labels, {"high": 0.5, "low": 0.5})
    bins = {r.doc_id: r.bins for r in docs.select("doc_id", *M.featured(docs, "text")).select(
        "doc_id", F.array(*M.bins()).alias("bins")).collect()}
    domain = {r.doc_id: r.domain for r in labels.collect()}
    for r in soft.collect():
        odds = []
        for d in ("high", "low"):
            own = [bins[i] for i, x in domain.items() if x == d]
            odds.append((len(own) + 1) / (len(domain) + 2) * np.prod(
                [(sum(b[f] == x for b in own) + 1) / (len(own) + M.BINS) for f, x in enumerate(bins[r.doc_id])]))
        assert r.p == pytest.approx([x / sum(odds) for x in odds], abs=6e-4)


def test_the_drawn_mixture_has_the_target_shares(spark):
    docs = docs_of(spark, [*GOOD, *BAD, (None, None)], extra=True)
    planned = M.with_rates(docs, labels_of(spark), {"high": 0.5, "low": 0.5})
    mixture = M.drawn(planned, "copies_")
    assert mixture.columns == planned.columns
    want = {r.doc_id: r.copies_ for r in planned.collect() if r.copies_}
    assert {r.doc_id: r["count"] for r in mixture.groupBy("doc_id").count().collect()} == want
    low = F.sum(F.when(F.col("doc_id") >= 60, F.col("n_tokens_")).otherwise(0)) / F.sum("n_tokens_")
    assert abs(mixture.select(low).first()[0] - 0.5) < 0.1
    assert M.drawn(planned.limit(0), "copies_").count() == 0
