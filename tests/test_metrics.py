import itertools

import numpy as np
import pandas as pd

from leadlens.operators import leaderboard as R
from leadlens.operators import metrics as E


def brute_auc(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def brute_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec, rec = tp / sel.sum(), tp / (y == 1).sum()
        ap += (rec - prev_r) * prec
        prev_r = rec
    return ap


def test_auc_and_ap_with_ties(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) + 0.3 * y, 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    auc = E.roc_auc(df, "y", "s").first()[0]
    ap = E.average_precision(df, "y", "s").first()[0]
    assert abs(auc - brute_auc(y, s)) < 1e-12
    assert abs(ap - brute_ap(y, s)) < 1e-12


def test_ap_small_case(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert round(E.average_precision(df, "y", "s").first()[0], 4) == 0.8333


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.4)], "y int, s double")
    assert E.roc_auc(df, "y", "s").first()[0] is None


def test_classification_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = E.classification_metrics(df, "y", "p").first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.0, 0.0, 0.0)


def test_confusion_and_thresholds(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "y int, p int")
    cm = {(r.label, r.prediction): r.n for r in E.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(1, 1): 2, (0, 1): 1, (0, 0): 1}
    m = spark.createDataFrame([(0.79, 0.9)], "roc_auc double, f1 double")
    chk = {r.metric: r.passed for r in E.threshold_check(spark, m).collect()}
    assert chk == {"roc_auc": False, "f1": True}


RUNS = "tier string, run_id string, seq int, metrics map<string,double>"


def test_leaderboard_cases(spark):
    runs = spark.createDataFrame([("baseline", "a", 0, {"roc_auc": .72}), ("challenger", "b", 1, {"roc_auc": .81}),
                                  ("champion", "c", 2, {"roc_auc": .85})], RUNS)
    assert R.winner(runs).first().tier == "champion"
    runs2 = spark.createDataFrame([("baseline", "a", 0, {"roc_auc": .72}), ("challenger", "b", 1, {"roc_auc": .91}),
                                   ("champion", "c", 2, {"roc_auc": .85})], RUNS)
    assert R.winner(runs2).first().tier == "challenger"
    ties = spark.createDataFrame([("x", "a", 0, {}), ("y", "b", 1, {"roc_auc": 0.0})], RUNS)
    assert R.winner(ties).first().tier == "x"
    import pytest
    with pytest.raises(ValueError):
        R.rank_runs(spark.createDataFrame([], RUNS))


def test_promotion_gate(spark):
    ch = spark.createDataFrame([("c", "new", 0, {"roc_auc": .83})], RUNS)
    champ = spark.createDataFrame([("c", "old", 0, {"roc_auc": .80})], RUNS)
    assert R.promotion_gate(ch, champ).first().promote is True
    ch2 = spark.createDataFrame([("c", "new", 0, {"roc_auc": .79})], RUNS)
    assert R.promotion_gate(ch2, champ).first().promote is False
    none = spark.createDataFrame([], RUNS)
    assert R.promotion_gate(ch2, none).first().promote is True
