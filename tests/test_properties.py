"""Property-based checks of the ordered helpers and metrics against numpy."""
import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leadlens.operators import metrics as E
from leadlens.operators import ordered as O

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float),
                            st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=60)


@SETTINGS
@given(vals=values, p=st.sampled_from([0.0, 0.25, 0.5, 0.95, 1.0]), n=st.integers(2, 6))
def test_exact_quantile_matches_numpy(spark, vals, p, n):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = O.exact_quantiles(df, ["x"], [p], n=n).first()[0]
    xs = np.array([v for v in vals if v is not None])
    if len(xs) == 0:
        assert got is None
    else:
        assert abs(got - np.percentile(xs, p * 100)) <= 1e-9 * max(1.0, abs(got))


@SETTINGS
@given(ys=st.lists(st.integers(0, 1), min_size=2, max_size=50),
       seed=st.integers(0, 10_000), n=st.integers(2, 5))
def test_auc_matches_rank_formula(spark, ys, seed, n):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, 5, len(ys)).astype(float)  # heavy ties
    df = spark.createDataFrame(pd.DataFrame({"y": ys, "s": s}))
    got = E.roc_auc(df, "y", "s").first()[0]
    y = np.array(ys)
    P, N = (y == 1).sum(), (y == 0).sum()
    if P == 0 or N == 0:
        assert got is None
        return
    ranks = pd.Series(s).rank(method="average").to_numpy()
    expected = (ranks[y == 1].sum() - P * (P + 1) / 2) / (P * N)
    assert abs(got - expected) < 1e-12


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=40),
       n=st.integers(2, 5))
def test_ffill_bfill_matches_pandas(spark, vals, n):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v long")
    got = [r.v for r in O.fill_forward_backward(df, "k", ["v"], n=n).orderBy("k").collect()]
    exp = pd.Series(vals, dtype="float").ffill().bfill()
    assert [None if pd.isna(e) else int(e) for e in exp] == got
