import __spark_entry__ as entry
from leadlens.operators.features import FEATURE_COLUMNS
from leadlens.plans import registry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert tuple(df.columns) == FEATURE_COLUMNS
    assert df.count() > 0


def test_registry_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40
    # Names op1_ ... op10_ belong to the corpus subpackage alone.
    assert all(not k.startswith("op") for k in registry.queries())


def test_sample_queries_run_small(spark):
    from tests.conftest import SF_SMALL
    q = entry.queries()
    for name in ("a4_channel_cvr", "v6_range_violations", "e4_confusion_matrix"):
        assert q[name](spark, SF_SMALL).count() > 0
