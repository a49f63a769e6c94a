import pytest

from leadlens.plans import feature_build as FB
from leadlens.sources import tables as S
from leadlens.sources import testviews as TV
from tests.conftest import SF_SMALL

NAMES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes",
         "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def settings(spark):
    return [spark.conf.get(n, None) for n in NAMES]


def test_the_feature_table_is_built_in_tasks_of_bounded_bytes(spark, monkeypatch):
    size, before, seen = FB.input_size(TV.crm_tables(spark, SF_SMALL)), settings(spark), []
    assert size > 0
    monkeypatch.setattr(S, "PARTITION_BYTES", size // 40)
    monkeypatch.setattr(S, "stored", lambda session, name, build: seen.append(settings(session)))
    FB.stored_feature_table(spark, SF_SMALL)
    (shuffled, scanned, parts), = seen
    assert int(shuffled) <= S.TASK_BYTES and int(scanned) <= S.SCAN_BYTES and int(parts) >= 40
    assert settings(spark) == before


def test_finer_settings_stay_and_come_back_after_an_error(spark):
    given = ["1m", "2m", "300"]
    before = settings(spark)
    try:
        for n, v in zip(NAMES, given, strict=True):
            spark.conf.set(n, v)
        with pytest.raises(RuntimeError), S.tasks_by_bytes(spark, 1 << 20):
            assert settings(spark) == [str(1 << 20), str(2 << 20), "300"]
            raise RuntimeError
        assert settings(spark) == given
    finally:
        for n, v in zip(NAMES, before, strict=True):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
