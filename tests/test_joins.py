"""Size-checked broadcasts: a side is broadcast only within its bounds of bytes and rows."""
from pyspark.sql import functions as F

from leadlens.operators.joins import bounded_broadcast, bounded_lookup, bytes_in_memory, fits_broadcast
from leadlens.session import checkpoint_dir


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_the_row_limit(spark):
    big = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    side = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint may broadcast
    try:
        small = big.join(bounded_broadcast(side, max_rows=100), "k", "left")
        over = big.join(bounded_broadcast(side, max_rows=5), "k", "left")
        assert "BroadcastHashJoin" in _plan(small)
        assert "BroadcastHashJoin" not in _plan(over)
        assert small.where(F.col("name").isNotNull()).count() == over.where(F.col("name").isNotNull()).count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_materialized_side_is_stored_under_the_checkpoint_folder(spark):
    side = spark.range(20).groupBy((F.col("id") % 4).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = bounded_broadcast(side, max_rows=100, materialize=True)
    files = out.inputFiles()
    assert files and all(checkpoint_dir(spark).rstrip("/") in f for f in files)
    assert sorted(r.n for r in out.collect()) == [5, 5, 5, 5]


def _without_automatic_hints(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_a_wide_lookup_is_not_hinted_and_a_narrow_one_of_as_many_rows_is(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    _without_automatic_hints(spark)
    try:
        narrow = spark.range(400_000).select(F.col("id").alias("k"), (F.col("id") % 9).alias("v"))
        # One repeated text: a few bytes a row in a file, 300 in memory.
        wide = narrow.withColumn("name", F.lit("x" * 300))
        leads = spark.range(100).select("id", F.col("id").alias("key"))
        assert bytes_in_memory(wide)[1] > 100e6 > 64e6 > bytes_in_memory(narrow)[1]
        assert "BroadcastHashJoin" in _plan(bounded_lookup(leads, narrow, "key", "k", "id"))
        assert "BroadcastHashJoin" not in _plan(bounded_lookup(leads, wide, "key", "k", "id"))
        assert fits_broadcast(wide.limit(1000)) and not fits_broadcast(wide.limit(1000), max_rows=999)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_null_keys_of_a_shuffled_lookup_spread_over_the_tasks(spark):
    prev = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    _without_automatic_hints(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        leads = spark.range(24_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("int")).alias("key"))
        side = spark.range(-5, 24_000).select("id", F.lit("s").alias("name")).union(
            spark.sql("SELECT CAST(NULL AS BIGINT), 'null key'")).toDF("k", "name")
        out = bounded_lookup(leads, side, "key", "k", "id", max_bytes=0)
        rows = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert max(r["count"] for r in rows) < 2 * 24_000 / 8
        assert out.columns == ["id", "key", "name"] and out.count() == 24_000
        assert out.where("key IS NULL AND name IS NOT NULL OR key IS NOT NULL AND name <> 's'").count() == 0
        assert out.where("name IS NOT NULL").count() == 16_000
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_odd_keys_of_a_shuffled_lookup_match_as_a_plain_comparison_does(spark):
    left = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, float("nan")), (4, None), (5, 12.0)], "id long, key double")
    side = spark.createDataFrame([(0, "zero"), (12, "twelve"), (None, "null")], "k long, name string")
    plain = {(r.id, r.name) for r in bounded_lookup(left, side, "key", "k", "id", fits=True).select("id", "name").collect()}
    assert {(r.id, r.name) for r in bounded_lookup(left, side, "key", "k", "id", fits=False).select("id", "name").collect()} == plain
    assert plain == {(1, "zero"), (2, "zero"), (3, None), (4, None), (5, "twelve")}
    assert bounded_lookup(left.limit(0), side, "key", "k", "id").count() == 0
    assert bounded_lookup(left, side.limit(0), "key", "k", "id").count() == 5
