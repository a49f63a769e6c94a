import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from leadlens.operators import ordered as O


def test_prefix_sums_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.permutation(500).astype(float), "v": rng.integers(0, 9, 500).astype(float)})
    df = spark.createDataFrame(pdf)
    out = O.prefix_sums(df, "k", ["v"], n=7).toPandas().sort_values("k")
    exp = pdf.sort_values("k")["v"].cumsum().to_numpy()
    assert np.allclose(out["v_cum"].to_numpy(), exp)
    ex = O.prefix_sums(df, "k", ["v"], inclusive=False, n=5).toPandas().sort_values("k")
    assert np.allclose(ex["v_cum"].to_numpy(), exp - pdf.sort_values("k")["v"].to_numpy())
    de = O.prefix_sums(df, "k", ["v"], descending=True, n=6).toPandas().sort_values("k", ascending=False)
    assert np.allclose(de["v_cum"].to_numpy(), pdf.sort_values("k", ascending=False)["v"].cumsum().to_numpy())


def test_row_numbers_with_ties(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "k long, id long")
    out = O.row_numbers(df, "k", tie_breakers=["id"], n=4).toPandas()
    exp = out.sort_values(["k", "id"]).reset_index(drop=True)
    assert list(exp["row"]) == list(range(1, 101))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=333)
    x[::7] = np.nan
    y = np.repeat([1.0, 2.0, 3.0], 111)  # heavy ties
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).withColumn(
        "x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    r = O.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.95], n=5).first()
    xs = x[~np.isnan(x)]
    for i, p in enumerate([0.25, 0.5, 0.95]):
        assert abs(r[f"x_q{i}"] - np.percentile(xs, p * 100)) < 1e-12
        assert abs(r[f"y_q{i}"] - np.percentile(y, p * 100)) < 1e-12


def test_fill_forward_backward(spark):
    vals = [None, None, 3.0, None, 5.0, None, None, 8.0, None]
    pdf = pd.DataFrame({"k": range(len(vals)), "v": vals})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v double")
    out = O.fill_forward_backward(df, "k", ["v"], n=3).toPandas().sort_values("k")
    exp = pdf["v"].ffill().bfill()
    assert list(out["v"]) == list(exp)


def test_range_buckets_stay_balanced_at_many_buckets(spark):
    n = 2000  # 1e-3 rank error would span two whole buckets here
    df = spark.range(400_000).select(((F.col("id") * 7919) % 400_000).alias("k"))
    sizes = [r[1] for r in O.with_range_bucket(df, "k", n).groupBy(O.BUCKET).count().collect()]
    assert len(sizes) == n
    assert max(sizes) <= 1.6 * 400_000 / n


def test_a_frequent_value_leaves_the_others_spread(spark):
    n = 64
    df = spark.range(400_000).select(F.when(F.col("id") % 100 == 0, F.col("id") / 100.0).otherwise(0.0).alias("v"))
    g = df.groupBy(F.lit(0).alias("g"), "v").count()
    d = O.with_group_bucket(g, "g", "v", O.group_bounds(g, "g", "v", 1, n))
    sizes = [r[1] for r in d.groupBy(O.BUCKET).count().collect()]
    assert len(sizes) == n and max(sizes) <= 2 * 4_000 / n


def test_fill_with_repeated_keys_reverses_the_order(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (2, 3, None)], "k long, id long, v double")
    assert [r.v for r in O.fill_forward_backward(df, "k", ["v"], n=2).collect()] == [5.0] * 3
    out = O.fill_forward_backward(df, "k", ["v"], n=2, tie_breakers=["id"]).orderBy("id").collect()
    assert [r.v for r in out] == [5.0] * 3


def test_keys_that_are_null_text_or_times(spark):
    rows = [(None, 1), ("b", 2), ("abcdefgh", 3), ("abcdefga", 4), ("é", 5), ("", 6)]
    df = spark.createDataFrame(rows, "k string, id long")
    order = [r.id for r in O.row_numbers(df, "k", n=3, tie_breakers=["id"]).orderBy("row").collect()]
    assert order == [1, 6, 4, 3, 2, 5]
    t = spark.sql("SELECT id, timestamp_seconds(1000 - id * 7) AS k, date_from_unix_date(CAST(id AS INT) % 5) AS d FROM range(30)")
    assert [r.id for r in O.row_numbers(t, "k", n=4).orderBy("row").collect()] == list(range(29, -1, -1))
    assert [r.id % 5 for r in O.row_numbers(t, "d", n=4, tie_breakers=["id"]).orderBy("row").collect()] == sorted(i % 5 for i in range(30))


def test_many_buckets_stay_small_code(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 3)
    assert O.row_numbers(df, "v", n=5000).agg(F.max("row")).first()[0] == 5000


def test_bucket_bounds_round_trip_exactly_through_sql(spark):
    vals = [0.1, 1 / 3, -2.5e17, 1e-300, 5e-324, 123456789.123456789, float("inf"), float("-inf")]
    got = spark.sql("SELECT " + ", ".join(O._double_sql(v) for v in vals)).first()
    assert list(got) == vals


def test_exact_quantiles_many_stacked_columns(spark):
    rng = np.random.default_rng(7)
    k, n = 25, 400
    data = rng.normal(size=(n, k)).round(3)
    data[rng.random((n, k)) < 0.1] = np.nan  # planted nulls
    pdf = pd.DataFrame(data, columns=[f"c{i}" for i in range(k)])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               ", ".join(f"c{i} double" for i in range(k)))
    row = O.exact_quantiles(df, list(pdf.columns), [0.1, 0.5, 0.95]).first()
    for c in pdf.columns:
        vals = pdf[c].dropna().to_numpy()
        for j, p in enumerate([0.1, 0.5, 0.95]):
            assert abs(row[f"{c}_q{j}"] - np.percentile(vals, p * 100)) < 1e-9


def test_text_keys_with_a_common_prefix_are_spread(spark):
    n = 16
    df = spark.range(20_000).select(F.format_string("customer-%012d", F.col("id") * 7919 % 20_000).alias("k"), "id")
    sizes = [r[1] for r in O.with_range_bucket(df, "k", n).groupBy(O.BUCKET).count().collect()]
    assert len(sizes) == n and max(sizes) < 3 * 20_000 / n
    rows = O.row_numbers(df, "k", n=n).orderBy("row").collect()
    assert [r.k for r in rows] == sorted(r.k for r in rows) and [r.row for r in rows] == list(range(1, 20_001))


def test_tie_breakers_split_a_hot_key(spark):
    import decimal

    n = 16
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                   (F.col("id") * 31 % 9_000).alias("id"), F.col("id").cast("decimal(30,2)").alias("d"))
    for ties in (["id"], ["d"]):
        d = O.with_range_bucket(df, "k", n, ties)
        sizes = [r[1] for r in d.groupBy(O.BUCKET).count().collect()]
        assert max(sizes) < 3 * 9_000 / n
    numbered = O.row_numbers(df, "k", n=n, tie_breakers=["id"]).orderBy("row").collect()
    assert [(r.k, r.id) for r in numbered] == sorted((r.k, r.id) for r in numbered)
    assert isinstance(O.typed_bounds(df, ["d"], 4)[0][0], decimal.Decimal)


def test_null_text_keys_and_few_rows(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("", 3), (None, 4), ("é", 5)], "k string, id long")
    got = O.row_numbers(df, "k", n=4, tie_breakers=["id"]).orderBy("row").collect()
    assert [r.id for r in got] == [1, 4, 3, 2, 5]
    assert sorted(r.row for r in O.row_numbers(df, "k", n=4).collect()) == [1, 2, 3, 4, 5]
    assert O.row_numbers(df.limit(0), "k", n=4).count() == 0


def test_fill_equals_pandas_over_many_buckets(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.permutation(400), "a": rng.normal(size=400), "b": rng.integers(0, 5, 400).astype(float)})
    pdf.loc[rng.random(400) < 0.9, "a"] = np.nan
    pdf.loc[pdf.k < 250, "b"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = O.fill_forward_backward(df, "k", ["a", "b"], n=30).toPandas().sort_values("k")
    want = pdf.sort_values("k").ffill().bfill()
    assert np.allclose(got["a"], want["a"]) and np.allclose(got["b"], want["b"])
