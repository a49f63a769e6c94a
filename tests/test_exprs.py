import datetime as dt

from pyspark.sql import functions as F

from leadlens.functions import exprs as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_flag_whitespace_and_null(spark):
    vals = one(spark, X.flag("s"), [(None,), ("",), ("\t",), (" \n ",), ("x",), (" y ",)], "s string")
    assert vals == [0, 0, 0, 0, 1, 1]


def test_changed_is_null_safe(spark):
    data = [(None, 1), (1, None), (1, 1), (1, 2), (None, None)]
    vals = one(spark, X.changed("p", "c"), data, "p int, c int")
    assert vals == [0, 1, 0, 1, 0]


def test_clip_keeps_null(spark):
    vals = one(spark, X.clip("x", 0, 1), [(None,), (-3.0,), (0.5,), (7.0,)], "x double")
    assert vals == [None, 0.0, 0.5, 1.0]


def test_guarded_ratio_half_even(spark):
    vals = one(spark, X.guarded_ratio("n", "d"), [(1.0, 16.0), (3.0, 0.0), (None, 2.0), (2.0, None)],
               "n double, d double")
    assert vals == [0.062, 0.0, None, 0.0]


def test_calendar_parts(spark):
    ts = dt.datetime(2024, 1, 1, 9, 30)  # a Monday
    df = spark.createDataFrame([(ts,), (None,)], "t timestamp")
    r = df.select(X.day_of_week("t"), X.is_weekend("t"), X.is_business_hours("t"),
                  X.days_since("t", dt.date(2024, 1, 11))).collect()
    assert tuple(r[0]) == (0, 0, 1, 10)
    assert tuple(r[1]) == (None, 0, 0, None)


def test_future_date_is_negative_age(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 3, 23, 0),)], "t timestamp")
    assert df.select(X.days_since("t", dt.date(2024, 2, 1))).first()[0] == -2


def test_hours_between_fractional(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 1, 30))],
                               "a timestamp, b timestamp")
    r = df.select(X.hours_between("a", "b"), X.minutes_between("b", "a")).first()
    assert r[0] == 1.5 and r[1] == -90.0


def test_json_number_tolerant(spark):
    vals = one(spark, X.json_number("j", "$.lead_id"),
               [('{"lead_id": "12.5"}',), ('{"lead_id": 7}',), ("{bad json",), ('{"x": 1}',), ('{"lead_id": "abc"}',)],
               "j string")
    assert [None if v is None else int(v) for v in vals] == [13, 7, None, None, None]


def test_to_number_and_timestamp_coercion(spark):
    df = spark.createDataFrame([("12.5", "2024-01-02 03:04:05"), ("x", "not a date"), (None, None)],
                               "n string, t string")
    r = df.select(X.to_number("n"), X.to_timestamp_lenient("t")).collect()
    assert r[0][0] == 12.5 and r[0][1] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r[1][0] is None and r[1][1] is None


def test_normalise_category(spark):
    vals = one(spark, X.normalise_category("c"), [(None,), ("  Foo ",), ("",), ("NaN",), ("None",)], "c string")
    assert vals == ["missing", "foo", "missing", "missing", "missing"]


def test_keyword_match_traps(spark):
    vals = one(spark, X.contains_any("t", ["interested", "fee"]),
               [("Not Interested",), ("coffee",), (None,), ("hello",)], "t string")
    assert vals == [True, True, False, False]


def test_real_email(spark):
    vals = one(spark, X.real_email("e"), [(None,), ("",), ("default@x.io",), ("a@b.c",)], "e string")
    assert vals == [0, 1, 0, 1]


def test_exp_decay_not_clipped(spark):
    vals = one(spark, X.exp_decay("d"), [(0,), (30,), (-30,)], "d int")
    assert vals[0] == 100.0 and vals[1] == 36.79 and vals[2] > 100
