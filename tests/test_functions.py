import datetime as dt

from pyspark.sql import functions as F

from ontime.functions.columns import haversine_km, parse_date, safe_divide, to_int
from ontime.operators.clean import delay_label, dep_hour


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_bulk_cast_truncates_and_nulls(spark):
    vals = ["", "5.00", "-3.7", "12.9", "abc", "1e10", "NaN", " 12.0 "]
    got = [r[0] for r in one_col(spark, vals).select(to_int("x")).collect()]
    assert got == [None, 5, -3, 12, None, None, None, 12]


def test_date_parse_is_strict(spark):
    vals = ["2019-01-05", "2019-1-5", "2019-02-30", "2019-01"]
    got = [r[0] for r in one_col(spark, vals).select(parse_date("x")).collect()]
    assert got == [dt.date(2019, 1, 5), None, None, None]


def test_dep_hour(spark):
    got = [r[0] for r in one_col(spark, [5, 59, 100, 2359, 2400, None], "int")
           .select(dep_hour(F.col("x"))).collect()]
    assert got == [0, 0, 1, 23, 24, None]


def test_delay_label_never_null(spark):
    rows = [(1, None), (1, 0), (0, 1), (0, 0), (0, None), (None, None)]
    df = spark.createDataFrame(rows, "c int, a int")
    assert [r[0] for r in df.select(delay_label(F.col("c"), F.col("a"))).collect()] == [1, 1, 1, 0, 0, 0]


def test_day_of_week_sunday_is_1(spark):
    df = spark.createDataFrame([(dt.date(2019, 3, 10),)], "d date")
    assert df.select(F.dayofweek("d")).first()[0] == 1


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 1)], "a long, b long")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, 0.5, None]


def test_haversine_known_distance(spark):
    # one degree of latitude on a 6371 km sphere
    df = spark.createDataFrame([(10.0, 20.0, 11.0, 20.0)], "a double, b double, c double, d double")
    d = df.select(haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(d - 6371.0 * 3.141592653589793 / 180) < 1e-9


def test_plain_dates_parse_as_the_formatter_does(spark):
    texts = ["2019-02-28", "2019-02-30", "2020-02-29", "1582-10-10", "1000-01-01", "0999-01-01", "0000-01-01", "9999-12-31", "2019-13-01",
             "2019-1-1", "2019-01-01 ", " 2019-01-01", "2019-01-01T", "20190101", "12019-01-01", "+2019-01-01", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = [F.coalesce(d.cast("string"), F.lit("none")).alias(n) for n, d in (("a", parse_date("t")), ("b", F.try_to_date("t", "yyyy-MM-dd")))]
    for r in rows.select("t", *both).collect():
        assert r["a"] == r["b"], r
