import datetime as dt

from pyspark.sql import functions as F

from ontime.plans import reports, views


def fact(spark, rows):
    return spark.createDataFrame(rows, "flight_date date, reporting_airline string, arr_del15 int, cancelled int, "
                                       "diverted int, arr_delay_minutes int, carrier_delay int, weather_delay int, "
                                       "nas_delay int, security_delay int, late_aircraft_delay int")


D = dt.date(2020, 3, 1)


def test_on_time_rate_denominator_is_all_flights(spark):
    f = fact(spark, [(D, "AA", 0, 0, 0, 0, None, None, None, None, None),   # on time
                     (D, "AA", 1, 0, 0, 30, None, None, None, None, None),  # delayed
                     (D, "AA", None, 1, 0, None, None, None, None, None, None),  # cancelled
                     (D, "AA", None, 0, 1, None, None, None, None, None, None)])  # diverted
    r = views.monthly_ontime_trend(f).first()
    assert (r.total_flights, r.cancelled_flights, r.delayed_flights, r.on_time_rate) == (4, 1, 1, 0.25)
    assert r.month == dt.date(2020, 3, 1)


def test_cause_sums_view_zero_report_null(spark):
    f = fact(spark, [(D, "AA", 1, 0, 0, 30, None, None, None, None, None)])
    v = views.delay_cause_breakdown(f).first()
    rep = reports.delay_causes_total(f).first()
    assert v.carrier_delay_min == 0 and rep.total_carrier_min is None


def test_bucket_edges_and_nulls(spark):
    rows = [(5.0, 0.0, 10.0), (10.0, 0.1, 3.0), (20.0, 0.5, 2.9), (30.0, None, None), (999.9, 99.99, 999.9),
            (None, 0.0, 10.0)]
    df = spark.createDataFrame([(w, p, v, 0, 0) for w, p, v in rows],
                               "origin_wdsp double, origin_prcp double, origin_visib double, arr_del15 int, "
                               "cancelled int")
    got = [tuple(r) for r in views.weather_buckets(df).select("wind_bucket", "precip_bucket", "visib_bucket")
           .collect()]
    assert got == [("05-10 kt", "none", "clear (>=10 mi)"), ("10-20 kt", "moderate", "reduced (3-10 mi)"),
                   ("20-30 kt", "heavy", "poor (<3 mi)"), ("30+ kt", "heavy", "poor (<3 mi)"),
                   ("30+ kt", "heavy", "clear (>=10 mi)")]            # NULL wind row excluded


def test_worst_airports_having_and_topk(spark):
    rows = [("A", 0, 10)] * 3 + [("B", 0, 50)] * 2 + [("C", 0, 30)] * 3 + [("C", 1, None)]
    df = spark.createDataFrame(rows, "origin string, cancelled int, arr_delay_minutes int").withColumn(
        "arr_del15", F.lit(0))
    got = [(r.origin, r.flights) for r in reports.worst_airports(df, min_flights=3, top=1).collect()]
    assert got == [("C", 3)]
