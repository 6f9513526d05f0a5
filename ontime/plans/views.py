"""The five dashboard views (V1-V5) as ``DataFrame -> DataFrame`` functions.

Each takes the enriched fact table -- or any DataFrame with the columns it uses,
e.g. ``flights_clean`` for the views that need no weather -- and is a single
grouped aggregation: partial (map-side) aggregation runs before the only shuffle,
so a hot airline / month / airport is pre-reduced per task and never lands whole
in one task.  ``register_views`` exposes them to SQL users as temp views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import bucketize, count_where, month_start, pct, safe_divide


def _cancelled() -> F.Column:
    return F.col("cancelled") == 1


def _on_time() -> F.Column:
    """Arrived without a 15-minute delay and not cancelled."""
    return (F.col("arr_del15") == 0) & (F.col("cancelled") == 0)


def monthly_ontime_trend(fact: DataFrame) -> DataFrame:
    """V1: flights per calendar month; the on-time rate's denominator is *all*
    flights, diverted ones (no arrival flag) are in neither bucket."""
    return (fact.groupBy(month_start("flight_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 count_where(_cancelled()).alias("cancelled_flights"),
                 count_where((F.col("arr_del15") == 1) & (F.col("cancelled") == 0)).alias("delayed_flights"),
                 safe_divide(count_where(_on_time()), F.count(F.lit(1))).alias("on_time_rate")))


CAUSES = [("carrier_delay", "carrier_delay_min"), ("weather_delay", "weather_delay_min"),
          ("nas_delay", "nas_delay_min"), ("security_delay", "security_delay_min"),
          ("late_aircraft_delay", "late_aircraft_delay_min")]


def delay_cause_breakdown(fact: DataFrame) -> DataFrame:
    """V2: delay minutes by cause per airline and month over delayed arrivals;
    missing cause minutes count as 0 (so an all-NULL group sums to 0)."""
    return (fact.filter(F.col("arr_del15") == 1)
            .groupBy("reporting_airline", month_start("flight_date").alias("month"))
            .agg(*[F.sum(F.coalesce(F.col(src), F.lit(0))).cast("bigint").alias(dst) for src, dst in CAUSES],
                 F.count(F.lit(1)).alias("flights")))


def airport_heatmap(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """V3: per departure airport: volume, mean delays, cancellation rate.

    ``airports`` is the raw airport table (faa_identifier, name, latitude, longitude);
    it is not de-duplicated, so a repeated code joins twice but is kept apart by the
    name/coordinate grouping.  The join is left to the planner: airports is a small
    dimension, picked for broadcast by its measured size (AQE re-checks at run time).
    """
    ap = (airports.filter(F.col("faa_identifier").isNotNull())
          .select(F.col("faa_identifier").alias("iata"), "name", "latitude", "longitude"))
    f = fact.select("origin", "dep_delay_minutes", "arr_delay_minutes", "cancelled")
    j = f.join(ap, f["origin"] == ap["iata"], "inner")
    return (j.groupBy("iata", "name", "latitude", "longitude")
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 F.avg("dep_delay_minutes").alias("avg_dep_delay_min"),
                 F.avg("arr_delay_minutes").alias("avg_arr_delay_min"),
                 safe_divide(count_where(_cancelled()), F.count(F.lit(1))).alias("cancellation_rate")))


def wind_bucket(x) -> F.Column:
    return bucketize(x, [(x < 5, "00-05 kt"), (x < 10, "05-10 kt"), (x < 20, "10-20 kt"),
                         (x < 30, "20-30 kt")], "30+ kt")


def precip_bucket(x) -> F.Column:
    # NULL precipitation falls through to the ELSE branch ('heavy'), as in the source view.
    return bucketize(x, [(x == 0, "none"), (x < 0.1, "light"), (x < 0.5, "moderate")], "heavy")


def visib_bucket(x) -> F.Column:
    # NULL visibility falls through to 'poor (<3 mi)'.
    return bucketize(x, [(x >= 10, "clear (>=10 mi)"), (x >= 3, "reduced (3-10 mi)")], "poor (<3 mi)")


def weather_buckets(fact: DataFrame) -> DataFrame:
    """The three bucket labels for every row with a wind reading."""
    return (fact.filter(F.col("origin_wdsp").isNotNull())
            .select(wind_bucket(F.col("origin_wdsp")).alias("wind_bucket"),
                    precip_bucket(F.col("origin_prcp")).alias("precip_bucket"),
                    visib_bucket(F.col("origin_visib")).alias("visib_bucket"),
                    "arr_del15", "cancelled"))


def weather_correlation(fact: DataFrame) -> DataFrame:
    """V4: delay and cancellation rates per (wind, precipitation, visibility) bucket."""
    return (weather_buckets(fact)
            .groupBy("wind_bucket", "precip_bucket", "visib_bucket")
            .agg(F.count(F.lit(1)).alias("flights"),
                 safe_divide(count_where(F.col("arr_del15") == 1), F.count(F.lit(1))).alias("delay_rate"),
                 safe_divide(count_where(_cancelled()), F.count(F.lit(1))).alias("cancellation_rate")))


def airline_kpi(fact: DataFrame) -> DataFrame:
    """V5: per airline KPIs in percent, rounded to 2 places, busiest first."""
    n = F.count(F.lit(1))
    return (fact.groupBy("reporting_airline")
            .agg(n.alias("flights"),
                 F.round(F.avg("arr_delay_minutes"), 2).alias("avg_arr_delay_min"),
                 pct(count_where(_on_time()), n).alias("on_time_pct"),
                 pct(count_where(_cancelled()), n).alias("cancellation_pct"),
                 pct(count_where(F.col("diverted") == 1), n).alias("diversion_pct"))
            .orderBy(F.col("flights").desc(), F.col("reporting_airline").asc()))


VIEWS = {
    "v_monthly_ontime_trend": monthly_ontime_trend,
    "v_delay_cause_breakdown": delay_cause_breakdown,
    "v_weather_correlation": weather_correlation,
    "v_airline_kpi": airline_kpi,
}


def register_views(fact: DataFrame, airports: DataFrame | None = None) -> list[str]:
    """``CREATE OR REPLACE VIEW`` for the dashboard -> session temp views."""
    names = []
    for name, fn in VIEWS.items():
        fn(fact).createOrReplaceTempView(name)
        names.append(name)
    if airports is not None:
        airport_heatmap(fact, airports).createOrReplaceTempView("v_airport_delay_heatmap")
        names.append("v_airport_delay_heatmap")
    return names
