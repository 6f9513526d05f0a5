"""The five ad-hoc reports (A1-A5) over the enriched fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import count_where, pct


def _n() -> F.Column:
    return F.count(F.lit(1))


def headline(fact: DataFrame) -> DataFrame:
    """A1: one row of totals."""
    return fact.agg(_n().alias("total_flights"),
                    count_where(F.col("cancelled") == 1).alias("cancelled"),
                    count_where(F.col("diverted") == 1).alias("diverted"),
                    F.round(F.avg("arr_delay_minutes"), 2).alias("avg_arr_delay_min"),
                    F.min("flight_date").alias("min_date"),
                    F.max("flight_date").alias("max_date"))


def yearly_impact(fact: DataFrame) -> DataFrame:
    """A2: per calendar year of the flight date (not the directory year)."""
    return (fact.groupBy(F.year("flight_date").alias("year"))
            .agg(_n().alias("flights"),
                 F.round(F.avg("arr_delay_minutes"), 2).alias("avg_arr_delay_min"),
                 pct(count_where(F.col("cancelled") == 1), _n()).alias("cancel_pct"))
            .orderBy("year"))


def worst_airports(fact: DataFrame, min_flights: int = 50_000, top: int = 10) -> DataFrame:
    """A3: busiest-enough departure airports with the highest mean arrival delay.

    Grouping is partial-aggregated; the HAVING is a filter after the aggregate and the
    ORDER BY .. LIMIT becomes a top-k (TakeOrderedAndProject), ties broken by code.
    """
    return (fact.filter(F.col("cancelled") == 0)
            .groupBy("origin")
            .agg(_n().alias("flights"),
                 F.round(F.avg("arr_delay_minutes"), 2).alias("avg_arr_delay_min"),
                 pct(count_where(F.col("arr_del15") == 1), _n()).alias("delay_pct"))
            .filter(F.col("flights") >= min_flights)
            .orderBy(F.col("avg_arr_delay_min").desc_nulls_last(), F.col("origin").asc())
            .limit(top))


def wind_category(x) -> F.Column:
    return F.when(x >= 20, F.lit("windy (>=20 kt)")).otherwise(F.lit("calm (<20 kt)"))


def wind_vs_calm(fact: DataFrame) -> DataFrame:
    """A4: windy vs calm departures (rows without a wind reading excluded)."""
    return (fact.filter(F.col("origin_wdsp").isNotNull())
            .groupBy(wind_category(F.col("origin_wdsp")).alias("wind_cat"))
            .agg(_n().alias("flights"),
                 F.round(F.avg("arr_delay_minutes"), 2).alias("avg_arr_delay_min"),
                 pct(count_where(F.col("arr_del15") == 1), _n()).alias("delay_pct")))


def delay_causes_total(fact: DataFrame) -> DataFrame:
    """A5: total minutes per cause over delayed arrivals; plain SUM, so a cause
    that is NULL on every row gives NULL (unlike the V2 view's COALESCE)."""
    causes = [("carrier_delay", "total_carrier_min"), ("weather_delay", "total_weather_min"),
              ("nas_delay", "total_nas_min"), ("security_delay", "total_security_min"),
              ("late_aircraft_delay", "total_late_aircraft_min")]
    return (fact.filter(F.col("arr_del15") == 1)
            .agg(*[F.sum(src).cast("bigint").alias(dst) for src, dst in causes]))
