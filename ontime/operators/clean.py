"""Raw string flights -> typed, renamed, derived ``flights_clean`` (36 columns).

Everything is one projection + one filter, so Catalyst collapses it into a single
codegen stage right above the scan (a ``withColumn`` loop would grow the plan)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import parse_date, to_int
from ontime.schema import CLEAN_COLUMNS, INT_COLUMNS, RAW_TO_CLEAN


def dep_hour(crs_dep_time: Column) -> Column:
    """Scheduled departure hour: hhmm / 100 truncated (2400 -> 24), NULL stays NULL."""
    return (crs_dep_time / 100).cast("int")


def delay_label(cancelled: Column, arr_del15: Column) -> Column:
    """1 when cancelled, else the arrival-delay flag, else 0 -- never NULL
    (a diverted flight with no arrival flag counts as on time)."""
    return F.when(cancelled == 1, 1).otherwise(F.coalesce(arr_del15, F.lit(0)))


def clean_flights(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Type, rename and derive; rows whose date does not parse are dropped.  ``carry``: further
    columns of ``raw`` that stay as they are."""
    typed = []
    for src, dst in RAW_TO_CLEAN:
        if src == "FlightDate":
            typed.append(parse_date(F.col(src)).alias(dst))
        elif src in INT_COLUMNS:
            typed.append(to_int(F.col(src)).alias(dst))
        else:
            typed.append(F.col(src).alias(dst))
    df = raw.select(*typed, *carry)
    d = F.col("flight_date")
    df = df.select(
        *[F.col(n) for _, n in RAW_TO_CLEAN],
        F.dayofweek(d).alias("day_of_week"),
        dep_hour(F.col("crs_dep_time")).alias("dep_hour"),
        delay_label(F.col("cancelled"), F.col("arr_del15")).alias("is_delayed_15"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        *carry,
    )
    return df.filter(d.isNotNull()).select(*CLEAN_COLUMNS, *carry)
