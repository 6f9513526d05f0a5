"""Daily weather: typed projection (P11/P12), year-family union (S9/U1) and the
deterministic (station, date) de-duplication (A11)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import parse_date, to_double
from ontime.schema import ENRICH_WEATHER, WEATHER_FLAGS, WEATHER_READINGS, WEATHER_SENTINELS
from ontime.sources.tables import yearly_family

KEYS = ["station_id", "weather_date"]

# Tie-break order of the de-duplication after the source station code: the columns
# carried into the enriched table first, so de-duplicating a pruned projection picks
# the same values for them as de-duplicating full rows.
DEDUPE_ORDER = ENRICH_WEATHER + ["slp", "temp_max", "temp_min", "sndp", "hail", "tornado"]


def parse_weather(raw: DataFrame, nullify_sentinels: bool = False, sentinel_wban: str = "99999") -> DataFrame:
    """Typed daily readings: (station_id, weather_date, 11 doubles, 6 flags[, stn]).

    The date is assembled from the year / month / day strings and parsed strictly;
    a NULL or impossible part gives a NULL date.  ``wban != sentinel`` also removes
    NULL station codes.  With ``nullify_sentinels`` the dataset's missing-value
    markers (9999.9 / 999.9 / 99.99) become NULL; off by default, as originally.
    """
    readings = []
    for src, dst in WEATHER_READINGS:
        v = to_double(src)
        if nullify_sentinels and dst in WEATHER_SENTINELS:
            v = F.when(v != F.lit(WEATHER_SENTINELS[dst]), v)
        readings.append(v.alias(dst))
    extra = [F.col("stn")] if "stn" in raw.columns else []
    return (raw.filter(F.col("wban") != sentinel_wban)
            .select(F.col("wban").alias("station_id"),
                    parse_date(F.concat_ws("-", "year", "mo", "da")).alias("weather_date"),
                    *readings,
                    *[F.col(src).alias(dst) for src, dst in WEATHER_FLAGS],
                    *extra))


def load_weather(source: DataFrame | Callable[[int], DataFrame], start_year: int = 2019,
                 end_year: int = 2025, nullify_sentinels: bool = False) -> DataFrame:
    """Weather for an inclusive year range.

    ``source`` is either one table per year (a callable ``year -> DataFrame``, unioned
    by name) or a single table with a ``year`` column, filtered on it -- the filter
    reaches the scan, so a year-partitioned table only reads the requested years.
    """
    if callable(source) and not isinstance(source, DataFrame):
        raw = yearly_family(source, start_year, end_year)
    else:
        raw = source.filter(F.col("year").try_cast("int").between(start_year, end_year))
    return parse_weather(raw, nullify_sentinels)


def dedupe_weather(weather: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row per (station, date): the row with the lowest source station code
    (``stn``), then the lowest readings in ``DEDUPE_ORDER``.  Rows without a date are
    dropped (they can never join).

    Written as a ``min`` over a struct -- an aggregate, so duplicates are collapsed
    map-side before the shuffle and a key with very many copies never has to be
    gathered into one task (a ``row_number`` window would sort the whole group)."""
    payload = [c for c in DEDUPE_ORDER if c in weather.columns]
    rest = [c for c in weather.columns if c not in keys and c not in payload and c != "stn"]
    order = (["stn"] if "stn" in weather.columns else []) + payload + rest
    out = (weather.filter(F.col("weather_date").isNotNull())
           .groupBy(*keys).agg(F.min(F.struct(*order)).alias("_r")))
    cols = [c for c in weather.columns if c not in keys and c != "stn"]
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])
