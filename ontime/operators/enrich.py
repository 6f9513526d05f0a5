"""Flights x airport->station map x daily weather -> enriched fact table.

Plan shape (what ``explain`` shows):

* the station map (one row per airport) is staged as a small Parquet table and
  broadcast after its size in bytes is checked, so attaching origin and destination
  stations is two map-side hash lookups -- the fact table is not shuffled for them;
* weather is cut to the mapped stations by a broadcast left-semi join and to the 11
  carried columns, de-duplicated (one aggregate, one shuffle on (station, date)) and
  staged as well; the bytes of its values decide the join strategy:
  - up to ``max_broadcast_bytes``: broadcast hash joins, so the whole enrichment is
    one map-only pass over the flights;
  - beyond: equi-joins on (station, date) that shuffle the flights; a hot airport is
    spread over its dates, flights without a station (NULL key) are spread by date,
    and AQE splits any remaining skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.joins import MAX_BROADCAST_BYTES, bounded_broadcast, payload_bytes
from ontime.operators.weather import dedupe_weather
from ontime.schema import CLEAN_COLUMNS, ENRICH_WEATHER, ENRICHED_COLUMNS


def _packed(flights: DataFrame) -> DataFrame:
    """(origin, dest, flight_date, _f): the whole row as one struct beside the join keys.  A join copies its
    rows, and one nested value costs a fraction of its columns; the last projection unpacks them."""
    return flights.select("origin", "dest", "flight_date", F.struct(*flights.columns).alias("_f"))


def _stations_of(packed: DataFrame, mapping: DataFrame, mapping_bytes: int | None) -> DataFrame:
    m = bounded_broadcast(mapping.select("iata", "station_id"), size=mapping_bytes)
    origin = m.select(F.col("iata").alias("origin"), F.col("station_id").alias("origin_station"))
    dest = m.select(F.col("iata").alias("dest"), F.col("station_id").alias("dest_station"))
    return packed.join(origin, "origin", "left").join(dest, "dest", "left")


def attach_stations(flights: DataFrame, mapping: DataFrame, mapping_bytes: int | None = None) -> DataFrame:
    """Left-join the station of the origin and of the destination airport."""
    return _stations_of(_packed(flights), mapping, mapping_bytes).select("_f.*", "origin_station", "dest_station")


def weather_for_mapped(weather: DataFrame, mapping: DataFrame, mapping_bytes: int | None = None) -> DataFrame:
    """Weather rows of mapped stations only, pruned to what the enrichment carries,
    de-duplicated per (station, date).  Result-neutral rewrite of the plain dedupe:
    other stations can never match a flight."""
    stations = bounded_broadcast(mapping.select("station_id").distinct(), size=mapping_bytes)
    keep = ["station_id", "weather_date"] + (["stn"] if "stn" in weather.columns else []) + ENRICH_WEATHER
    w = weather.select(*keep).join(stations, "station_id", "left_semi")
    return dedupe_weather(w)


NULL_SALTS = 4096


def _salted(station: str, row: str = "") -> F.Column:
    """Join key for the shuffle path: flights without a station (possibly a large
    share of all rows) get a key that can never match a station id (the prefix is
    not a valid id) and is spread by a hash of the row, instead of all landing on
    the (NULL, date) partitions."""
    salt = F.pmod(F.xxhash64(*[f"{row}{c}" for c in ("flight_date", "reporting_airline", "flight_number", "origin", "dest",
                                                     "crs_dep_time", "tail_number")]), F.lit(NULL_SALTS))
    return F.coalesce(F.col(station), F.concat(F.lit("\u0000null-"), salt.cast("string")))


def _weather_of(packed: DataFrame, wx: DataFrame, small: bool) -> DataFrame:
    if small:
        wx = F.broadcast(wx)
    out = packed.select("flight_date", "_f", "origin_station", "dest_station", *[
        (F.col(f"{role}_station") if small else _salted(f"{role}_station", "_f.")).alias(f"_{role}_key")
        for role in ("origin", "dest")])
    for role in ("origin", "dest"):
        side = wx.select(F.col("station_id").alias(f"_{role}_key"), F.col("weather_date").alias("flight_date"),
                         F.struct(*ENRICH_WEATHER).alias(f"_{role}"))
        out = out.join(side, [f"_{role}_key", "flight_date"], "left")
    return out.select(*[F.col(f"_f.{c}") for c in CLEAN_COLUMNS], "origin_station", "dest_station",
                      *[F.col(f"_{role}.{c}").alias(f"{role}_{c}") for role in ("origin", "dest") for c in ENRICH_WEATHER]
                      ).select(*ENRICHED_COLUMNS)


def join_weather(flights_with_stations: DataFrame, weather_dedup: DataFrame, weather_bytes: int | None = None,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left-join the day's weather at both ends; columns prefixed by role."""
    packed = flights_with_stations.select("flight_date", "origin_station", "dest_station", F.struct(*CLEAN_COLUMNS).alias("_f"))
    return _weather_of(packed, weather_dedup, weather_bytes is not None and weather_bytes <= max_broadcast_bytes)


def enrich(flights: DataFrame, mapping: DataFrame, weather: DataFrame,
           max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """flights_clean + station ids + origin_/dest_ weather: 60 columns, one row per flight.

    ``mapping`` is the airport->station map (iata, station_id, ...), ``weather`` the
    typed, not yet de-duplicated daily table (e.g. from ``load_weather``).  Both small
    sides are staged under the shared checkpoint folder (see ``stage_table``)."""
    from ontime.sources.sinks import stage_table
    m, _ = stage_table(mapping.select("iata", "station_id"), "airport_station")
    m_bytes = payload_bytes(m)
    f = _stations_of(_packed(flights.select(*CLEAN_COLUMNS)), m, m_bytes)
    wx, _ = stage_table(weather_for_mapped(weather, m, m_bytes), "weather_mapped")
    return _weather_of(f, wx, payload_bytes(wx) <= max_broadcast_bytes)
