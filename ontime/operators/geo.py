"""Airport -> weather-station matching.

The candidate search is an equi-join on grid cells instead of a theta join: a
theta join on coordinates can only run as a nested loop (every airport against
every station).  Points are bucketed into cells at least as wide as the search
window; one side is expanded to its 3x3 neighbourhood, joined on the cell id, and the
exact predicate is re-applied.  Every other-side point has exactly one cell, so no
pair is produced twice, and the join shuffles on the cell key like any equi-join
(skewed dense cells are split by AQE's skew-join handling).

Two candidate modes:

* ``box``   -- the original rule: |dlat| < box_deg and |dlon| < box_deg (degrees,
              no wrap at +-180), then distance < max_km.  North of ~53 deg the box is
              narrower than max_km east-west, so it can miss stations there.
* ``exact`` -- every pair with great-circle distance < max_km: latitude bands of
              the angular radius, and per band a longitude cell width derived from the
              haversine bound at the band's highest latitude, wrapped at +-180.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import EARTH_RADIUS_KM, haversine_km


# ---------------------------------------------------------------------------
# stations (S8, P10, A10)
# ---------------------------------------------------------------------------
def active_stations(stations: DataFrame, active_since: str = "20190101", country: str = "US",
                    sentinel_wban: str = "99999") -> DataFrame:
    """Stations usable for matching: in ``country``, with a real WBAN, coordinates
    and an ``end`` date (YYYYMMDD string) on/after ``active_since``.

    One row per WBAN; lat and lon come together from the most recent row
    (``end``, then ``usaf``) instead of two independent arbitrary picks.  ``max_by``
    is an ordinary aggregate, so a WBAN with many rows is pre-reduced map-side.
    """
    s = stations.dropna(subset=["lat", "lon"]).where(
        (F.col("country") == country) & (F.col("wban") != sentinel_wban) & (F.col("end") >= active_since))
    order = F.struct("end", "usaf") if "usaf" in stations.columns else F.struct("end")
    best = s.groupBy("wban").agg(
        F.max_by(F.struct(F.col("lat").try_cast("double").alias("lat"),
                          F.col("lon").try_cast("double").alias("lon")), order).alias("_b"))
    return best.select(F.col("wban").alias("station_id"), F.col("_b.lat").alias("st_lat"),
                       F.col("_b.lon").alias("st_lon"))


# ---------------------------------------------------------------------------
# candidate pairs
# ---------------------------------------------------------------------------
def _offsets() -> Column:
    return F.array(F.lit(-1), F.lit(0), F.lit(1))


def _cell(x: Column, width: float) -> Column:
    return F.floor(x / F.lit(width))


def box_pairs(left: DataFrame, right: DataFrame, box_deg: float = 0.75,
              left_lat: str = "ap_lat", left_lon: str = "ap_lon",
              right_lat: str = "st_lat", right_lon: str = "st_lon") -> DataFrame:
    """All (left, right) pairs with |dlat| < box_deg and |dlon| < box_deg, as a
    grid equi-join.  Output: every left column + every right column."""
    l = (left
         .withColumn("_dy", F.explode(_offsets()))
         .withColumn("_dx", F.explode(_offsets()))
         .withColumn("_gy", _cell(F.col(left_lat), box_deg) + F.col("_dy"))
         .withColumn("_gx", _cell(F.col(left_lon), box_deg) + F.col("_dx"))
         .drop("_dy", "_dx"))
    r = (right
         .withColumn("_gy", _cell(F.col(right_lat), box_deg))
         .withColumn("_gx", _cell(F.col(right_lon), box_deg)))
    cond = ((l["_gy"] == r["_gy"]) & (l["_gx"] == r["_gx"])
            & (F.abs(l[left_lat] - r[right_lat]) < box_deg)
            & (F.abs(l[left_lon] - r[right_lon]) < box_deg))
    return l.join(r, cond, "inner").drop(l["_gy"]).drop(l["_gx"]).drop(r["_gy"]).drop(r["_gx"])


def _band_lon_cells(band: Column, h: float, sin_half: float) -> Column:
    """Number of longitude cells in latitude band ``band`` (height ``h`` degrees).

    Two points within angular distance d and latitudes in bands b-1..b+1 satisfy
    sin(dlon/2) <= sin(d/2) / cos(phi_max) (haversine), so cells of width
    >= 2*asin(sin(d/2)/cos(phi_max)) keep any such pair in adjacent cells."""
    lo = F.lit(-90.0) + (band - 1) * F.lit(h)
    hi = F.lit(-90.0) + (band + 2) * F.lit(h)
    phi = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
    ratio = F.lit(sin_half) / F.cos(F.radians(phi))
    width = F.when(ratio >= 1, F.lit(360.0)).otherwise(F.degrees(2 * F.asin(ratio)) * F.lit(1 + 1e-9) + 1e-12)
    return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1))


def _lon_cell(lon: Column, n: Column) -> Column:
    return F.pmod(F.floor((lon + F.lit(180.0)) / (F.lit(360.0) / n)), n)


def radius_pairs(left: DataFrame, right: DataFrame, max_km: float,
                 left_lat: str = "ap_lat", left_lon: str = "ap_lon",
                 right_lat: str = "st_lat", right_lon: str = "st_lon",
                 radius_km: float = EARTH_RADIUS_KM) -> DataFrame:
    """All pairs whose great-circle distance is below ``max_km`` (exact, wraps at
    +-180 deg, any latitude), as a grid equi-join."""
    ang = max_km / radius_km                       # angular radius (rad)
    h = math.degrees(ang) * (1 + 1e-9) + 1e-12      # band height (deg)
    sin_half = math.sin(min(ang, math.pi) / 2)
    band_of = lambda lat: F.floor((lat + F.lit(90.0)) / F.lit(h))
    l = (left.withColumn("_db", F.explode(_offsets()))
         .withColumn("_gb", band_of(F.col(left_lat)) + F.col("_db"))
         .withColumn("_n", _band_lon_cells(F.col("_gb"), h, sin_half))
         .withColumn("_c", _lon_cell(F.col(left_lon), F.col("_n")))
         .withColumn("_gx", F.explode(F.array_distinct(F.transform(
             _offsets(), lambda o: F.pmod(F.col("_c") + o, F.col("_n"))))))
         .drop("_db", "_n", "_c"))
    r = (right.withColumn("_gb", band_of(F.col(right_lat)))
         .withColumn("_gx", _lon_cell(F.col(right_lon), _band_lon_cells(F.col("_gb"), h, sin_half))))
    cond = (l["_gb"] == r["_gb"]) & (l["_gx"] == r["_gx"])
    return l.join(r, cond, "inner").drop(l["_gb"]).drop(l["_gx"]).drop(r["_gb"]).drop(r["_gx"])


# ---------------------------------------------------------------------------
# nearest station (J2 + W1)
# ---------------------------------------------------------------------------
def station_candidates(airports: DataFrame, stations: DataFrame, max_km: float = 50.0,
                       box_deg: float = 0.75, mode: str = "box") -> DataFrame:
    """(iata, station_id, distance_km) for every station strictly within ``max_km``."""
    a = airports.select("iata", "ap_lat", "ap_lon")
    s = stations.select("station_id", "st_lat", "st_lon")
    if mode == "box":
        pairs = box_pairs(a, s, box_deg)
    elif mode == "exact":
        pairs = radius_pairs(a, s, max_km)
    else:
        raise ValueError(f"mode must be 'box' or 'exact', not {mode!r}")
    dist = haversine_km("ap_lat", "ap_lon", "st_lat", "st_lon")
    return (pairs.select("iata", "station_id", dist.alias("distance_km"))
            .filter(F.col("distance_km") < max_km))


def nearest(candidates: DataFrame, k: int = 1, key: str = "iata") -> DataFrame:
    """Keep the ``k`` nearest candidates per key, ties broken by the lower station id.

    k=1 is a plain min-aggregate over (distance, station_id) structs -- partial
    aggregation before the shuffle, so an airport with a huge candidate list is
    reduced map-side.  k>1 uses ``row_number`` (Spark adds a per-partition group
    limit ahead of the shuffle)."""
    if k == 1:
        best = candidates.groupBy(key).agg(F.min(F.struct("distance_km", "station_id")).alias("_b"))
        return best.select(key, F.col("_b.station_id").alias("station_id"),
                           F.col("_b.distance_km").alias("distance_km"))
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(F.col("distance_km").asc(), F.col("station_id").asc())
    return (candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(key, "station_id", "distance_km", "rank"))


def airport_station_map(airports: DataFrame, stations: DataFrame, max_km: float = 50.0,
                        box_deg: float = 0.75, active_since: str = "20190101",
                        mode: str = "box", country: str = "US") -> DataFrame:
    """iata -> nearest active station within ``max_km``: (iata, station_id, distance_km).

    ``airports`` is the raw airport table (faa_identifier, latitude, longitude) and
    ``stations`` the raw station list; airports with no station are absent."""
    from ontime.sources.tables import airports as airport_rows
    cands = station_candidates(airport_rows(airports),
                               active_stations(stations, active_since, country), max_km, box_deg, mode)
    return nearest(cands, 1)
