"""Independent DuckDB SQL for each checkable query.

These are written from the operator semantics (SURVEY §1.4), not generated from
the Spark code.  DuckDB differences handled here: ``dayofweek`` is 0-based,
``date_trunc`` returns a timestamp, ``SUM``/``count_if`` return HUGEINT, double->int
casts round (so truncate first), ``round`` on a double is not half-up on the
shortest decimal (so round through DECIMAL), NULLs sort last.
"""

from __future__ import annotations

from ontime.operators.weather import DEDUPE_ORDER
from ontime.schema import ENRICH_WEATHER, INT_COLUMNS, RAW_TO_CLEAN, WEATHER_FLAGS, WEATHER_READINGS
from ontime.sources.testbed import cte_sql, register_cte


def r2(x: str, d: int = 2) -> str:
    """Half-up rounding of a double on its shortest decimal form, as Spark does."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {d}) AS DOUBLE)"


def sdiv(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF({den}, 0))"


def cnt(pred: str) -> str:
    return f"CAST(count_if({pred}) AS BIGINT)"


def _to_int(x: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def _clean_select() -> str:
    cols = []
    for src, dst in RAW_TO_CLEAN:
        if src == "FlightDate":
            cols.append(f"CASE WHEN regexp_full_match({src}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                        f"THEN TRY_CAST({src} AS DATE) END AS {dst}")
        elif src in INT_COLUMNS:
            cols.append(f"{_to_int(src)} AS {dst}")
        else:
            cols.append(f"{src} AS {dst}")
    return ",\n    ".join(cols)


CLEAN_FROM = (
    "SELECT *, CAST(dayofweek(flight_date) + 1 AS INTEGER) AS day_of_week, "
    "CASE WHEN crs_dep_time IS NOT NULL THEN CAST(trunc(crs_dep_time / 100) AS INTEGER) END AS dep_hour, "
    "CAST(CASE WHEN cancelled = 1 THEN 1 WHEN arr_del15 IS NOT NULL THEN arr_del15 ELSE 0 END AS INTEGER) "
    "AS is_delayed_15, "
    "CAST(year(flight_date) AS INTEGER) AS year, CAST(month(flight_date) AS INTEGER) AS month "
    "FROM (SELECT {cols} FROM {src}) t WHERE flight_date IS NOT NULL"
)

register_cte("tb_flights", CLEAN_FROM.format(cols=_clean_select(), src="tb_raw_flights"), ["tb_raw_flights"])


def flights_sql(body: str) -> str:
    return cte_sql(body, "tb_flights")


__all__ = ["r2", "sdiv", "cnt", "flights_sql", "cte_sql", "register_cte", "ENRICH_WEATHER"]


# ---------------------------------------------------------------------------
# stations, airports, matching
# ---------------------------------------------------------------------------
def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371.0 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))")


register_cte("tb_stations_active", (
    "SELECT wban AS station_id, CAST(lat AS DOUBLE) AS st_lat, CAST(lon AS DOUBLE) AS st_lon FROM ("
    "SELECT *, row_number() OVER (PARTITION BY wban ORDER BY \"end\" DESC, usaf DESC) AS rn "
    "FROM tb_stations_raw WHERE country = 'US' AND wban IS NOT NULL AND wban <> '99999' "
    "AND lat IS NOT NULL AND lon IS NOT NULL AND \"end\" >= '20190101') s WHERE rn = 1"), ["tb_stations_raw"])
register_cte("tb_ap", (
    "SELECT faa_identifier AS iata, CAST(latitude AS DOUBLE) AS ap_lat, CAST(longitude AS DOUBLE) AS ap_lon "
    "FROM tb_airports WHERE faa_identifier IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"),
    ["tb_airports"])
register_cte("tb_box", (
    "SELECT a.iata, a.ap_lat, a.ap_lon, s.station_id, s.st_lat, s.st_lon FROM tb_ap a JOIN tb_stations_active s "
    "ON abs(a.ap_lat - s.st_lat) < 0.75 AND abs(a.ap_lon - s.st_lon) < 0.75"), ["tb_ap", "tb_stations_active"])
register_cte("tb_cands", (
    f"SELECT iata, station_id, {hav('ap_lat', 'ap_lon', 'st_lat', 'st_lon')} AS distance_km FROM tb_box"),
    ["tb_box"])
register_cte("tb_cands_exact", (
    f"SELECT * FROM (SELECT a.iata, s.station_id, {hav('a.ap_lat', 'a.ap_lon', 's.st_lat', 's.st_lon')} "
    "AS distance_km FROM tb_ap a, tb_stations_active s) x"), ["tb_ap", "tb_stations_active"])
for _name, _src in (("tb_map", "tb_cands"), ("tb_map_exact", "tb_cands_exact")):
    register_cte(_name, (
        "SELECT iata, station_id, distance_km FROM (SELECT *, row_number() OVER (PARTITION BY iata "
        f"ORDER BY distance_km, station_id) AS rn FROM {_src} WHERE distance_km < 50) m WHERE rn = 1"), [_src])

# ---------------------------------------------------------------------------
# weather
# ---------------------------------------------------------------------------
WX_COLS = [name for _, name in WEATHER_READINGS + WEATHER_FLAGS]
_DATE = "concat_ws('-', year, mo, da)"
register_cte("tb_weather", (
    "SELECT wban AS station_id, "
    f"CASE WHEN regexp_full_match({_DATE}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({_DATE} AS DATE) END "
    "AS weather_date, "
    + ", ".join(f"TRY_CAST({s} AS DOUBLE) AS {d}" for s, d in WEATHER_READINGS) + ", "
    + ", ".join(f"{s} AS {d}" for s, d in WEATHER_FLAGS)
    + ", stn FROM tb_weather_raw WHERE wban <> '99999' AND TRY_CAST(year AS INTEGER) BETWEEN 2019 AND 2025"),
    ["tb_weather_raw"])
register_cte("tb_wx", (
    "SELECT station_id, weather_date, " + ", ".join(WX_COLS) + " FROM (SELECT *, row_number() OVER ("
    "PARTITION BY station_id, weather_date ORDER BY stn NULLS FIRST, "
    + ", ".join(f"{c} NULLS FIRST" for c in DEDUPE_ORDER)
    + ") AS rn FROM tb_weather WHERE weather_date IS NOT NULL) w WHERE rn = 1"), ["tb_weather"])

# ---------------------------------------------------------------------------
# enrichment
# ---------------------------------------------------------------------------
register_cte("tb_fs", (
    "SELECT f.*, mo.station_id AS origin_station, md.station_id AS dest_station FROM tb_flights f "
    "LEFT JOIN tb_map mo ON f.origin = mo.iata LEFT JOIN tb_map md ON f.dest = md.iata"),
    ["tb_flights", "tb_map"])
register_cte("tb_enriched", (
    "SELECT f.*, "
    + ", ".join(f"wo.{c} AS origin_{c}" for c in ENRICH_WEATHER) + ", "
    + ", ".join(f"wd.{c} AS dest_{c}" for c in ENRICH_WEATHER)
    + " FROM tb_fs f LEFT JOIN tb_wx wo ON wo.station_id = f.origin_station AND wo.weather_date = f.flight_date "
    "LEFT JOIN tb_wx wd ON wd.station_id = f.dest_station AND wd.weather_date = f.flight_date"),
    ["tb_fs", "tb_wx"])
