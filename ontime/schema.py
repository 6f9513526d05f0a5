"""Fixed schemas of the on-time data model: raw archive columns, the cleaned fact
table, the weather table and the enriched table.  Column order is contractual."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source data model exactly).
# The 31 kept columns of the public BTS on-time CSV, paired with their cleaned
# snake_case names, in the order they appear in the cleaned table.
# ---------------------------------------------------------------------------
RAW_TO_CLEAN = [
    ("FlightDate", "flight_date"),
    ("Reporting_Airline", "reporting_airline"),
    ("Tail_Number", "tail_number"),
    ("Flight_Number_Reporting_Airline", "flight_number"),
    ("Origin", "origin"),
    ("OriginState", "origin_state"),
    ("Dest", "dest"),
    ("DestState", "dest_state"),
    ("CRSDepTime", "crs_dep_time"),
    ("DepTime", "dep_time"),
    ("DepDelay", "dep_delay"),
    ("DepDelayMinutes", "dep_delay_minutes"),
    ("DepDel15", "dep_del15"),
    ("TaxiOut", "taxi_out"),
    ("TaxiIn", "taxi_in"),
    ("CRSArrTime", "crs_arr_time"),
    ("ArrTime", "arr_time"),
    ("ArrDelay", "arr_delay"),
    ("ArrDelayMinutes", "arr_delay_minutes"),
    ("ArrDel15", "arr_del15"),
    ("Cancelled", "cancelled"),
    ("CancellationCode", "cancellation_code"),
    ("Diverted", "diverted"),
    ("ActualElapsedTime", "actual_elapsed_time"),
    ("AirTime", "air_time"),
    ("Distance", "distance"),
    ("CarrierDelay", "carrier_delay"),
    ("WeatherDelay", "weather_delay"),
    ("NASDelay", "nas_delay"),
    ("SecurityDelay", "security_delay"),
    ("LateAircraftDelay", "late_aircraft_delay"),
]

# Raw columns that stay strings after cleaning (everything else except the date is int).
STRING_COLUMNS = ["Reporting_Airline", "Tail_Number", "Origin", "OriginState", "Dest",
                  "DestState", "CancellationCode"]

RAW_COLUMNS = [r for r, _ in RAW_TO_CLEAN]
INT_COLUMNS = [r for r in RAW_COLUMNS if r not in STRING_COLUMNS and r != "FlightDate"]
DERIVED_COLUMNS = ["day_of_week", "dep_hour", "is_delayed_15", "year", "month"]
CLEAN_COLUMNS = [n for _, n in RAW_TO_CLEAN] + DERIVED_COLUMNS

RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in RAW_COLUMNS])


def clean_schema() -> T.StructType:
    fields = []
    for raw, name in RAW_TO_CLEAN:
        if raw == "FlightDate":
            t = T.DateType()
        elif raw in STRING_COLUMNS:
            t = T.StringType()
        else:
            t = T.IntegerType()
        fields.append(T.StructField(name, t, True))
    fields += [T.StructField(n, T.IntegerType(), True) for n in DERIVED_COLUMNS]
    return T.StructType(fields)


# ---------------------------------------------------------------------------
# FIXED VALUES: daily weather (public GSOD layout).  Source name -> our name for
# the readings cast to double, then the flags kept as "0"/"1" strings.
# ---------------------------------------------------------------------------
WEATHER_READINGS = [
    ("temp", "temp"), ("dewp", "dewp"), ("slp", "slp"), ("visib", "visib"), ("wdsp", "wdsp"),
    ("mxpsd", "mxpsd"), ("gust", "gust"), ("max", "temp_max"), ("min", "temp_min"),
    ("prcp", "prcp"), ("sndp", "sndp"),
]
WEATHER_FLAGS = [
    ("fog", "fog"), ("rain_drizzle", "rain"), ("snow_ice_pellets", "snow"), ("hail", "hail"),
    ("thunder", "thunder"), ("tornado_funnel_cloud", "tornado"),
]
WEATHER_COLUMNS = (["station_id", "weather_date"] + [n for _, n in WEATHER_READINGS]
                   + [n for _, n in WEATHER_FLAGS])

# FIXED VALUES: the per-side weather columns carried into the enriched table, in this order.
ENRICH_WEATHER = ["temp", "dewp", "visib", "wdsp", "mxpsd", "gust", "prcp",
                  "fog", "rain", "snow", "thunder"]

# Missing-value sentinels of the public daily-weather dataset (documented there,
# not handled by the original pipeline -> off by default).
WEATHER_SENTINELS = {
    "temp": 9999.9, "dewp": 9999.9, "slp": 9999.9, "temp_max": 9999.9, "temp_min": 9999.9,
    "visib": 999.9, "wdsp": 999.9, "mxpsd": 999.9, "gust": 999.9, "sndp": 999.9,
    "prcp": 99.99,
}

STATION_COLUMNS = ["station_id", "st_lat", "st_lon"]
AIRPORT_STATION_COLUMNS = ["iata", "station_id", "distance_km"]

ENRICHED_COLUMNS = (CLEAN_COLUMNS + ["origin_station", "dest_station"]
                    + [f"origin_{w}" for w in ENRICH_WEATHER]
                    + [f"dest_{w}" for w in ENRICH_WEATHER])

# Model input (label + 11 features) with the names the models see.
LABEL = "is_delayed_15"
CATEGORICAL_FEATURES = ["reporting_airline", "origin", "dest"]
NUMERIC_FEATURES = ["dep_hour", "day_of_week", "month", "distance",
                    "wind_speed", "precipitation", "visibility", "temperature"]
FEATURE_SOURCES = {"wind_speed": "origin_wdsp", "precipitation": "origin_prcp",
                   "visibility": "origin_visib", "temperature": "origin_temp"}
