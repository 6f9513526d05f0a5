"""Test bed: the supplied TPC-H-style tables re-dressed as the on-time data model.

There are no flight archives, station lists or weather tables among the supplied
inputs, so this module derives them -- deterministically, with integer arithmetic --
from ``lineitem``, ``orders``, ``supplier``, ``customer`` and ``nation``:

* raw flights   one row per lineitem, the 31 archive columns rendered as strings
                (NULL -> '', delays with a fractional part, a few bad dates);
* airports      one per nation;
* stations      one per supplier, placed within +-0.7 deg of its nation's airport,
                with duplicates, inactive / foreign / sentinel / NULL-coordinate rows;
* weather_raw   one reading per lineitem for the supplier's station on the ship date
                (+24 years), strings with sentinels, NULLs and bad dates;
* scored        (model_type, label, p) from two fixed hash scores, with ties and p=0.

Each derived column is written ONCE as an SQL expression that Spark SQL and DuckDB
parse and evaluate identically (integer arithmetic, string concatenation, exact
double construction).  Spark applies the text with ``selectExpr``; the oracle
queries embed the very same text as CTEs (see ``cte_sql``).  The library's own
operators are DataFrame code and are *not* expressed through these snippets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.operators.clean import clean_flights
from ontime.sources.tables import read_table, spread


def _wban(k: str) -> str:
    # every 23rd station carries the "no WBAN" sentinel; keys ending in 1 share the
    # WBAN of the previous key (two rows of one physical station).
    return (f"CASE WHEN {k} % 23 = 5 THEN '99999' "
            f"ELSE CAST(10000 + {k} - (CASE WHEN {k} % 10 = 1 THEN 1 ELSE 0 END) AS STRING) END")


def _tenths(v: str) -> str:
    """Non-negative integer tenths -> 'i.f'."""
    return f"CAST(CAST(floor({v} / 10) AS INT) AS STRING) || '.' || CAST({v} % 10 AS STRING)"


_AP_LAT = "CAST(26 + ({n} % 5) * 5 AS DOUBLE)"
_AP_LON = "CAST(12 * (({n} - {n} % 5) / 5) - 120 AS DOUBLE)"
_FD = "CAST(CAST(l_shipdate AS DATE) + INTERVAL '24' YEAR AS DATE)"

# --- flights ---------------------------------------------------------------
FLIGHT_BASE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "s_nationkey", "c_nationkey",
    f"{_FD} AS fd",
    "CAST(l_quantity AS INT) AS q",
    "CASE WHEN (l_orderkey + l_partkey) % 50 = 0 THEN 1 ELSE 0 END AS is_cx",
    "CASE WHEN (l_orderkey + l_partkey) % 50 <> 0 AND (l_orderkey + l_suppkey) % 97 = 0 "
    "THEN 1 ELSE 0 END AS is_dv",
]
FLIGHT_MID = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "s_nationkey", "c_nationkey",
    "fd", "is_cx", "is_dv",
    "CASE WHEN is_cx = 0 AND is_dv = 0 THEN q * 2 - 40 END AS arr_d",
    "CASE WHEN is_cx = 0 THEN q * 2 - 37 - l_linenumber % 7 END AS dep_d",
    "(l_partkey % 24) * 100 + l_orderkey % 60 AS crs_dep",
    "((l_partkey % 24 + 2) % 24) * 100 + l_orderkey % 60 AS crs_arr",
    "5 + l_partkey % 30 AS taxi_o",
    "2 + l_suppkey % 15 AS taxi_i",
    "20 + l_partkey % 300 AS air_t",
]


def _cause(k: int) -> str:
    return ("CASE WHEN arr_d >= 15 AND l_linenumber <> 7 THEN "
            f"(CASE WHEN l_linenumber % 5 = {k} THEN CAST(arr_d AS STRING) ELSE '0' END) ELSE '' END")


FLIGHT_RAW = [
    "CASE WHEN l_orderkey % 1009 = 17 THEN '' "
    "WHEN l_orderkey % 1013 = 5 THEN CAST(year(fd) AS STRING) || '-' || CAST(month(fd) AS STRING)"
    " || '-' || CAST(day(fd) AS STRING) "
    "ELSE CAST(fd AS STRING) END AS FlightDate",
    "'C' || CAST(l_partkey % 12 AS STRING) AS Reporting_Airline",
    "'N' || CAST(100 + (l_suppkey * 7) % 1000 AS STRING) AS Tail_Number",
    "CAST(1 + l_orderkey % 9000 AS STRING) AS Flight_Number_Reporting_Airline",
    "'A' || CAST(s_nationkey AS STRING) AS Origin",
    "'S' || CAST(s_nationkey % 10 AS STRING) AS OriginState",
    "'A' || CAST(c_nationkey AS STRING) AS Dest",
    "'S' || CAST(c_nationkey % 10 AS STRING) AS DestState",
    "lpad(CAST(crs_dep AS STRING), 4, '0') AS CRSDepTime",
    "CASE WHEN is_cx = 0 THEN lpad(CAST(crs_dep AS STRING), 4, '0') ELSE '' END AS DepTime",
    "CASE WHEN is_cx = 0 THEN CAST(dep_d AS STRING) || '.' || lpad(CAST(l_partkey % 100 AS STRING), 2, '0')"
    " ELSE '' END AS DepDelay",
    "CASE WHEN is_cx = 0 THEN CAST(greatest(dep_d, 0) AS STRING) || '.00' ELSE '' END AS DepDelayMinutes",
    "CASE WHEN is_cx = 0 THEN (CASE WHEN dep_d >= 15 THEN '1.00' ELSE '0.00' END) ELSE '' END AS DepDel15",
    "CASE WHEN is_cx = 0 THEN CAST(taxi_o AS STRING) ELSE '' END AS TaxiOut",
    "CASE WHEN arr_d IS NOT NULL THEN CAST(taxi_i AS STRING) ELSE '' END AS TaxiIn",
    "lpad(CAST(crs_arr AS STRING), 4, '0') AS CRSArrTime",
    "CASE WHEN arr_d IS NOT NULL THEN lpad(CAST(crs_arr AS STRING), 4, '0') ELSE '' END AS ArrTime",
    "CASE WHEN arr_d IS NOT NULL THEN CAST(arr_d AS STRING) || '.' || lpad(CAST(l_suppkey % 100 AS STRING), 2, '0')"
    " ELSE '' END AS ArrDelay",
    "CASE WHEN arr_d IS NOT NULL THEN CAST(greatest(arr_d, 0) AS STRING) || '.00' ELSE '' END AS ArrDelayMinutes",
    "CASE WHEN arr_d IS NOT NULL THEN (CASE WHEN arr_d >= 15 THEN '1.00' ELSE '0.00' END) ELSE '' END AS ArrDel15",
    "CASE WHEN is_cx = 1 THEN '1.00' ELSE '0.00' END AS Cancelled",
    "CASE WHEN is_cx = 1 THEN substring('ABCD', CAST(1 + l_orderkey % 4 AS INT), 1) ELSE '' END AS CancellationCode",
    "CASE WHEN is_dv = 1 THEN '1.00' ELSE '0.00' END AS Diverted",
    "CASE WHEN arr_d IS NOT NULL THEN CAST(air_t + taxi_o + taxi_i AS STRING) ELSE '' END AS ActualElapsedTime",
    "CASE WHEN arr_d IS NOT NULL THEN CAST(air_t AS STRING) ELSE '' END AS AirTime",
    "CAST(100 + l_partkey % 2500 AS STRING) || '.00' AS Distance",
    f"{_cause(0)} AS CarrierDelay",
    f"{_cause(1)} AS WeatherDelay",
    f"{_cause(2)} AS NASDelay",
    f"{_cause(3)} AS SecurityDelay",
    f"{_cause(4)} AS LateAircraftDelay",
]

# --- airports / stations ----------------------------------------------------
AIRPORTS = [
    "'A' || CAST(n_nationkey AS STRING) AS faa_identifier",
    "n_name AS name",
    f"{_AP_LAT.format(n='n_nationkey')} AS latitude",
    f"{_AP_LON.format(n='n_nationkey')} AS longitude",
]

STATIONS_RAW = [
    f"{_wban('s_suppkey')} AS wban",
    "CAST(700000 + s_suppkey AS STRING) AS usaf",
    "CASE WHEN s_suppkey % 17 = 3 THEN 'CA' ELSE 'US' END AS country",
    f"CASE WHEN s_suppkey % 29 = 7 THEN NULL ELSE {_AP_LAT.format(n='s_nationkey')}"
    " + CAST((s_suppkey * 37) % 140 - 70 AS DOUBLE) / CAST(100 AS DOUBLE) END AS lat",
    f"{_AP_LON.format(n='s_nationkey')} + CAST((s_suppkey * 53) % 140 - 70 AS DOUBLE) / CAST(100 AS DOUBLE) AS lon",
    "CASE WHEN s_suppkey % 13 = 4 THEN '20181231' WHEN s_suppkey % 13 = 9 THEN '20190101' "
    "ELSE '2024' || lpad(CAST(1 + s_suppkey % 12 AS STRING), 2, '0') || '15' END AS `end`",
]

# --- daily weather ----------------------------------------------------------
WEATHER_BASE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    f"{_FD} AS fd",
    "CAST(l_quantity AS INT) AS q",
    "CAST(round(l_tax * 100) AS INT) AS tc",
    "CAST(round(l_discount * 100) AS INT) AS dc",
]
WEATHER_RAW = [
    "CAST(700000 + l_orderkey % 7 AS STRING) AS stn",
    f"{_wban('l_suppkey')} AS wban",
    "CASE WHEN l_orderkey % 307 = 1 THEN CAST(NULL AS STRING) ELSE CAST(year(fd) AS STRING) END AS year",
    "lpad(CAST(month(fd) AS STRING), 2, '0') AS mo",
    "CASE WHEN l_orderkey % 211 = 3 THEN '31' ELSE lpad(CAST(day(fd) AS STRING), 2, '0') END AS da",
    "CAST(l_partkey % 90 - 10 AS STRING) || '.' || CAST(l_suppkey % 10 AS STRING) AS temp",
    "CAST(l_partkey % 90 - 12 - l_linenumber * 2 AS STRING) || '.5' AS dewp",
    "CAST(980 + l_orderkey % 60 AS STRING) || '.1' AS slp",
    f"CASE WHEN tc = 0 THEN CAST(NULL AS STRING) WHEN l_orderkey % 43 = 0 THEN '999.9' ELSE {_tenths('tc * 15')} END AS visib",
    f"CASE WHEN l_orderkey % 41 = 0 THEN '999.9' WHEN l_orderkey % 89 = 2 THEN CAST(NULL AS STRING) "
    f"ELSE {_tenths('q * 8')} END AS wdsp",
    f"{_tenths('q * 8 + 50')} AS mxpsd",
    f"CASE WHEN l_partkey % 3 = 0 THEN {_tenths('q * 12')} ELSE '999.9' END AS gust",
    "CAST(l_partkey % 90 AS STRING) || '.0' AS max",
    "CAST(l_partkey % 90 - 20 AS STRING) || '.0' AS min",
    f"CASE WHEN l_partkey % 53 = 0 THEN '99.99' WHEN l_partkey % 59 = 1 THEN CAST(NULL AS STRING) "
    f"WHEN dc < 3 THEN '0.00' ELSE {_tenths('dc')} END AS prcp",
    "'999.9' AS sndp",
    "CAST(l_partkey % 2 AS STRING) AS fog",
    "CAST(l_suppkey % 2 AS STRING) AS rain_drizzle",
    "CAST(l_orderkey % 2 AS STRING) AS snow_ice_pellets",
    "CAST((l_partkey + l_suppkey) % 2 AS STRING) AS hail",
    "CAST((l_orderkey + l_partkey) % 2 AS STRING) AS thunder",
    "'0' AS tornado_funnel_cloud",
]

# --- deterministic scores for the evaluation operators ----------------------
SCORED = {
    "score_a": ["CASE WHEN l_quantity >= 28 THEN 1 ELSE 0 END AS label",
                "CAST((l_orderkey * 31 + l_partkey * 17 + CAST(l_quantity AS INT) * 7) % 1000 AS DOUBLE)"
                " / CAST(1000 AS DOUBLE) AS p"],
    "score_b": ["CASE WHEN l_quantity >= 28 THEN 1 ELSE 0 END AS label",
                "CAST((CAST(l_quantity AS INT) * 19 + l_suppkey % 7 + l_orderkey % 11) % 1000 AS DOUBLE)"
                " / CAST(1000 AS DOUBLE) AS p"],
}


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _lineitem_joined(spark: SparkSession, d: str) -> DataFrame:
    li = spread(read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"), "l_orderkey")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    cu = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(cu, F.col("o_custkey") == F.col("c_custkey")))


def raw_flights(spark: SparkSession, d: str) -> DataFrame:
    """The 31 archive columns as strings, one row per lineitem."""
    return (_lineitem_joined(spark, d).selectExpr(*FLIGHT_BASE)
            .selectExpr(*FLIGHT_MID).selectExpr(*FLIGHT_RAW))


def flights(spark: SparkSession, d: str) -> DataFrame:
    """``flights_clean``: the raw rendering passed through the cleaning operator."""
    return clean_flights(raw_flights(spark, d))


def airports_raw(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "nation").selectExpr(*AIRPORTS)


def stations_raw(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "supplier").selectExpr(*STATIONS_RAW)


def weather_raw(spark: SparkSession, d: str) -> DataFrame:
    li = spread(read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_discount", "l_shipdate"),
        "l_orderkey")
    return li.selectExpr(*WEATHER_BASE).selectExpr(*WEATHER_RAW)


def scored(spark: SparkSession, d: str) -> DataFrame:
    """(model_type, label, p) for two fixed scorers over every lineitem."""
    li = spread(read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity"), "l_orderkey")
    parts = [li.selectExpr(f"'{name}' AS model_type", *exprs) for name, exprs in SCORED.items()]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# DuckDB side: the same expressions as CTE text
# ---------------------------------------------------------------------------
def _sel(exprs: list[str]) -> str:
    return ",\n    ".join(e.replace("`end`", '"end"') for e in exprs)


_CTES: dict[str, tuple[str, list[str]]] = {
    "tb_li": ("SELECT l.*, o.o_custkey, s.s_nationkey, c.c_nationkey FROM lineitem l "
              "JOIN orders o ON l.l_orderkey = o.o_orderkey "
              "JOIN supplier s ON l.l_suppkey = s.s_suppkey "
              "JOIN customer c ON o.o_custkey = c.c_custkey", []),
    "tb_raw_flights": (
        f"SELECT {_sel(FLIGHT_RAW)} FROM (SELECT {_sel(FLIGHT_MID)} FROM "
        f"(SELECT {_sel(FLIGHT_BASE)} FROM tb_li) b1) b2", ["tb_li"]),
    "tb_airports": (f"SELECT {_sel(AIRPORTS)} FROM nation", []),
    "tb_stations_raw": (f"SELECT {_sel(STATIONS_RAW)} FROM supplier", []),
    "tb_weather_raw": (f"SELECT {_sel(WEATHER_RAW)} FROM (SELECT {_sel(WEATHER_BASE)} FROM lineitem) w1", []),
    "tb_scored": (" UNION ALL ".join(f"SELECT '{n}' AS model_type, {_sel(e)} FROM lineitem"
                                     for n, e in SCORED.items()), []),
}


def register_cte(name: str, sql: str, deps: list[str]) -> None:
    _CTES[name] = (sql, deps)


def cte_sql(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n  {_CTES[n][0]}\n)" for n in order) + "\n" + body
