"""Registered queries for sources and sinks: partitioned writes read back (S10-S12),
ZIP-of-CSV ingest (S1-S5) with its status output (S3), and incremental streaming
ingest (S15).  Inputs are written from the supplied tables into a fresh folder under
the session's shared checkpoint directory; the results are read back from storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ontime.operators.clean import clean_flights
from ontime.plans import chain
from ontime.plans.oracles import cte_sql, flights_sql
from ontime.plans.registry import register
from ontime.schema import AIRPORT_STATION_COLUMNS, CLEAN_COLUMNS, ENRICHED_COLUMNS
from ontime.session import shared_dir
from ontime.sources import sinks, zipcsv
from ontime.sources import testbed as tb
from ontime.streaming.incremental import ingest_new_archives, read_ingested

_CLEAN_SQL = flights_sql(f"SELECT {', '.join(CLEAN_COLUMNS)} FROM tb_flights")


@register("clean_roundtrip", _CLEAN_SQL, "io")
def q_clean_roundtrip(spark, d):
    path = shared_dir(spark, "flights_clean")
    sinks.write_clean(tb.flights(spark, d), path)
    return sinks.read_clean(spark, path)


@register("lookup_roundtrip", cte_sql("SELECT iata, station_id, distance_km FROM tb_map", "tb_map"), "io")
def q_lookup_roundtrip(spark, d):
    path = shared_dir(spark, "airport_station")
    sinks.write_lookup(chain.mapping(spark, d), path)
    return spark.read.parquet(path).select(*AIRPORT_STATION_COLUMNS)


@register("fact_roundtrip", cte_sql(f"SELECT {', '.join(ENRICHED_COLUMNS)} FROM tb_enriched", "tb_enriched"), "io")
def q_fact_roundtrip(spark, d):
    path = shared_dir(spark, "flights_weather_enriched")
    sinks.write_fact(chain.facts(spark, d), path)
    return sinks.read_fact(spark, path)


_ARCHIVES: dict[tuple[str, str], str] = {}


def archives(spark, d) -> str:
    """Monthly archives rendered from the supplied tables, written once per
    application (the ingest keys then measure reading them)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _ARCHIVES:
        root = shared_dir(spark, "raw_flights")
        zipcsv.write_zip_archives(tb.raw_flights(spark, d), root).count()
        _ARCHIVES[key] = root
    return _ARCHIVES[key]


@register("zip_csv_ingest", _CLEAN_SQL, "io")
def q_zip_csv_ingest(spark, d):
    return clean_flights(zipcsv.read_zip_csv(spark, archives(spark, d)))


_MONTH = "substr(coalesce(FlightDate, ''), 6, 2)"


def by_directory_sql(columns: str) -> str:
    """Oracle over (year, month, rows) of the directories that the archives lie in."""
    return cte_sql(
        f"SELECT year, month, {columns} FROM ("
        "SELECT CASE WHEN regexp_full_match(substr(coalesce(FlightDate, ''), 1, 4), '[0-9]{4}') "
        "THEN substr(FlightDate, 1, 4) ELSE 'unknown' END AS year, "
        f"CASE WHEN regexp_full_match({_MONTH}, '[0-9]+') THEN CAST(CAST({_MONTH} AS INTEGER) AS VARCHAR) "
        "ELSE 'unknown' END AS month, CAST(count(*) AS BIGINT) AS rows FROM tb_raw_flights GROUP BY 1, 2) d", "tb_raw_flights")


@register("archive_status", by_directory_sql("rows, CAST(0 AS BIGINT) AS errors"), "io")
def q_archive_status(spark, d):
    """S3 by directory (how many archives a month has depends on the input's partitions)."""
    part = [F.regexp_extract("path", f"{k}=([^/]*)/", 1).alias(k) for k in ("year", "month")]
    return zipcsv.archive_status(spark, archives(spark, d)).groupBy(*part).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("error").isNotNull()).alias("errors"))


@register("incremental_ingest", _CLEAN_SQL, "io")
def q_incremental_ingest(spark, d):
    root = archives(spark, d)
    out, ckpt = shared_dir(spark, "ingested"), shared_dir(spark, "ingest_checkpoint")
    ingest_new_archives(spark, root, out, ckpt)
    ingest_new_archives(spark, root, out, ckpt)   # a re-run finds nothing new
    return read_ingested(spark, out)


@register("archive_totals", cte_sql(
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS corrupt_archives FROM tb_raw_flights",
    "tb_raw_flights"), "io")
def q_archive_totals(spark, d):
    """S3 totals: every rendered flight is read back from some archive; none is corrupt."""
    st = zipcsv.archive_status(spark, archives(spark, d))
    return st.agg(F.sum("rows").cast("bigint").alias("rows"),
                  F.count_if(F.col("error").isNotNull()).alias("corrupt_archives"))
