"""Registered queries for named tables (S13, S14), the clustered catalog form (S12), archives with
faults and the counts of the clean job (S3, A13), and ingest with a ledger (S15)."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ontime.operators.enrich import attach_stations
from ontime.operators.weather import dedupe_weather
from ontime.plans import chain, jobs, queries_flights, queries_geo, queries_io, views  # noqa: F401  their keys are read here
from ontime.plans.oracles import cte_sql
from ontime.plans.registry import REGISTRY, register
from ontime.schema import CLEAN_COLUMNS
from ontime.session import shared_dir
from ontime.sources import catalog, zipcsv
from ontime.sources import testbed as tb
from ontime.sources.sinks import stage_table
from ontime.streaming.ledger import read_table, sync_archives

# ---- S13 / S14: the dashboard tables under their names, read with SQL ---------------------------------


def _published(spark, d, view: str, build) -> str:
    """The name of a table that was made empty, replaced by the view's rows, and then met a write
    that breaks."""
    name, root = f"t_{view}", shared_dir(spark, "named")
    catalog.replace_table(build(chain.facts(spark, d).limit(0)), name, root)
    whole = chain.staged(spark, d, f"view-{view}", lambda: build(chain.facts(spark, d)))   # written twice
    catalog.replace_table(whole, name, root)
    try:
        catalog.replace_table(whole.withColumn("broken", F.raise_error(F.lit("broken"))), name, root)
    except Exception as e:  # noqa: BLE001  the engine's own exception types differ
        if "broken" not in str(e):
            raise
    return name


def _register_named(view: str, build) -> None:
    @register(f"{view}_named", REGISTRY[view].sql, "views")
    def q_named(spark, d):
        return spark.sql(f"SELECT * FROM {_published(spark, d, view, lambda fact: build(spark, d, fact))}")


_register_named("monthly_ontime_trend", lambda spark, d, fact: views.monthly_ontime_trend(fact))
_register_named("delay_cause_breakdown", lambda spark, d, fact: views.delay_cause_breakdown(fact))
_register_named("weather_correlation", lambda spark, d, fact: views.weather_correlation(fact))
_register_named("airport_heatmap", lambda spark, d, fact: views.airport_heatmap(fact, tb.airports_raw(spark, d)))


# ---- S12: two clustered tables, joined without a shuffle --------------------------------------------
BUCKETS = 16


@register("clustered_join", cte_sql(
    "SELECT f.origin_station, CAST(count(*) AS BIGINT) AS flights, CAST(sum(f.is_delayed_15) AS BIGINT) AS delayed, "
    "CAST(count(w.temp) AS BIGINT) AS with_temp FROM tb_fs f JOIN tb_wx w "
    "ON w.station_id = f.origin_station AND w.weather_date = f.flight_date GROUP BY 1", "tb_fs", "tb_wx"), "io")
def q_clustered_join(spark, d):
    root = shared_dir(spark, "clustered")
    tag = root.rsplit("-", 1)[1]
    mapping, _ = stage_table(chain.mapping(spark, d), "airport_station")
    flights = attach_stations(tb.flights(spark, d), mapping).where(F.col("origin_station").isNotNull())
    weather = dedupe_weather(chain.weather(spark, d)).select(
        F.col("station_id").alias("origin_station"), F.col("weather_date").alias("flight_date"), "temp")
    keys = ["origin_station", "flight_date"]
    f = catalog.save_clustered(flights.select(*keys, "is_delayed_15"), f"flights_{tag}", f"{root}/flights", keys, BUCKETS)
    w = catalog.save_clustered(weather, f"weather_{tag}", f"{root}/weather", keys, BUCKETS)
    return catalog.join_clustered(f, w, keys).groupBy("origin_station").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("is_delayed_15").alias("delayed"), F.count("temp").alias("with_temp"))


# ---- S3 / A13: archives with faults through the clean job ---------------------------------------------
def _spoil(content: bytes) -> bytes:
    """The archive with a wrong checksum in the directory entry of its last member."""
    at = content.rfind(b"PK\x01\x02") + 16
    crc = struct.unpack_from("<I", content, at)[0] ^ 1
    return content[:at] + struct.pack("<I", crc) + content[at + 4:]


def _write_faulty(spark, d, root: str) -> None:
    """The test bed's archives again; those of January have wrong checksums, and beside each of
    February's lies its first half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = zipcsv.filesystem(root)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                year, month, name = path.rsplit("/", 3)[1:]
                out = {name: content.as_py()}
                if month == "month=1":
                    out[name] = _spoil(out[name])
                if month == "month=2":
                    out[f"half-{name}"] = out[name][:len(out[name]) // 2]
                fs.create_dir(f"{base}/{year}/{month}", recursive=True)
                for file, data in out.items():
                    with fs.open_output_stream(f"{base}/{year}/{month}/{file}") as f:
                        f.write(data)
                yield pa.RecordBatch.from_pydict({"path": [path]})

    zipcsv.list_archives(spark, queries_io.archives(spark, d)).select("path", "content").mapInArrow(run, "path string").count()


def _cleaned(spark, d) -> str:
    """The output folder of a clean job over archives with faults, run once per application.  These archives
    are read by that job alone, so they go when it has ended."""
    def build(out: str) -> None:
        raw = shared_dir(spark, "raw_faulty")
        _write_faulty(spark, d, raw)
        jobs.clean_job(spark, raw, out)
        catalog.remove(spark, raw)

    return chain.staged_path(spark, d, "cleaned_faulty", build)


@register("faulty_archives", queries_io.by_directory_sql(
    "rows, year <> 'unknown' AND month IN ('1', '2') AS has_fault"), "io")
def q_faulty_archives(spark, d):
    """S3: rows kept and faults named, by directory, as the clean job's one read has left them."""
    status = spark.read.parquet(f"{_cleaned(spark, d)}/archive_status")
    part = [F.regexp_extract("path", f"{k}=([^/]*)/", 1).alias(k) for k in ("year", "month")]
    return status.groupBy(*part).agg(F.sum("rows").alias("rows"), (F.count("error") > 0).alias("has_fault"))


@register("clean_job_counts", cte_sql(
    "SELECT (SELECT CAST(count(*) AS BIGINT) FROM tb_raw_flights) AS rows_read, "
    "(SELECT CAST(count(*) AS BIGINT) FROM tb_flights) AS rows_written", "tb_raw_flights", "tb_flights"), "io")
def q_clean_job_counts(spark, d):
    """Rows read and written by the clean job over archives with faults."""
    return spark.read.parquet(f"{_cleaned(spark, d)}/clean_counts").select("rows_read", "rows_written")


@register("lookup_count", cte_sql("SELECT CAST(count(*) AS BIGINT) AS airports FROM tb_map", "tb_map"), "io")
def q_lookup_count(spark, d):
    """The count that the map job returns."""
    n = jobs.map_job(spark, tb.airports_raw(spark, d), tb.stations_raw(spark, d), shared_dir(spark, "map_job"))
    return spark.range(1).select(F.lit(n).cast("long").alias("airports"))


# ---- S15: three runs with a ledger ----------------------------------------------------------------------
@register("ledger_ingest", REGISTRY["incremental_ingest"].sql, "io")
def q_ledger_ingest(spark, d):
    """Some rows of every archive first; then the whole archives under the same names; then nothing new."""
    root, out, ledger = shared_dir(spark, "raw_ledger"), shared_dir(spark, "ledger_out"), shared_dir(spark, "ledger")
    raw = tb.raw_flights(spark, d)
    some = F.pmod(F.xxhash64("FlightDate", "Flight_Number_Reporting_Airline"), F.lit(3)) > 0
    for rows in (raw.where(some), raw):
        zipcsv.write_zip_archives(rows, root).count()
        sync_archives(spark, root, out, ledger)
    sync_archives(spark, root, out, ledger)
    return read_table(spark, out).select(*CLEAN_COLUMNS)


# ---- §2.11: the jobs one after the other, from storage to storage -----------------------------------------
@register("jobs_chain", REGISTRY["weather_correlation"].sql, "io")
def q_jobs_chain(spark, d):
    """Clean (over archives with faults), map, enrich and tables; the weather view's table is read back."""
    out = _cleaned(spark, d)
    jobs.map_job(spark, tb.airports_raw(spark, d), tb.stations_raw(spark, d), out)
    jobs.enrich_job(spark, tb.weather_raw(spark, d), out, chain.START_YEAR, chain.END_YEAR)
    jobs.tables_job(spark, out, tb.airports_raw(spark, d))
    return spark.read.parquet(f"{out}/v_weather_correlation")
