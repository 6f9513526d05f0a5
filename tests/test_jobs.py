import pytest
from pyspark.sql import functions as F

from ontime.plans import jobs
from ontime.sources import testbed as tb
from ontime.sources import catalog, zipcsv

D = "/root/testdata/sf0.001"


def test_the_whole_chain_in_one_call(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    zipcsv.write_zip_archives(tb.raw_flights(spark, D), raw).count()
    done = jobs.run(spark, jobs.Config(
        out, raw, tb.airports_raw(spark, D), tb.stations_raw(spark, D), tb.weather_raw(spark, D), min_flights=10,
        boosted_params={"maxIter": 3, "maxDepth": 3}))
    assert list(done) == ["clean", "map", "enrich", "tables", "reports", "models"]
    assert done["clean"].filter(F.col("error").isNotNull()).count() == 0
    n_flights = spark.read.parquet(f"{out}/flights_clean").count()
    assert n_flights == tb.flights(spark, D).count()
    assert done["map"] == spark.read.parquet(f"{out}/airport_station").count() > 0
    assert spark.read.parquet(f"{out}/flights_weather_enriched").count() == n_flights
    assert len(done["tables"]) == 5 and len(done["reports"]) == 5
    assert spark.read.parquet(f"{out}/r_headline").first().total_flights == n_flights
    assert 0 < spark.read.parquet(f"{out}/r_worst_airports").count() <= 10
    assert {r.model_type for r in done["models"].collect()} == {"logistic_regression", "boosted_tree"}
    assert spark.read.parquet(f"{out}/m_confusion_matrix").count() == 8
    assert spark.read.parquet(f"{out}/m_feature_importance").count() == 22
    assert spark.read.parquet(f"{out}/m_eval_metrics").first().holdout_window.startswith("2025-")


def test_command_line_knows_every_parameter(monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "JOBS", {"map": lambda spark, c: seen.update(vars(c))})
    jobs.main(["map", "--out", "o", "--max-km", "30", "--end-year", "2024", "--boosted-params", '{"maxIter": 2}',
               "--as-of", "2026-01-01T00:00:00"])
    assert seen["max_km"] == 30.0 and seen["end_year"] == 2024 and seen["cutoff"] == "2025-01-01"
    assert seen["boosted_params"] == {"maxIter": 2} and seen["as_of"].year == 2026


def spring(rows, date="FlightDate"):
    return rows.where(F.col(date).cast("string").like("2020-0%"))


def test_clean_job_reads_each_archive_once_and_by_month(spark, scratch, monkeypatch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    rows = spring(tb.raw_flights(spark, D))
    zipcsv.write_zip_archives(rows, raw).count()
    status = jobs.clean_job(spark, raw, out)
    counts = spark.read.parquet(f"{out}/clean_counts").first()
    assert counts.archives == status.count() and counts.faulty == 0
    assert counts.rows_read == rows.count()
    assert counts.rows_written == spring(tb.flights(spark, D), 'flight_date').count()
    before = spark.read.parquet(f"{out}/flights_clean").groupBy("year", "month").count().collect()
    jobs.clean_job(spark, raw, out, months=[(2020, 3)])         # rewrites that month, leaves the others
    assert sorted(spark.read.parquet(f"{out}/flights_clean").groupBy("year", "month").count().collect()) == sorted(before)
    assert all("/year=2020/month=3/" in r.path for r in spark.read.parquet(f"{out}/archive_status").collect())


def test_yearly_weather_by_name_and_named_tables(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    rows = spring(tb.raw_flights(spark, D))
    zipcsv.write_zip_archives(rows, raw).count()
    config = jobs.Config(out, raw, tb.airports_raw(spark, D), tb.stations_raw(spark, D), incremental=True, named=True)
    assert jobs.JOBS["clean"](spark, config)["archives"] > 0
    assert jobs.JOBS["clean"](spark, config)["archives"] == 0
    jobs.JOBS["map"](spark, config)
    weather = tb.weather_raw(spark, D)
    for y in range(2019, 2025):
        catalog.replace_table(weather.where(F.col("year") == str(y)), f"jobs_wx{y}", scratch)
    with pytest.raises(ValueError, match=r"\[2025\]"):
        jobs.enrich_job(spark, "jobs_wx*", out)
    jobs.enrich_job(spark, "jobs_wx*", out, end_year=2024)
    whole = spark.read.parquet(f"{out}/flights_weather_enriched")
    assert whole.count() == spring(tb.flights(spark, D), 'flight_date').count() and whole.where("origin_temp IS NOT NULL").count() > 0
    jobs.tables_job(spark, out, tb.airports_raw(spark, D), named=True)
    spark.catalog.dropTempView("v_airline_kpi")
    assert spark.sql("SELECT sum(flights) AS n FROM v_airline_kpi").first().n == whole.count()


def test_the_chain_leaves_no_faulty_archives_behind(spark):
    import glob

    from ontime.plans import queries_tables
    from ontime.session import shared_root

    sf = "/root/testdata/sf0.001"
    assert queries_tables.q_jobs_chain(spark, sf).count() > 0
    status = spark.read.parquet(f"{queries_tables._cleaned(spark, sf)}/archive_status")
    assert status.where("error IS NOT NULL").count() > 0        # they were there and were read
    assert not glob.glob(f"{shared_root(spark).removeprefix('file:')}/ontime/raw_faulty-*")
