"""Batch jobs: the job-level entry points, in their run order.

    clean   archives (year=/month=/*.zip)      -> flights_clean (year=/month= Parquet) + archive status and counts
            (--incremental: new and replaced archives only)
    map     airports + stations tables         -> airport_station lookup
    enrich  flights_clean + lookup + weather   -> flights_weather_enriched (day-partitioned)
    tables  enriched fact                      -> the five dashboard view tables (S13/S14)
    reports enriched fact                      -> the five ad-hoc reports (A1-A5)
    models  enriched fact                      -> m_model_comparison, m_eval_metrics,
                                                  m_confusion_matrix, m_feature_importance (S14)
    run     all of them in this order

Every job reads its inputs from storage and writes its outputs to storage, so the jobs
can run as separate ``spark-submit`` steps.  Example:

    python -m ontime.plans.jobs clean --raw <archives> --out <root>
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.ml import evaluate as ev
from ontime.ml import explain, features, models
from ontime.operators.clean import clean_flights
from ontime.operators.enrich import enrich
from ontime.operators.geo import airport_station_map
from ontime.operators.weather import load_weather
from ontime.plans import reports, views
from ontime.session import BASE_CONF, shared_dir
from ontime.sources import sinks, zipcsv
from ontime.sources.catalog import remove, replace_table, table_family
from ontime.sources.tables import read_source
from ontime.streaming.ledger import sync_archives


@dataclass
class Config:
    """All that the jobs can be told; tables are Parquet paths, catalog names or DataFrames."""
    out: str
    raw: str | None = None
    airports: str | DataFrame | None = None
    stations: str | DataFrame | None = None
    weather: str | DataFrame | None = None
    max_km: float = 50.0
    box_deg: float = 0.75
    active_since: str = "20190101"
    mode: str = "box"
    start_year: int = 2019
    end_year: int = 2025
    min_flights: int = 50_000
    cutoff: str = features.CUTOFF
    boosted_params: dict = field(default_factory=dict)
    as_of: dt.datetime | None = None
    incremental: bool = False
    named: bool = False


def clean_job(spark: SparkSession, raw_root: str, out_root: str, months: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Archives -> ``<out>/flights_clean``, ``<out>/archive_status`` and ``<out>/clean_counts``; returns the
    status.  Every archive is opened once: the tasks that read rows leave the status too.  The counts (archives,
    faulty ones, rows read, rows written) come from that status and from the footers of the written files, which
    hold for the tasks that were committed (an observed metric may count a repeated task twice).
    ``months``: only these months' directories are read and rewritten."""
    left_at = shared_dir(spark, "archive-status")
    raw = zipcsv.read_zip_csv(spark, raw_root, months=months, status_to=left_at)
    sinks.write_clean(clean_flights(raw), f"{out_root}/flights_clean", dynamic=months is not None)
    sinks.write_table(zipcsv.read_status(spark, left_at), f"{out_root}/archive_status")
    remove(spark, left_at)
    status = spark.read.parquet(f"{out_root}/archive_status")
    rows = spark.read.parquet(f"{out_root}/flights_clean").count()
    sinks.write_table(status.agg(
        F.count(F.lit(1)).alias("archives"), F.count("error").alias("faulty"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"), F.lit(rows).cast("long").alias("rows_written")),
        f"{out_root}/clean_counts")
    return status


def sync_job(spark: SparkSession, raw_root: str, out_root: str) -> dict[str, int]:
    """Brings ``<out>/flights_clean`` up to the archives, reading new and replaced ones only
    (``<out>/archive_ledger`` knows the others)."""
    return sync_archives(spark, raw_root, f"{out_root}/flights_clean", f"{out_root}/archive_ledger")


def map_job(spark: SparkSession, airports: str | DataFrame, stations: str | DataFrame, out_root: str,
            max_km: float = 50.0, box_deg: float = 0.75, active_since: str = "20190101",
            mode: str = "box") -> int:
    """-> ``<out>/airport_station``; returns the number of airports with a station."""
    m = airport_station_map(read_source(spark, airports), read_source(spark, stations), max_km, box_deg,
                            active_since, mode)
    return sinks.write_lookup(m, f"{out_root}/airport_station")


def enrich_job(spark: SparkSession, weather: str | DataFrame, out_root: str, start_year: int = 2019,
               end_year: int = 2025) -> None:
    """flights_clean + lookup + daily weather -> ``<out>/flights_weather_enriched``.  ``weather``: one table, or
    ``<prefix>*`` for the catalog's yearly tables ``<prefix><year>``, of which none may be missing."""
    flights = sinks.read_clean(spark, f"{out_root}/flights_clean")
    mapping = spark.read.parquet(f"{out_root}/airport_station")
    if isinstance(weather, str) and weather.endswith("*"):
        family = table_family(spark, weather[:-1], start_year, end_year)
        if family.missing:
            raise ValueError(f"no table {family.prefix}<year> for {family.missing}")
        weather = family.read(spark)
    wx = load_weather(read_source(spark, weather), start_year, end_year)
    sinks.write_fact(enrich(flights, mapping, wx), f"{out_root}/flights_weather_enriched")


def tables_job(spark: SparkSession, out_root: str, airports: str | DataFrame, named: bool = False) -> list[str]:
    """The dashboard views materialised as tables (what a BI tool reads); ``named``: also under their names
    in the catalog, each replaced as a whole."""
    fact = sinks.read_fact(spark, f"{out_root}/flights_weather_enriched")
    out = {"v_monthly_ontime_trend": views.monthly_ontime_trend(fact),
           "v_delay_cause_breakdown": views.delay_cause_breakdown(fact),
           "v_airport_delay_heatmap": views.airport_heatmap(fact, read_source(spark, airports)),
           "v_weather_correlation": views.weather_correlation(fact),
           "v_airline_kpi": views.airline_kpi(fact)}
    for name, df in out.items():
        sinks.write_table(df, f"{out_root}/{name}")
        if named:
            replace_table(spark.read.parquet(f"{out_root}/{name}"), name, f"{out_root}/named")
    return list(out)


def reports_job(spark: SparkSession, out_root: str, min_flights: int = 50_000) -> list[str]:
    """The ad-hoc reports written as tables."""
    fact = sinks.read_fact(spark, f"{out_root}/flights_weather_enriched")
    out = {"r_headline": reports.headline(fact), "r_yearly_impact": reports.yearly_impact(fact),
           "r_worst_airports": reports.worst_airports(fact, min_flights),
           "r_wind_vs_calm": reports.wind_vs_calm(fact), "r_delay_causes": reports.delay_causes_total(fact)}
    for name, df in out.items():
        sinks.write_table(df, f"{out_root}/{name}")
    return list(out)


def models_job(spark: SparkSession, out_root: str, cutoff: str = features.CUTOFF,
               boosted_params: dict | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Train both classifiers before ``cutoff``, evaluate on the rest, write the m_* tables."""
    fact = sinks.read_fact(spark, f"{out_root}/flights_weather_enriched")
    train, hold = features.training_set(fact, cutoff), features.holdout_set(fact, cutoff)
    rows = models.prepared(train)       # staged once, read by both fits
    fitted = {models.LOGISTIC: models.fit_logistic(rows),
              models.BOOSTED: models.fit_boosted(rows, **(boosted_params or {}))}
    for kind, m in fitted.items():
        m.write().overwrite().save(f"{out_root}/model_{kind}")
    parts = [models.score(m, hold, kind) for kind, m in fitted.items()]
    scored, _ = sinks.stage_table(parts[0].unionByName(parts[1]), "holdout_scores")
    eligible = features.holdout_set(fact, cutoff, keep=("flight_date",))
    window = ev.holdout_window_text(eligible).first()["holdout_window"] or ""
    comparison = ev.model_comparison(scored)
    sinks.write_table(comparison, f"{out_root}/m_model_comparison")
    sinks.write_table(ev.eval_metrics(spark.read.parquet(f"{out_root}/m_model_comparison"), window, as_of),
                      f"{out_root}/m_eval_metrics")
    sinks.write_table(ev.confusion_long(scored, ["model_type"]), f"{out_root}/m_confusion_matrix")
    sinks.write_table(explain.feature_importance(spark, fitted, train), f"{out_root}/m_feature_importance")
    return spark.read.parquet(f"{out_root}/m_model_comparison")


JOBS = {
    "clean": lambda s, c: sync_job(s, c.raw, c.out) if c.incremental else clean_job(s, c.raw, c.out),
    "map": lambda s, c: map_job(s, c.airports, c.stations, c.out, c.max_km, c.box_deg, c.active_since, c.mode),
    "enrich": lambda s, c: enrich_job(s, c.weather, c.out, c.start_year, c.end_year),
    "tables": lambda s, c: tables_job(s, c.out, c.airports, c.named),
    "reports": lambda s, c: reports_job(s, c.out, c.min_flights),
    "models": lambda s, c: models_job(s, c.out, c.cutoff, c.boosted_params, c.as_of),
}


def run(spark: SparkSession, config: Config) -> dict[str, object]:
    """The whole chain, each job from storage to storage; returns what each job returned."""
    return {name: job(spark, config) for name, job in JOBS.items()}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ontime-jobs", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=[*JOBS, "run"])
    defaults = Config(out="")
    for f in fields(Config):
        value = getattr(defaults, f.name)
        option = "--" + f.name.replace("_", "-")
        if isinstance(value, bool):
            p.add_argument(option, action="store_true")
            continue
        kind = {"boosted_params": json.loads, "as_of": dt.datetime.fromisoformat}.get(f.name)
        kind = kind or (type(value) if value not in (None, "") else str)
        p.add_argument(option, type=kind, default=value, required=f.name == "out")
    a = vars(p.parse_args(argv))
    job = a.pop("job")
    builder = SparkSession.builder.appName(f"ontime-{job}")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    print((run if job == "run" else JOBS[job])(spark, Config(**a)))


if __name__ == "__main__":
    main()
