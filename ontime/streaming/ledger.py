"""S15 with a ledger: archives are ingested by what they are, not by their name alone.

The ledger has a row for each archive version ever ingested: path, modification time, length, the
months its rows fall into, rows and error.  A run anti-joins the listing with it, so it reads archives
that are new or were *replaced* under their name, and no others.  Rows carry their archive's path; the
months that new rows fall into, or that a replaced archive's rows fell into, are rewritten: the kept
rows of other archives and the fresh ones are staged, then put in place by dynamic partition
overwrite, and months left without rows are removed.  The run's ledger rows are written last.

A run that is lost before that changes nothing in the ledger, so the next one finds the same archives
and rewrites the same months: no row twice, none lost.  A run repeated under a ``batch_id`` that the
ledger has does nothing.  Only one run at a time may write a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators.clean import clean_flights
from ontime.operators.joins import bounded_broadcast
from ontime.schema import CLEAN_COLUMNS, clean_schema
from ontime.session import shared_dir
from ontime.sources import zipcsv
from ontime.sources.catalog import exists, remove
from ontime.sources.sinks import write_clean

ARCHIVE = "_archive"
VERSION = ["path", "modificationTime", "length"]
LEDGER_SCHEMA = ("path string, modificationTime timestamp, length long, months array<struct<year int, month int>>, "
                 "rows long, error string, batch string, ingested_at timestamp")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All versions ever ingested."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def current(ledger: DataFrame) -> DataFrame:
    """The version of each archive that the table holds."""
    row = F.struct(*[c for c in ledger.columns if c != "path"])
    return (ledger.groupBy("path").agg(F.max_by(row, F.struct("ingested_at", "batch")).alias("_v"))
            .select("path", "_v.*"))


def _table_schema() -> T.StructType:
    return T.StructType([*clean_schema().fields, T.StructField(ARCHIVE, T.StringType())])


def read_table(spark: SparkSession, out: str) -> DataFrame:
    """The ingested flights with the archive that each came from."""
    if not exists(spark, out):
        return spark.createDataFrame([], _table_schema())
    return spark.read.schema(_table_schema()).parquet(out).select(*CLEAN_COLUMNS, ARCHIVE)


def _months(rows: DataFrame) -> set[tuple[int, int]]:
    return {(r["year"], r["month"]) for r in rows.select("year", "month").distinct().collect()}


def sync_archives(spark: SparkSession, raw_root: str, out: str, ledger: str, glob: str = "*.zip",
                  batch_id: str | None = None) -> dict[str, int]:
    """Bring ``out`` (``year=/month=`` Parquet) up to the archives below ``raw_root``; returns the
    number of archives read, of those replaced, and of the months rewritten and removed."""
    done = read_ledger(spark, ledger)
    batch = batch_id or uuid.uuid4().hex
    nothing = {"archives": 0, "replaced": 0, "months": 0, "removed": 0}
    if batch_id is not None and done.where(F.col("batch") == batch_id).limit(1).count():
        return nothing
    held = current(done)
    listed = zipcsv.list_archives(spark, raw_root, glob)
    news_at = shared_dir(spark, "ledger-news")
    listed.select(*VERSION).join(held.select(*VERSION), VERSION, "left_anti").write.parquet(news_at)
    news = spark.read.parquet(news_at)
    count = news.count()
    if not count:
        return nothing

    # the rows and the status of the new versions, in one read
    fresh_at, status_at = shared_dir(spark, "ledger-rows"), shared_dir(spark, "ledger-status")
    raw = zipcsv.scan_archives(news, status_to=status_at, path_as=ARCHIVE)
    # staged as it comes: only the table is sorted into directories, so a task leaves one file here, not one a month
    clean_flights(raw, carry=[ARCHIVE]).write.parquet(fresh_at)
    fresh = spark.read.schema(_table_schema()).parquet(fresh_at).select(*CLEAN_COLUMNS, ARCHIVE)
    replaced = held.join(news.select("path"), "path", "left_semi")
    before = _months(replaced.select(F.explode("months").alias("m")).select("m.*"))
    touched = sorted(_months(fresh) | before)

    # what stays of these months, staged: a table is not overwritten while it is read
    wanted = spark.createDataFrame(touched, "year int, month int")
    kept = (read_table(spark, out).join(F.broadcast(wanted), ["year", "month"], "left_semi")
            .join(bounded_broadcast(news.select(F.col("path").alias(ARCHIVE))), ARCHIVE, "left_anti").select(*CLEAN_COLUMNS, ARCHIVE))
    kept_at = shared_dir(spark, "ledger-kept")
    kept.write.parquet(kept_at)
    both = spark.read.schema(_table_schema()).parquet(kept_at).select(*fresh.columns).unionByName(fresh)
    left = _months(both)
    if left:
        write_clean(both, out, dynamic=True)
    gone = [m for m in touched if m not in left]
    for year, month in gone:
        remove(spark, f"{out}/year={year}/month={month}")

    by_archive = fresh.groupBy(F.col(ARCHIVE).alias("path")).agg(F.collect_set(F.struct("year", "month")).alias("months"))
    status = zipcsv.read_status(spark, status_at).select("path", "rows", "error")
    entry = (news.join(status, "path", "left").join(by_archive, "path", "left")
             .select(*VERSION, F.coalesce("months", F.array().cast("array<struct<year:int,month:int>>")).alias("months"),
                     "rows", "error", F.lit(batch).alias("batch"), F.current_timestamp().alias("ingested_at")))
    entry.write.mode("append").parquet(ledger)
    n_replaced = replaced.count()
    for folder in (news_at, fresh_at, kept_at, status_at):
        remove(spark, folder)
    return {"archives": count, "replaced": n_replaced, "months": len(left), "removed": len(gone)}
