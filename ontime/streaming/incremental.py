"""Incremental, re-runnable archive ingest with Structured Streaming.

A file-source stream over the archive folder remembers in its checkpoint which
archives it has already processed, so every run (``trigger(availableNow=True)``)
ingests exactly the archives that arrived since the last one and then stops -- the
"skip what is already staged" logic of the download script, as a Spark job.  The
Parquet file sink commits each micro-batch atomically through its metadata log, so a
failed or repeated run never duplicates rows (readers of the output use that log).

Limits of the file source: an archive *replaced* under the same name is not re-read, and one beyond
2 GiB, which its binary column cannot hold, fails the run.  ``ledger.sync_archives`` has neither limit.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from ontime.operators.clean import clean_flights
from ontime.schema import CLEAN_COLUMNS, RAW_COLUMNS, clean_schema
from ontime.sources.zipcsv import extract_rows

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


class _Totals(StreamingQueryListener):
    """Micro-batches with input, and archives read, of one run (``recentProgress`` forgets all but the last)."""

    def __init__(self) -> None:
        self.by_run: dict[str, list[int]] = {}
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if n := event.progress.numInputRows:
            self.by_run.setdefault(str(event.progress.runId), []).append(n)

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()


def archive_stream(spark: SparkSession, raw_root: str, glob: str = "*.zip",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
         .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(raw_root)


def ingest_new_archives(spark: SparkSession, raw_root: str, out_path: str, checkpoint: str,
                        glob: str = "*.zip", max_files_per_trigger: int | None = None) -> dict:
    """Ingest every archive not seen by earlier runs into ``year=/month=`` Parquet.

    Returns the progress of the run: micro-batches with input and archives read."""
    clean = clean_flights(extract_rows(archive_stream(spark, raw_root, glob, max_files_per_trigger),
                                       RAW_COLUMNS))
    totals = _Totals()
    spark.streams.addListener(totals)
    try:
        q = (clean.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).partitionBy("year", "month")
             .trigger(availableNow=True).start(out_path))
        q.awaitTermination()
        run = str(q.runId)
        with totals.news:  # events of one query come in order, its end last
            totals.news.wait_for(lambda: run in totals.ended, timeout=60)
    finally:
        spark.streams.removeListener(totals)
    batches = totals.by_run.get(run, [])
    return {"batches": len(batches), "archives": sum(batches)}


def read_ingested(spark: SparkSession, out_path: str) -> DataFrame:
    """The ingested table (committed files only, via the sink's metadata log)."""
    return spark.read.schema(clean_schema()).parquet(out_path).select(*CLEAN_COLUMNS)
