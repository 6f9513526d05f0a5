"""Sinks: partitioned clean flights (S10), lookup with row count (S11), the
day-partitioned clustered fact table (S12), and dashboard tables (S14).

Writes go through ``REBALANCE`` on the partition columns rather than a plain
``repartition``: rows of one partition value still meet in few tasks (few files per
directory), but AQE splits a partition value that is too big for one task and merges
small ones -- a month or a day holding a third of all rows is written by many tasks
instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ontime.schema import CLEAN_COLUMNS, ENRICHED_COLUMNS, clean_schema


def _writer(df: DataFrame, mode: str, dynamic: bool, max_records_per_file: int | None):
    w = df.write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    return w


def write_clean(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False,
                max_records_per_file: int | None = None) -> None:
    """``year=/month=`` partitioned Parquet; ``dynamic`` replaces only the
    months present in ``df`` instead of the whole target."""
    out = df.hint("rebalance", "year", "month")
    _writer(out, mode, dynamic, max_records_per_file).partitionBy("year", "month").parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Read S10 back with the declared schema (no inference); partition columns last."""
    return spark.read.schema(clean_schema()).parquet(path).select(*CLEAN_COLUMNS)


def write_lookup(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a lookup and return its row count.  The count scans the written
    files without reading any column (row counts only) instead of running the plan
    a second time, as a ``count()`` on ``df`` would."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def stage_table(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` as Parquet into a fresh folder under the shared checkpoint
    directory and return (the table read back, its row count from the files).  Cuts
    the lineage -- a lost executor re-reads the files instead of recomputing the plan
    -- and gives a size bound without running the plan twice."""
    from ontime.session import shared_dir
    spark = df.sparkSession
    path = shared_dir(spark, name)
    rows = write_lookup(df, path)
    return spark.read.parquet(path), rows


def write_fact(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False,
               cluster_by: tuple[str, ...] = ("reporting_airline", "origin", "dest"),
               max_records_per_file: int | None = None) -> None:
    """One directory per flight day, rows sorted by the clustering columns inside
    each file (tight Parquet min/max statistics for airline / airport filters).  The
    sort includes the day first, which is also the order the partitioned writer needs,
    so there is no second sort."""
    out = df.hint("rebalance", "flight_date").sortWithinPartitions("flight_date", *cluster_by)
    _writer(out, mode, dynamic, max_records_per_file).partitionBy("flight_date").parquet(path)


def enriched_schema(spark: SparkSession) -> T.StructType:
    from ontime.schema import ENRICH_WEATHER
    fields = list(clean_schema().fields)
    fields += [T.StructField("origin_station", T.StringType()), T.StructField("dest_station", T.StringType())]
    for role in ("origin", "dest"):
        for w in ENRICH_WEATHER:
            t = T.StringType() if w in ("fog", "rain", "snow", "thunder") else T.DoubleType()
            fields.append(T.StructField(f"{role}_{w}", t))
    return T.StructType(fields)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Read S12 back; a filter on ``flight_date`` prunes whole directories."""
    return spark.read.schema(enriched_schema(spark)).parquet(path).select(*ENRICHED_COLUMNS)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``CREATE OR REPLACE TABLE AS`` -> overwrite a (small) result table."""
    df.write.mode(mode).parquet(path)
