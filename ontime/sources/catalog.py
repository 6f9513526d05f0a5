"""Named tables: created or replaced as a whole (S14), bucketed and sorted (S12), and families of
yearly tables found by their name (S9).

``replace_table`` writes a fresh version into a folder of its own and then points the name, a view,
at it.  The name changes in one catalog operation after the write has ended: readers see the old
rows or the new ones, never a part, and a write that fails leaves the old version in place.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}")


def _checked(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def _hadoop(spark: SparkSession, path: str):
    """(Hadoop's filesystem of a path, the path)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written."""
    fs, at = _hadoop(spark, path)
    fs.delete(at, True)


def _versions(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _hadoop(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(v for v in found if v.startswith("v-"))


def replace_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = (), keep: int = 1) -> str:
    """S14, ``CREATE OR REPLACE TABLE name AS``: the rows of ``df`` as a new version below
    ``<root>/<name>``; returns its folder.  ``keep``: earlier versions that stay, for readers that
    began before the change."""
    spark, folder = df.sparkSession, f"{root.rstrip('/')}/{_checked(name)}"
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{folder}/{version}"
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    except BaseException:
        remove(spark, path)
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    older = [v for v in _versions(spark, folder) if v < version]
    for v in older[:max(0, len(older) - keep)]:
        remove(spark, f"{folder}/{v}")
    return path


def save_clustered(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int,
                   sort_by: Sequence[str] = ()) -> DataFrame:
    """S12, catalog form: ``df`` as a table bucketed by ``keys`` and sorted within buckets, one file a
    bucket.  Tables with the same number of buckets join and aggregate on ``keys`` without a shuffle.
    A bucket is one task, so ``keys`` are to be such that no value holds much of the table (a station
    and a day, say, not a station)."""
    spark = df.sparkSession
    rows = df.repartition(buckets, *keys)
    (rows.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*(sort_by or keys)).saveAsTable(_checked(name)))
    return spark.table(name)


def join_clustered(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tables of ``save_clustered`` joined bucket by bucket.  Their sorted files are small for their rows,
    so the planner, which goes by the bytes of files, would take one side through the driver."""
    return left.hint("merge").join(right, list(keys))


@dataclass(frozen=True)
class Family:
    """The tables ``<prefix><year>`` of an inclusive range of years."""
    prefix: str
    tables: dict[int, str]
    missing: list[int]

    def read(self, spark: SparkSession) -> DataFrame:
        """Their union by name.  Columns that a year lacks are null there; a filter on the result
        reaches the scan of every member."""
        if not self.tables:
            raise ValueError(f"no table {self.prefix}<year> in this range")
        frames = [spark.table(t) for _, t in sorted(self.tables.items())]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out


def table_family(spark: SparkSession, prefix: str, start_year: int, end_year: int) -> Family:
    """The members of a family that the catalog has, and the years without one.  ``prefix`` may
    begin with a database."""
    database, _, base = _checked(prefix).rpartition(".")
    names = {t.name.lower(): t.name for t in spark.catalog.listTables(database or None, f"{base}*")}
    years = {y: names.get(f"{base}{y}".lower()) for y in range(start_year, end_year + 1)}
    qualified = {y: f"{database}.{n}" if database else n for y, n in years.items() if n}
    return Family(prefix, qualified, [y for y, n in years.items() if n is None])
