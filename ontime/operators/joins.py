"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest side that is shipped to every executor, in bytes of its values.
MAX_BROADCAST_BYTES = 256 << 20
_ROW_BYTES = 16


def payload_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: the lengths of strings and binaries, 8 for any other column, and a
    fixed part a row.  One aggregate over ``df``; meant for small sides and staged tables."""
    width = F.lit(_ROW_BYTES)
    for f in df.schema.fields:
        long = isinstance(f.dataType, (T.StringType, T.BinaryType))
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        text = F.to_json(F.struct(f.name)) if nested else F.col(f.name)
        width = width + (F.coalesce(F.octet_length(text), F.lit(0)) + 8 if long or nested else F.lit(8))
    return int(df.agg(F.sum(width.cast("long")).alias("n")).first()["n"] or 0)


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, size: int | None = None) -> DataFrame:
    """``broadcast(df)`` only after checking its size in bytes; otherwise leave the strategy to
    the planner (sort-merge / shuffled hash join, re-planned by AQE at run time).

    Pass ``size`` when it is already known (``payload_bytes``)."""
    n = payload_bytes(df) if size is None else size
    return F.broadcast(df) if n <= max_bytes else df
