"""Folds and bounded training samples shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_SPLITS = 16


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % n


def sample(rows: DataFrame, group: str, texts: DataFrame, per_group: int) -> DataFrame:
    """``texts`` (doc_id, text) of at most ``per_group`` ids of each value of ``group``, by a hash of the id.

    The ranking reads ids only.  It ranks within ``_SPLITS`` parts of each value first and then those
    ranks that can count, so no task gets more rows of a value than its part or ``_SPLITS`` samples.
    What is broadcast is at most ``per_group`` ids for each value, whatever the table's size.
    """
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = rows.select("doc_id", group).withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(_SPLITS)))
    for keys in ([group, "_part"], [group]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        chosen = chosen.withColumn("_rank", rank).where(F.col("_rank") <= per_group)
    chosen = chosen.drop("_rank", "_part")
    return texts.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
