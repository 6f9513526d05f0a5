"""Connected components of verified links, and the units in which groups of candidates are compared."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ontime.session import shared_dir


def components(edges: DataFrame) -> DataFrame:
    """id, component (the least id reachable) for every id in ``edges`` (a, b), both long.

    Large-star and small-star rounds (Kiveris et al., 2014): each replaces edges by edges to the
    least neighbour, found by a grouped minimum, so no neighbourhood is gathered.  Every round is
    written to the shared folder; it ends when a round changes no edge."""
    spark = edges.sparkSession

    def staged(frame: DataFrame) -> DataFrame:
        folder = shared_dir(spark, "components")
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    def mark(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = mark(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # staged, so that the join reads plain exchanges and Spark can split the star of a large component
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        last, state = state, mark(now)
        if state == last:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


class Union:
    """Least labels of a few items under links that come in arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            low = np.minimum(x, y)
            if (x == y).all():
                return
            np.minimum.at(self.label, x, low)
            np.minimum.at(self.label, y, low)
            while True:  # labels of labels
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up
