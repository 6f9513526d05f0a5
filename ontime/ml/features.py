"""Model input (P15), time-based split (M1), automatic class weights (M2) and
feature statistics (M4p)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.schema import CATEGORICAL_FEATURES, FEATURE_SOURCES, LABEL, NUMERIC_FEATURES

CUTOFF = "2025-01-01"
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES


def model_input(fact: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Label + the 11 features under the names the models use (``origin_wdsp`` ->
    ``wind_speed`` ...); month, day of week and hour stay integers."""
    cols = [F.col(LABEL)] + [F.col(FEATURE_SOURCES.get(f, f)).alias(f) for f in FEATURES]
    return fact.select(*cols, *keep)


def _eligible(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col(LABEL).isNotNull() & F.col("reporting_airline").isNotNull())


def training_set(fact: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Flights strictly before ``cutoff`` (the filter is on ``flight_date`` itself, so
    a day-partitioned fact table is pruned to the training days)."""
    return model_input(_eligible(fact).filter(F.col("flight_date") < F.lit(dt.date.fromisoformat(cutoff))))


def holdout_set(fact: DataFrame, cutoff: str = CUTOFF, keep: tuple[str, ...] = ()) -> DataFrame:
    return model_input(_eligible(fact).filter(F.col("flight_date") >= F.lit(dt.date.fromisoformat(cutoff))), keep)


def ml_split(fact: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Both sides in one pass, tagged ``split`` = 'train' | 'holdout' (no random split)."""
    d = F.col("flight_date")
    c = F.lit(dt.date.fromisoformat(cutoff))
    tagged = _eligible(fact).filter(d.isNotNull()).withColumn(
        "split", F.when(d < c, F.lit("train")).otherwise(F.lit("holdout")))
    return model_input(tagged, keep=("split",))


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights: w_c = n / (k * n_c) for the k classes present.

    The window runs over the per-class counts only (k rows)."""
    per = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    whole = Window.partitionBy()
    return per.select(label, "n_class",
                      (F.sum("n_class").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n_class")))
                      .alias("weight"))


def with_class_weights(train: DataFrame, label: str = LABEL, weight_col: str = "weight") -> DataFrame:
    """Attach the class weight to every training row (the weight table has one row
    per class, so it is broadcast)."""
    w = class_weights(train, label).select(label, F.col("weight").alias(weight_col))
    return train.join(F.broadcast(w), label, "inner")


def feature_stats(train: DataFrame, features: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Per numeric feature: rows, missing, mean and sample std of the non-missing
    values -- what mean imputation and standardisation are fitted on.  One pass: a
    single global aggregate, then ``stack`` turns the one row into one per feature."""
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.count(F.lit(1)).alias(f"n_{f}"), F.count_if(x.isNull()).alias(f"m_{f}"),
                 F.avg(x).alias(f"a_{f}"), F.stddev_samp(x).alias(f"s_{f}")]
    one = train.agg(*aggs)
    stack = ", ".join(f"'{f}', n_{f}, m_{f}, a_{f}, s_{f}" for f in features)
    return one.selectExpr(f"stack({len(features)}, {stack}) AS (feature, rows, missing, mean, stddev)")
