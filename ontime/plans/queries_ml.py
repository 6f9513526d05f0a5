"""Registered queries for the ML layer.

Checked against SQL: the split and model input (M1/P15), class weights (M2), feature
statistics (M4p), and the evaluation operators (M5-M7) on a deterministic scored
table derived from ``lineitem`` (two fixed scorers).  Fitted coefficients and trees have
no SQL form; the keys of M3, M4 and M8-M11 run the real models on the enriched test-bed
table and return what must hold of any right fit: exact counts and sums of their inputs,
and flags of the equations that tie the outputs to them.  The raw outputs are those of
``ontime.ml`` and of ``plans.jobs.models_job``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ontime.ml import evaluate as ev
from ontime.ml import compiled, explain, features, models
from ontime.plans import chain
from ontime.plans.oracles import cte_sql, r2, register_cte
from ontime.plans.registry import register
from ontime.schema import NUMERIC_FEATURES
from ontime.sources import testbed as tb

_INPUT = ("is_delayed_15, reporting_airline, origin, dest, dep_hour, day_of_week, month, distance, "
          "origin_wdsp AS wind_speed, origin_prcp AS precipitation, origin_visib AS visibility, "
          "origin_temp AS temperature")
_ELIGIBLE = "is_delayed_15 IS NOT NULL AND reporting_airline IS NOT NULL"
register_cte("tb_train", f"SELECT {_INPUT} FROM tb_enriched WHERE {_ELIGIBLE} AND flight_date < DATE '2025-01-01'",
             ["tb_enriched"])
register_cte("tb_holdout", f"SELECT flight_date, {_INPUT} FROM tb_enriched WHERE {_ELIGIBLE} "
             "AND flight_date >= DATE '2025-01-01'", ["tb_enriched"])
register_cte("tb_models", "SELECT unnest(['logistic_regression', 'boosted_tree']) AS model_type", [])
register_cte("tb_features", "SELECT unnest([" + ", ".join(f"'{f}'" for f in features.FEATURES) + "]) AS feature", [])
register_cte("tb_eval_counts", (
    "SELECT model_type, CAST(count_if(label = 1 AND p > 0.5) AS BIGINT) AS tp, "
    "CAST(count_if(label = 0 AND p > 0.5) AS BIGINT) AS fp, CAST(count_if(label = 1 AND p <= 0.5) AS BIGINT) AS fn, "
    "CAST(count_if(label = 0 AND p <= 0.5) AS BIGINT) AS tn, "
    "avg(-ln(greatest(CASE WHEN label = 1 THEN p ELSE 1.0 - p END, 1e-15))) AS log_loss "
    "FROM tb_scored GROUP BY model_type"), ["tb_scored"])
register_cte("tb_eval_auc", (
    "SELECT model_type, CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)) AS roc_auc "
    "FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model_type ORDER BY p "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ("
    "SELECT model_type, p, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM tb_scored GROUP BY 1, 2) d) r "
    "GROUP BY model_type"), ["tb_scored"])

_DIGITS = 6
#: Largest gap of a score equation, as a share of the weight it sums over.
_SCORE_TOLERANCE = 0.002


def _fact(spark, d):
    return chain.model_facts(spark, d)


@register("ml_split", cte_sql(
    f"SELECT {_INPUT}, CASE WHEN flight_date < DATE '2025-01-01' THEN 'train' ELSE 'holdout' END AS split "
    f"FROM tb_enriched WHERE {_ELIGIBLE} AND flight_date IS NOT NULL", "tb_enriched"), "ml")
def q_ml_split(spark, d):
    return features.ml_split(_fact(spark, d))


@register("class_weights", cte_sql(
    "SELECT is_delayed_15, n_class, CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class) AS weight "
    "FROM (SELECT is_delayed_15, CAST(count(*) AS BIGINT) AS n_class FROM tb_train GROUP BY 1) c", "tb_train"), "ml")
def q_class_weights(spark, d):
    return features.class_weights(features.training_set(_fact(spark, d)))


@register("feature_stats", cte_sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({f}) AS BIGINT) AS missing, "
    f"{r2(f'avg(CAST({f} AS DOUBLE))', _DIGITS)} AS mean, {r2(f'stddev_samp(CAST({f} AS DOUBLE))', _DIGITS)} AS stddev "
    "FROM tb_train" for f in NUMERIC_FEATURES), "tb_train"), "ml")
def q_feature_stats(spark, d):
    s = features.feature_stats(features.training_set(_fact(spark, d)))
    return s.select("feature", "rows", "missing", F.round("mean", _DIGITS).alias("mean"),
                    F.round("stddev", _DIGITS).alias("stddev"))


@register("evaluate_scored", cte_sql(
    "SELECT c.model_type, "
    f"{r2('CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0)', _DIGITS)} AS precision, "
    f"{r2('CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0)', _DIGITS)} AS recall, "
    f"{r2('CAST(tp + tn AS DOUBLE) / NULLIF(tp + fp + fn + tn, 0)', _DIGITS)} AS accuracy, "
    f"{r2('CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0)', _DIGITS)} AS f1, "
    f"{r2('log_loss', _DIGITS)} AS log_loss, {r2('roc_auc', _DIGITS)} AS roc_auc "
    "FROM tb_eval_counts c JOIN tb_eval_auc a ON c.model_type = a.model_type", "tb_eval_counts", "tb_eval_auc"), "ml")
def q_evaluate_scored(spark, d):
    m = ev.evaluate(tb.scored(spark, d), ["model_type"])
    return m.select("model_type", *[F.round(x, _DIGITS).alias(x) for x in ev.METRICS])


@register("confusion_wide", cte_sql(
    "SELECT model_type, label AS expected_label, CAST(count_if(p <= 0.5) AS BIGINT) AS _0, "
    "CAST(count_if(p > 0.5) AS BIGINT) AS _1 FROM tb_scored GROUP BY 1, 2", "tb_scored"), "ml")
def q_confusion_wide(spark, d):
    return ev.confusion_wide(tb.scored(spark, d), ["model_type"])


register_cte("tb_cm", (
    "SELECT model_type, label AS expected_label, CAST(count_if(p <= 0.5) AS BIGINT) AS _0, "
    "CAST(count_if(p > 0.5) AS BIGINT) AS _1 FROM tb_scored GROUP BY 1, 2"), ["tb_scored"])


@register("confusion_long", cte_sql(
    "SELECT model_type, CAST(expected_label AS VARCHAR) AS actual, 'predicted_on_time' AS predicted, _0 AS flights "
    "FROM tb_cm UNION ALL SELECT model_type, CAST(expected_label AS VARCHAR) AS actual, "
    "'predicted_delayed' AS predicted, _1 AS flights FROM tb_cm", "tb_cm"), "ml")
def q_confusion_long(spark, d):
    return ev.confusion_long(tb.scored(spark, d), ["model_type"])


# --- real models on the enriched test-bed table -----------
def _models(spark, d, kinds=(models.LOGISTIC, models.BOOSTED)):
    fact = _fact(spark, d)
    train = features.training_set(fact)
    return fact, train, {k: models.fit_or_load(spark, k, train, d) for k in kinds}


def _holdout_scores(spark, d):
    """Both models' hold-out scores, written once per application (the evaluation
    aggregates read them several times; scoring runs once)."""
    def build():
        fact, _, ms = _models(spark, d)
        hold = features.holdout_set(fact)
        parts = [models.score(m, hold, kind) for kind, m in ms.items()]
        return parts[0].unionByName(parts[1])
    return chain.staged(spark, d, "holdout_scores", build)


@register("train_logistic", cte_sql(
    "SELECT reporting_airline, CAST(count(*) AS BIGINT) AS flights, "
    f"{r2('sum(w * is_delayed_15)', 3)} AS weighted_delayed, TRUE AS balanced "
    "FROM (SELECT *, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY is_delayed_15)) AS w "
    "FROM tb_train) t GROUP BY 1", "tb_train"), "ml")
def q_train_logistic(spark, d):
    """M3: the score equations of the unregularised weighted fit, one for each airline's slot."""
    _, train, ms = _models(spark, d, (models.LOGISTIC,))
    eq = models.score_equations(ms[models.LOGISTIC], train, "reporting_airline")
    gap = F.abs(F.col("weighted_score") - F.col("weighted_label"))
    return eq.select("reporting_airline", F.col("rows").alias("flights"),
                     F.round("weighted_label", 3).alias("weighted_delayed"),
                     (gap <= F.col("weight") * _SCORE_TOLERANCE).alias("balanced"))


# the root split of a first tree, by brute force: labels as -1 / 1, variance with class weights; categories in
# order of their mean, numbers in their own (missing ones at the mean of the others); every cut is a candidate
_STUMP_NUMBERS = ["dep_hour", "day_of_week", "month"]
register_cte("tb_stump", (
    "SELECT t.reporting_airline, t.origin, t.dest, "
    + ", ".join(f"coalesce(CAST(t.{f} AS DOUBLE), m.{f}) AS {f}" for f in _STUMP_NUMBERS)
    + ", CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY t.is_delayed_15)) AS w, "
    "2.0 * t.is_delayed_15 - 1.0 AS y FROM tb_train t CROSS JOIN (SELECT "
    + ", ".join(f"avg(CAST({f} AS DOUBLE)) AS {f}" for f in _STUMP_NUMBERS) + " FROM tb_train) m"), ["tb_train"])
register_cte("tb_stump_values", " UNION ALL ".join(
    [f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS v, sum(w * y) / sum(w) AS place, sum(w) AS w, sum(w * y) AS wy, count(*) AS n "
     f"FROM tb_stump GROUP BY {f}" for f in ("reporting_airline", "origin", "dest")]
    + [f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS v, {f} AS place, sum(w) AS w, sum(w * y) AS wy, count(*) AS n "
       f"FROM tb_stump GROUP BY {f}" for f in _STUMP_NUMBERS]), ["tb_stump"])
register_cte("tb_stump_best", (
    "SELECT feature, least(nl, nt - nl) AS small_side, greatest(nl, nt - nl) AS large_side FROM ("
    "SELECT *, row_number() OVER (ORDER BY sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) DESC) AS place_ FROM ("
    "SELECT feature, sum(w) OVER b AS wl, sum(wy) OVER b AS sl, sum(n) OVER b AS nl, sum(w) OVER f AS wt, sum(wy) OVER f AS st, "
    "sum(n) OVER f AS nt, count(*) OVER f AS cuts, row_number() OVER b AS cut FROM tb_stump_values "
    "WINDOW f AS (PARTITION BY feature), b AS (PARTITION BY feature ORDER BY place, v ROWS UNBOUNDED PRECEDING)) c "
    "WHERE cut < cuts) r WHERE place_ = 1"), ["tb_stump_values"])


def _stump_rows(rows):
    """The rows with the features that have more values than cut candidates made constant."""
    return rows.select(*[F.lit(0.0).alias(c) if c in features.FEATURES and c not in _STUMP_NUMBERS and c in NUMERIC_FEATURES
                         else F.col(c) for c in rows.columns])


def _stump(spark, d):
    train = _stump_rows(features.training_set(_fact(spark, d)))
    return models.fit_or_load(spark, models.BOOSTED, train, d, maxIter=1, maxDepth=1, subsamplingRate=1.0)


@register("train_boosted", cte_sql(
    "SELECT f.feature, TRUE AS within, CAST(1.0 AS DOUBLE) AS total, CAST(50 AS BIGINT) AS rounds, "
    "CAST(b.small_side AS BIGINT) AS small_side, CAST(b.large_side AS BIGINT) AS large_side "
    "FROM tb_features f LEFT JOIN tb_stump_best b ON f.feature = b.feature", "tb_features", "tb_stump_best"), "ml")
def q_train_boosted(spark, d):
    """M4: the whole boosted model (every round, depth and feature): its rounds and the split-gain importance of
    every feature, each a share of one; beside the feature of the first split of a one-split model, the flights
    on either side, found by brute force too."""
    _, _, ms = _models(spark, d, (models.BOOSTED,))
    rounds = len(compiled.trees(spark, ms[models.BOOSTED]))
    root = compiled.trees(spark, _stump(spark, d))[0]
    sides = sorted((root.rows[root.left[0]], root.rows[root.right[0]]))
    split = spark.createDataFrame([(features.FEATURES[root.feature[0]], *sides)], "feature string, small_side long, large_side long")
    imp = explain.tree_importance(spark, ms[models.BOOSTED])         # one row a feature
    return imp.join(split, "feature", "left").select(
        "feature", F.col("attribution").between(0.0, 1.0).alias("within"),
        F.round(F.sum("attribution").over(Window.partitionBy()), _DIGITS).alias("total"),
        F.lit(rounds).cast("long").alias("rounds"), "small_side", "large_side")


@register("score_holdout", cte_sql(
    "SELECT model_type, CAST(is_delayed_15 AS INTEGER) AS label, CAST(count(*) AS BIGINT) AS flights, "
    "CAST(count(*) AS BIGINT) AS agreeing FROM tb_holdout CROSS JOIN tb_models GROUP BY 1, 2",
    "tb_holdout", "tb_models"), "ml")
def q_score_holdout(spark, d):
    """Every eligible hold-out flight scored by each model, and by the model compiled to an expression:
    the probabilities that agree to 1e-9."""
    fact, _, ms = _models(spark, d)
    hold = features.holdout_set(fact)
    out = None
    for kind, m in ms.items():
        both = models.score(m, compiled.score_compiled(m, hold, "q"), kind, keep=("q",))
        out = both if out is None else out.unionByName(both)
    return out.groupBy("model_type", "label").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if(F.abs(F.col("p") - F.col("q")) <= 1e-9).alias("agreeing"))


@register("tree_paths", cte_sql(
    "SELECT CAST(count(*) AS BIGINT) AS flights, CAST(count(*) AS BIGINT) AS additive FROM tb_holdout", "tb_holdout"), "ml")
def q_tree_paths(spark, d):
    """On every hold-out flight the bias and the path contributions add up to the boosted model's margin."""
    fact, _, ms = _models(spark, d, (models.BOOSTED,))
    scored = models.score(ms[models.BOOSTED], features.holdout_set(fact, keep=()), models.BOOSTED, keep=tuple(features.FEATURES))
    rows, bias = compiled.path_contributions(ms[models.BOOSTED], scored, keep=("p",))
    margin = F.lit(bias)
    for f in features.FEATURES:
        margin = margin + F.col(f)
    agrees = F.abs(F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * margin)) - F.col("p")) <= 1e-9
    return rows.agg(F.count(F.lit(1)).alias("flights"), F.count_if(agrees).alias("additive"))


@register("unseen_features", cte_sql(
    "SELECT model_type, CAST(count(*) AS BIGINT) AS flights, CAST(count(*) AS BIGINT) AS scored "
    "FROM tb_holdout CROSS JOIN tb_models GROUP BY 1", "tb_holdout", "tb_models"), "ml")
def q_unseen_features(spark, d):
    """Airports never learned, missing ones and missing weather are scored, alike by both forms of the models."""
    fact, _, ms = _models(spark, d)
    month = F.col("month")
    hold = (features.holdout_set(fact).withColumn("origin", F.when(month == 3, "NEW").otherwise(F.col("origin")))
            .withColumn("dest", F.when(month != 4, F.col("dest"))).withColumn("wind_speed", F.when(month != 6, F.col("wind_speed"))))
    out = None
    for kind, m in ms.items():
        both = models.score(m, compiled.score_compiled(m, hold, "q"), kind, keep=("q",))
        out = both if out is None else out.unionByName(both)
    return out.groupBy("model_type").agg(F.count(F.lit(1)).alias("flights"),
                                         F.count_if(F.abs(F.col("p") - F.col("q")) <= 1e-9).alias("scored"))


_SCORED_METRICS = (
    f"{r2('CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0)', 4)} AS precision, {r2('CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0)', 4)} AS recall, "
    f"{r2('CAST(tp + tn AS DOUBLE) / NULLIF(tp + fp + fn + tn, 0)', 4)} AS accuracy, "
    f"{r2('CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0)', 4)} AS f1, {r2('log_loss', 4)} AS log_loss, {r2('roc_auc', 4)} AS roc_auc "
    "FROM tb_eval_counts c JOIN tb_eval_auc a ON c.model_type = a.model_type")


@register("comparison_scored", cte_sql(f"SELECT c.model_type, {_SCORED_METRICS}", "tb_eval_counts", "tb_eval_auc"), "ml")
def q_comparison_scored(spark, d):
    """M8 on the fixed scorers: rounded metrics against SQL."""
    return ev.model_comparison(tb.scored(spark, d))


@register("metrics_scored", cte_sql(
    f"SELECT TRUE AS evaluated_now, '2025-01-01 .. 2025-12-31' AS holdout_window, c.model_type, {_SCORED_METRICS}",
    "tb_eval_counts", "tb_eval_auc"), "ml")
def q_metrics_scored(spark, d):
    """The same, stamped with the time of the run."""
    begun = dt.datetime.now(dt.timezone.utc)
    m = ev.eval_metrics(ev.model_comparison(tb.scored(spark, d)), "2025-01-01 .. 2025-12-31")
    late = F.unix_timestamp("evaluated_at") - F.lit(int(begun.timestamp()))
    return m.withColumn("evaluated_now", late.between(0, 3600)).drop("evaluated_at")


def _from_cells(scored):
    """Counts-based metrics of each model recomputed from its confusion cells (M6)."""
    w = ev.confusion_wide(scored, ["model_type"]).groupBy("model_type").agg(
        *[F.sum(F.when(F.col("expected_label") == y, F.col(f"_{x}"))).alias(f"c{y}{x}") for y in (0, 1) for x in (0, 1)])
    return w.selectExpr(
        "model_type", "try_divide(c11, c11 + c01) AS r_precision", "try_divide(c11, c11 + c10) AS r_recall",
        "try_divide(c11 + c00, c11 + c00 + c10 + c01) AS r_accuracy",
        "try_divide(2 * c11, 2 * c11 + c01 + c10) AS r_f1")


def _agree(digits: int):
    """Rounded metrics equal the recomputed ones (both null where a denominator is zero)."""
    same = [F.round(f"r_{m}", digits).eqNullSafe(F.col(m)) for m in ("precision", "recall", "accuracy", "f1")]
    return same[0] & same[1] & same[2] & same[3]


@register("model_comparison", cte_sql(
    "SELECT model_type, TRUE AS cells_agree, TRUE AS within FROM tb_models", "tb_models"), "ml")
def q_model_comparison(spark, d):
    """M8: metrics equal those of the confusion cells; AUC is a share, log-loss not negative."""
    scored = _holdout_scores(spark, d)
    both = ev.model_comparison(scored).join(_from_cells(scored), "model_type", "left")
    return both.select("model_type", _agree(4).alias("cells_agree"),
                       (F.col("roc_auc").between(0.0, 1.0) & (F.col("log_loss") >= 0)).alias("within"))


_AS_OF = dt.datetime(2026, 1, 1)


@register("eval_metrics", cte_sql(
    "SELECT '2026-01-01 00:00:00' AS evaluated_at, model_type, holdout_window, TRUE AS cells_agree FROM tb_models "
    "CROSS JOIN (SELECT CAST(min(flight_date) AS VARCHAR) || ' .. ' || CAST(max(flight_date) AS VARCHAR) "
    "AS holdout_window FROM tb_holdout) h", "tb_models", "tb_holdout"), "ml")
def q_eval_metrics(spark, d):
    """M9: evaluation time as given, the window of the eligible hold-out, metrics as in M8."""
    scored = _holdout_scores(spark, d)
    hold = features.holdout_set(_fact(spark, d), keep=("flight_date",))
    window = ev.holdout_window_text(hold).first()["holdout_window"]         # one text
    m = ev.eval_metrics(ev.model_comparison(scored), window, _AS_OF)
    return m.join(_from_cells(scored), "model_type", "left").select(
        F.date_format("evaluated_at", "yyyy-MM-dd HH:mm:ss").alias("evaluated_at"), "model_type", "holdout_window",
        _agree(4).alias("cells_agree"))


@register("model_confusion", cte_sql(
    "SELECT model_type, CAST(is_delayed_15 AS VARCHAR) AS actual, CAST(count(*) AS BIGINT) AS flights, "
    "CAST(2 AS BIGINT) AS cells FROM tb_holdout CROSS JOIN tb_models GROUP BY 1, 2", "tb_holdout", "tb_models"), "ml")
def q_model_confusion(spark, d):
    """M7 on real scores: the cells of each actual label add up to its hold-out flights."""
    return ev.confusion_long(_holdout_scores(spark, d), ["model_type"]).groupBy("model_type", "actual").agg(
        F.sum("flights").alias("flights"), F.count(F.lit(1)).alias("cells"))


@register("feature_importance", cte_sql(
    "SELECT model_type, feature, TRUE AS not_negative FROM tb_models CROSS JOIN tb_features",
    "tb_models", "tb_features"), "ml")
def q_feature_importance(spark, d):
    """Both models over the full feature list."""
    _, train, ms = _models(spark, d)
    return explain.feature_importance(spark, ms, train).select(
        "model_type", "feature", (F.col("attribution") >= 0).alias("not_negative"))


# --- M10 on a fixed linear model: exact attribution checked against SQL ------
# Weights of the check (a rule, not fitted): airline C<k> -> 0.1k - 0.5, airport
# A<n> -> 0.02n - 0.2 (origin and dest), fixed numeric weights; unknown category -> 0;
# missing numerics imputed with the training mean.
_W_CAT = {"reporting_airline": {f"C{k}": 0.1 * k - 0.5 for k in range(12)},
          "origin": {f"A{n}": 0.02 * n - 0.2 for n in range(25)},
          "dest": {f"A{n}": 0.02 * n - 0.2 for n in range(25)}}
_W_NUM = {"dep_hour": 0.05, "day_of_week": -0.1, "month": 0.02, "distance": 0.001, "wind_speed": 0.04,
          "precipitation": 0.8, "visibility": -0.05, "temperature": 0.01}


def _dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


register_cte("tb_la_means", "SELECT " + ", ".join(f"avg(CAST({f} AS DOUBLE)) AS {f}" for f in _W_NUM)
             + " FROM tb_train", ["tb_train"])
register_cte("tb_la_terms", "SELECT " + ", ".join(
    [f"CASE t.{f} " + " ".join(f"WHEN '{k}' THEN {_dbl(v)}" for k, v in m.items()) + f" ELSE 0.0 END AS {f}"
     for f, m in _W_CAT.items()]
    + [f"{_dbl(w)} * coalesce(CAST(t.{f} AS DOUBLE), m.{f}) AS {f}" for f, w in _W_NUM.items()])
    + " FROM tb_train t CROSS JOIN tb_la_means m", ["tb_train", "tb_la_means"])


@register("linear_attribution", cte_sql(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, {r2(f'avg(abs({f} - (SELECT avg({f}) FROM tb_la_terms)))', _DIGITS)} AS attribution "
    "FROM tb_la_terms" for f in list(_W_CAT) + list(_W_NUM)), "tb_la_terms"), "ml")
def q_linear_attribution(spark, d):
    train = features.training_set(_fact(spark, d))
    means = train.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in _W_NUM]).first()   # 8 values
    impute = {f: means[f] for f in _W_NUM if means[f] is not None}
    a = explain.attribution(train, explain.linear_terms(_W_NUM, _W_CAT, impute))
    return a.select("feature", F.round("attribution", _DIGITS).alias("attribution"))


@register("permutation_importance", cte_sql(
    "SELECT f.feature, f.feature = b.feature AS matters FROM tb_features f CROSS JOIN tb_stump_best b",
    "tb_features", "tb_stump_best"), "ml")
def q_permutation_importance(spark, d):
    """M10, model-agnostic: the AUC of a one-split model changes with its own feature permuted, and with no other."""
    pi = explain.permutation_importance(_stump(spark, d), _stump_rows(features.holdout_set(_fact(spark, d))))
    return pi.select("feature", (F.col("attribution") != 0).alias("matters"))
