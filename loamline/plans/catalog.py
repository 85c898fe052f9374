"""Registered queries: one per operator of the inventory, each taking
``(spark, sf_dir)`` and returning a lazy DataFrame over the driver tables.

Float aggregates are rounded to 6 decimals (plus 0.0, which folds -0.0 into
0.0) so that sums taken in a different order by the DuckDB oracle hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamline.functions.scalar import float32, hour_cos, hour_sin, round_half_even, to_number
from loamline.operators import backfill, features, metrics, models, online, quality, series, trees
from loamline.schemas import (BOOSTED_TRAIN_FRACTION, FOREST_CLASSIFIER_DEPTH, KEYS, MOISTURE_FEATURES,
                              MOISTURE_TARGET, NUTRIENTS, ORDER, SWEEP_LEARNING_RATES)
from loamline.session import materialized
from loamline.sources import adapters
from loamline.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# The stand-in linear model used where a query needs weights
# that DuckDB can apply, too.
FIXED_WEIGHTS = {"prev_1": 0.65, "prev_4": 0.25, "soil_temp": 0.04}
# Fixed value: snapshot time of the retraining run in ``flush_remaining``.
RETRAIN_CUTOFF = "2024-01-20 00:00:00"


def r6(c):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6) + F.lit(0.0)


def _readings(spark, sf, guard=False):
    return adapters.readings(table(spark, sf, "events"), guard_errors=guard)


def _features(spark, sf):
    return features.moisture_features(_readings(spark, sf))


def _replayed(spark, sf, each):
    """``each(cycles, **how)`` over the replayed live loop."""
    return backfill.replayed(_readings(spark, sf, guard=True), each)


def _compat(spark, sf):
    return features.feature_rows_compat(_readings(spark, sf, guard=True))


def _queue(spark, sf):
    return _replayed(spark, sf, backfill.training_rows)


def _nutrients(spark, sf):
    return adapters.nutrients(table(spark, sf, "embeddings"))


def _fixed_model() -> models.LinearModel:
    feats = list(FIXED_WEIGHTS)
    return models.LinearModel(models.Scaler(feats, [0.0] * len(feats), [1.0] * len(feats)),
                              [FIXED_WEIGHTS[f] for f in feats], 0.0)


# ------------------------------------------------------------------ queries

def q_moisture_features(spark, sf):
    return _features(spark, sf).drop("ts")


def q_moisture_features_sql(spark, sf):
    from loamline.plans.sql import moisture_features_sql
    return moisture_features_sql(spark, _readings(spark, sf)).drop("ts")


def q_normalise_readings(spark, sf):
    ev = table(spark, sf, "events")
    raw = ev.select(F.col("user_id").alias("station_id"), "event_id",
                    hour_sin(F.hour("ts")).alias("Hour_sin"), hour_cos(F.hour("ts")).alias("Hour_cos"),
                    F.get_json_object("props", "$.k").try_cast("double").alias("Soil_Temp"),
                    F.col("value").alias("Rainfall"),
                    (F.col("value") / F.lit(adapters.MOISTURE_DIVISOR)).alias("Soil_Moisture"))
    return features.normalise_columns(raw)


def q_drop_keys(spark, sf):
    return _features(spark, sf).drop("id", "station_id", "event_id", "ts")


def q_hour_encoding(spark, sf):
    r = _readings(spark, sf)
    return r.select("station_id", "event_id", "hour", hour_sin("hour").alias("hour_sin"),
                    hour_cos("hour").alias("hour_cos"))


def q_round_half_even(spark, sf):
    ev = table(spark, sf, "events")
    x = F.col("value") / F.lit(3.0)
    return ev.select("event_id", x.alias("x"), round_half_even(x).alias("x_rounded"))


def q_float32_features(spark, sf):
    return _features(spark, sf).select("event_id", *[float32(c).alias(c) for c in MOISTURE_FEATURES])


def q_coerce_numeric(spark, sf):
    ev = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.get_json_object("props", "$.k"))
    return ev.select("event_id", text.alias("raw_text")).withColumn("number", to_number("raw_text"))


def q_valid_labels(spark, sf):
    ev = adapters.gappy_scores(table(spark, sf, "events").select(
        "event_id", (F.col("value") / F.lit(100.0)).alias("score")), "score")
    return quality.valid_labels(ev, "score").drop("score")


def q_binary_labels(spark, sf):
    return quality.binary_labels(_nutrients(spark, sf))


def q_completed_rows(spark, sf):
    return backfill.completed(_compat(spark, sf)).drop("ts")


def q_pending_rows(spark, sf):
    return backfill.pending(_queue(spark, sf)).drop("ts")


def q_complete_cases(spark, sf):
    return quality.complete_cases(_readings(spark, sf, guard=True).drop("ts"))


def q_accepted_cycles(spark, sf):
    acc, _ = quality.split_complete(_readings(spark, sf, guard=True).drop("ts"),
                                    ["hour", "soil_temp", "rain_fall", "soil_moisture"])
    return acc


def q_rejected_cycles(spark, sf):
    _, rej = quality.split_complete(_readings(spark, sf, guard=True).drop("ts"),
                                    ["hour", "soil_temp", "rain_fall", "soil_moisture"])
    return rej


def q_range_check(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("value").alias("predicted"))
    return quality.range_check(ev, "predicted")


def q_null_profile(spark, sf):
    return quality.null_profile(_readings(spark, sf, guard=True),
                                ["hour", "soil_temp", "rain_fall", "soil_moisture"])


def q_row_ids_gaps(spark, sf):
    """Every row is numbered, also where the station or the time is NULL."""
    r = adapters.gappy_keys(_readings(spark, sf))
    return series.row_ids(r, KEYS, ORDER).select("station_id", "event_id", "row_id")


def q_row_ids(spark, sf):
    return series.row_ids(_readings(spark, sf), KEYS, ORDER).select("station_id", "event_id", "row_id")


def q_last_n_completed(spark, sf):
    done = backfill.completed(_compat(spark, sf))
    return series.last_n(done, KEYS, ORDER, 5).select("station_id", "event_id", "prev_1", MOISTURE_TARGET)


def q_latest_pending(spark, sf):
    return backfill.latest_pending(_queue(spark, sf)).select(
        "station_id", "event_id", *MOISTURE_FEATURES)


def q_latest_reading(spark, sf):
    return series.latest(_readings(spark, sf), KEYS, ORDER, ["soil_moisture"]).drop("ts")


def q_preview_first_n(spark, sf):
    return _features(spark, sf).orderBy(*KEYS, *ORDER).limit(5).drop("ts")


def q_history_union(spark, sf):
    done = backfill.completed(_compat(spark, sf))
    history = series.last_n(done, KEYS, ORDER, 5).select(
        "station_id", "event_id", "soil_temp", "prev_1", MOISTURE_TARGET)
    current = series.latest(_readings(spark, sf), KEYS, ORDER,
                            ["hour", "soil_temp", "soil_moisture"]).drop("ts")
    return history.unionByName(current, allowMissingColumns=True)


def q_feature_rows_compat(spark, sf):
    return _compat(spark, sf).drop("ts")


def q_backfill_future(spark, sf):
    return _replayed(spark, sf, backfill.backfill_future).select(
        "station_id", "event_id", "soil_moisture", "future_permanent", "future_training")


def _prediction_log(spark, sf):
    model = _fixed_model()
    return _replayed(spark, sf, lambda cycles, **how: backfill.prediction_log(
        model.score(cycles, "predicted"), "predicted", **how))


def q_prediction_log(spark, sf):
    return _prediction_log(spark, sf).drop("ts")


def q_pending_predictions(spark, sf):
    """Logged predictions still waiting for the next logged reading."""
    log = _prediction_log(spark, sf)
    return backfill.pending(log, "actual_moisture").drop("ts")


def q_flush_remaining(spark, sf, cutoff: str = RETRAIN_CUTOFF):
    at = F.lit(cutoff).cast("timestamp_ntz")
    return _replayed(spark, sf, lambda cycles, **how: backfill.flush_remaining(cycles, at, **how)).select(
        "station_id", "event_id", MOISTURE_TARGET)


def q_target_correlation(spark, sf):
    out = metrics.target_correlation(_features(spark, sf), MOISTURE_FEATURES, MOISTURE_TARGET)
    return out.withColumn("correlation", r6("correlation"))


def q_scaler_stats(spark, sf):
    out = metrics.scaler_stats(_features(spark, sf), MOISTURE_FEATURES)
    return out.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


def q_regression_metrics(spark, sf):
    out = metrics.regression_metrics(_features(spark, sf), MOISTURE_TARGET, "prev_1")
    return out.select(r6("r2").alias("r2"), r6("rmse").alias("rmse"), "n")


def q_regression_metrics_gaps(spark, sf):
    """Rows without a usable prediction (NULL, NaN, infinite) do not count."""
    scored = adapters.gappy_scores(_features(spark, sf), "prev_1", huge=float("inf"))
    out = metrics.regression_metrics(scored, MOISTURE_TARGET, "prev_1")
    return out.select(r6("r2").alias("r2"), r6("rmse").alias("rmse"), "n")


def q_nutrient_correlation(spark, sf):
    """Correlation with the raw label, before labels other than 0 and 1 are dropped."""
    out = metrics.target_correlation(_nutrients(spark, sf), NUTRIENTS, "Output")
    return out.withColumn("correlation", r6("correlation"))


def q_fertility_rejects(spark, sf):
    from loamline.streaming import fertility
    _, rejected = fertility.split_rows(adapters.gappy_nutrients(_nutrients(spark, sf)))
    return rejected.select("sample_id", "reason")


def q_null_profile_all(spark, sf):
    """The profile of every column, text and time columns included."""
    return quality.null_profile(adapters.gappy_keys(table(spark, sf, "events").select(
        F.col("user_id").alias("station_id"), "event_id", "ts", "event_type", "value")))


def q_daily_mae(spark, sf):
    log = _prediction_log(spark, sf)
    return metrics.daily_mae(log).select("day", r6("mae").alias("mae"), "n")


def q_classification_report(spark, sf):
    pairs = adapters.label_pairs(table(spark, sf, "labels"))
    out = metrics.classification_report(pairs, "actual", "predicted")
    return out.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


def q_accuracy(spark, sf):
    pairs = adapters.label_pairs(table(spark, sf, "labels"))
    return metrics.accuracy(pairs, "actual", "predicted").select(r6("accuracy").alias("accuracy"), "n")


def q_class_weights(spark, sf):
    out = metrics.class_weights(quality.binary_labels(_nutrients(spark, sf)), "Output")
    return out.select("Output", "n_c", r6("weight").alias("weight"))


def q_queue_counts(spark, sf):
    return metrics.queue_counts(_queue(spark, sf), MOISTURE_TARGET)


def q_distinct_labels(spark, sf):
    return metrics.distinct_values(_nutrients(spark, sf), "Output")


def q_fertility_correct(spark, sf):
    nut = _nutrients(spark, sf)
    preds = nut.select("sample_id", F.when(F.col("N") >= 0, F.lit(1)).otherwise(F.lit(0))
                       .alias("predicted_fertility"))
    truth = quality.binary_labels(nut).select("sample_id", F.col("Output").alias("actual_fertility"))
    joined = preds.join(truth, "sample_id", "left")
    return joined.withColumn("correct", (F.col("predicted_fertility") == F.col("actual_fertility")).cast("int"))


def q_ordered_split_gaps(spark, sf):
    r = adapters.gappy_keys(_readings(spark, sf))
    return models.ordered_split(r).select("station_id", "event_id", "split")


def q_ordered_split_30(spark, sf):
    """The first 30 % of each series train."""
    split = models.ordered_split(_readings(spark, sf), test_fraction=None, train_fraction=BOOSTED_TRAIN_FRACTION)
    return split.select("station_id", "event_id", "split")


def q_ordered_split(spark, sf):
    return models.ordered_split(_features(spark, sf)).select("station_id", "event_id", "split")


def q_standardise(spark, sf):
    feats = _features(spark, sf)
    scaler = models.Scaler.fit(feats, MOISTURE_FEATURES)  # 9 rows to the driver
    z = models.standardise(feats, scaler)
    return z.select("station_id", "event_id", *[r6(c).alias(c) for c in MOISTURE_FEATURES])


def q_gram_moments(spark, sf):
    feats = _features(spark, sf)
    scaler = models.Scaler(MOISTURE_FEATURES, [0.0] * 9, [1.0] * 9)
    g = models.gram_moments(feats, MOISTURE_FEATURES, MOISTURE_TARGET, scaler)
    return g.select(*[r6(c).alias(c) if c != "n" else F.col(c) for c in g.columns])


def q_sgd_step(spark, sf):
    feats = _features(spark, sf)
    zero = models.LinearModel(models.Scaler(MOISTURE_FEATURES, [0.0] * 9, [1.0] * 9), [0.0] * 9, 0.0)
    g = models.gradient_step(feats, zero)
    return g.select(*[r6(c).alias(c) for c in g.columns])


def q_score_linear(spark, sf):
    out = _fixed_model().score(_features(spark, sf))
    return out.select("station_id", "event_id", r6("prediction").alias("prediction"))


def q_model_comparison(spark, sf):
    split = models.ordered_split(_features(spark, sf))
    test = split.filter(F.col("split") == "test")
    preds = {
        "persistence": F.col("prev_1"),
        "mean5": (F.col("prev_1") + F.col("prev_2") + F.col("prev_3") + F.col("prev_4") + F.col("prev_5")) / F.lit(5.0),
        "fixed_linear": _fixed_model().predict(),
    }
    # every prediction in one projection, one row each, one aggregation
    each = F.array(*(F.struct(F.lit(name).alias("model"), e.alias("prediction")) for name, e in preds.items()))
    scored = test.select(MOISTURE_TARGET, F.explode(each).alias("p")).select(MOISTURE_TARGET, "p.*")
    out = models.model_comparison(scored)
    return out.select("model", r6("r2").alias("r2"), r6("rmse").alias("rmse"))


def q_cycle_outputs(spark, sf):
    """The prediction cycle over the whole readings table as one micro-batch
    (empty tail): permanent, training, prediction and rejected rows."""
    from loamline.streaming import windowed
    tail, model = spark.createDataFrame([], windowed.TAIL_SCHEMA), _fixed_model()
    emitted = series.per_size(
        _readings(spark, sf, guard=True), KEYS, ORDER, lambda rows, part: windowed.cycle_batch(
            rows, tail, model, **({"whole": True} if part is None else {"bucket": part}))[0])
    return emitted.drop("ts")


# ------------------------------------- metric scans at volume (lineitem)

# lineitem's numeric measure columns and the target they are
# profiled against.
LINEITEM_MEASURES = ["l_quantity", "l_discount", "l_tax"]
LINEITEM_TARGET = "l_extendedprice"


def q_lineitem_profile(spark, sf):
    li = table(spark, sf, "lineitem")
    return quality.null_profile(li, LINEITEM_MEASURES + [LINEITEM_TARGET])


def q_lineitem_correlation(spark, sf):
    li = table(spark, sf, "lineitem")
    out = metrics.target_correlation(li, LINEITEM_MEASURES, LINEITEM_TARGET)
    return out.withColumn("correlation", r6("correlation"))


def q_lineitem_scaler_stats(spark, sf):
    li = table(spark, sf, "lineitem")
    out = metrics.scaler_stats(li, LINEITEM_MEASURES + [LINEITEM_TARGET])
    return out.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


# ------------------------------------------- model queries (rows-only checks)

def _split_features(spark, sf, **kw):
    """(train, test) feature rows. Lags and positions come from one dealing of the
    readings by the size of their key, and the rows are kept as a table: fits and
    scores pass over them several times."""
    def each(rows, part):
        how = {"whole": part is None, "bucket": part}
        out = models.ordered_split(features.moisture_features(rows, **how), **how, **kw)
        return out.drop(series.PART)

    split = materialized(series.per_size(_readings(spark, sf), KEYS, ORDER, each), "moisture-split")
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def q_least_squares_fit(spark, sf):
    train, _ = _split_features(spark, sf)
    m = models.fit_least_squares(train)
    rows = [(f, w, mu, sd) for f, w, mu, sd in zip(m.scaler.features, m.weights, m.scaler.mean, m.scaler.std)]
    rows.append(("intercept", m.intercept, None, None))
    return spark.createDataFrame(rows, "feature string, weight double, mean double, std double")


def _zero_model(train):
    """Zero weights over the training rows' scaler."""
    scaler = models.Scaler.fit(train, MOISTURE_FEATURES)
    return models.LinearModel(scaler, [0.0] * len(MOISTURE_FEATURES), 0.0)


def _weights(spark, m):
    rows = [*zip(m.scaler.features, m.weights), ("intercept", m.intercept)]
    return spark.createDataFrame(rows, "feature string, weight double").withColumn("weight", r6("weight"))


def q_online_epoch(spark, sf):
    """One online epoch over the completed rows of all stations, in time order."""
    train, _ = _split_features(spark, sf)
    return _weights(spark, online.sgd_epoch(backfill.completed(_queue(spark, sf)), _zero_model(train)))


def q_station_epochs(spark, sf):
    """Every station's own online epoch over its completed rows."""
    train, _ = _split_features(spark, sf)
    out = online.series_epochs(backfill.completed(_queue(spark, sf)), _zero_model(train))
    values = [c for c in out.columns if c not in ("station_id", "n")]
    return out.select("station_id", "n", *(r6(c).alias(c) for c in values))


def q_sgd_fit(spark, sf):
    """The configured SGD fit with its stopping rule: weights and epochs."""
    train, _ = _split_features(spark, sf)
    fit = online.fit_sgd(train)[0]
    return _weights(spark, fit.model).withColumn("n_iter", F.lit(fit.n_iter).cast("long"))


def q_learning_rate_sweep(spark, sf):
    train, test = _split_features(spark, sf)
    out = online.learning_rate_sweep(train, test, SWEEP_LEARNING_RATES)
    return out.select("eta", "n_iter", r6("r2").alias("r2"))


def _fitted_comparison(spark, sf, fitted: dict, test):
    scored = None
    for name, m in fitted.items():
        part = m.transform(test).select(F.lit(name).alias("model"), "prediction", MOISTURE_TARGET)
        scored = part if scored is None else scored.unionByName(part)
    return models.model_comparison(scored)


def q_fitted_model_comparison(spark, sf):
    train, test = _split_features(spark, sf)
    fitted = {"linear": models.linear_regression().fit(train),
              "forest": models.forest_regressor().fit(train)}
    sgd = online.fit_sgd(train)[0].model
    sgd_rows = sgd.score(test).select(F.lit("sgd").alias("model"), "prediction", MOISTURE_TARGET)
    out = _fitted_comparison(spark, sf, fitted, test)
    return out.unionByName(models.model_comparison(sgd_rows))


def q_boosted_regression(spark, sf):
    train, test = _split_features(spark, sf, test_fraction=None, train_fraction=BOOSTED_TRAIN_FRACTION)
    return _fitted_comparison(spark, sf, {"boosted": models.boosted_regressor().fit(train)}, test)


def _nutrient_split(spark, sf):
    data = quality.binary_labels(_nutrients(spark, sf))
    split = models.random_split(data, "sample_id")
    train = metrics.with_class_weights(split.filter(F.col("split") == "train"), "Output")
    return train, split.filter(F.col("split") == "test")


def q_best_split(spark, sf):
    """The root split of an exact tree over the weighted training rows."""
    train, _ = _nutrient_split(spark, sf)
    best = trees.best_splits(materialized(trees.tree_rows(train, NUTRIENTS, "Output", "weight"), "tree-rows"))
    return best.select("feature", r6("threshold").alias("threshold"), r6("gain").alias("gain"))


def q_random_split(spark, sf):
    return models.random_split(quality.binary_labels(_nutrients(spark, sf)), "sample_id").select(
        "sample_id", "Output", "split")


def q_classifier_reports(spark, sf):
    train, test = _nutrient_split(spark, sf)
    train = models.fit_rows(train, "sample_id")
    fitted = {"tree": models.tree_classifier(NUTRIENTS).fit(train),
              "forest": models.forest_classifier(NUTRIENTS, max_depth=FOREST_CLASSIFIER_DEPTH).fit(train)}
    out = None
    for name, m in fitted.items():
        scored = m.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
        rep = metrics.classification_report(scored, "Output", "prediction")
        rep = rep.select(F.lit(name).alias("model"), "*")
        out = rep if out is None else out.unionByName(rep)
    return out


def q_fertility_scoring(spark, sf):
    from loamline.streaming import fertility
    nut = _nutrients(spark, sf)
    model, _ = fertility.train_fertility(nut)
    scored, rejected = fertility.score_fertility(nut, model)
    return scored.select("sample_id", "Output", "predicted_fertility", "valid")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
