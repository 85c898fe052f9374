import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from loamline.operators import metrics, models, online
from loamline.schemas import MOISTURE_FEATURES, MOISTURE_TARGET, NUTRIENTS
from loamline.sources import adapters
from loamline.sources.tables import table
from loamline.streaming import fertility

from paths import SF_MID


WEIGHTS = {"prev_2": 0.8, "soil_temp": -0.4, "hour_cos": 1.5}


@pytest.fixture(scope="module")
def regression(spark):
    """A noisy linear target over drifting readings of one station (80 rows)."""
    n, rng = 80, np.random.default_rng(7)
    hours = np.arange(n) * 5 % 24
    frame = {"station_id": np.ones(n, dtype=int), "event_id": np.arange(n),
             "ts": pd.Timestamp("2023-06-01") + pd.to_timedelta(np.arange(n) * 5, unit="h"),
             "hour_sin": np.sin(hours / 24 * 2 * np.pi), "hour_cos": np.cos(hours / 24 * 2 * np.pi),
             "soil_temp": 12 + 6 * rng.random(n), "rain_fall": rng.exponential(1.5, n)}
    series = 50 + rng.normal(0, 6, n + 5)
    for lag in range(5, 0, -1):
        frame[f"prev_{lag}"] = series[5 - lag:5 - lag + n]
    pdf = pd.DataFrame(frame)
    pdf[MOISTURE_TARGET] = sum(w * pdf[c] for c, w in WEIGHTS.items()) + 3 + rng.normal(0, 0.2, n)
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_ordered_split_sizes(spark, regression):
    split = models.ordered_split(regression)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": 64, "test": 16}
    last_train = split.filter("split = 'train'").agg(F.max("event_id")).first()[0]
    assert last_train == 63
    s30 = models.ordered_split(regression, test_fraction=None, train_fraction=0.3)
    assert s30.filter("split = 'train'").count() == 24


def test_least_squares_recovers_weights(spark, regression):
    m = models.fit_least_squares(regression)
    raw = {f: w / s for f, w, s in zip(m.scaler.features, m.weights, m.scaler.std)}
    for c, w in WEIGHTS.items():
        assert raw[c] == pytest.approx(w, abs=0.15)
    r = metrics.regression_metrics(m.score(regression), MOISTURE_TARGET, "prediction").first()
    assert r.r2 > 0.95


def test_gradient_step_moves_toward_target(spark, regression):
    zero = models.LinearModel(models.Scaler.fit(regression, MOISTURE_FEATURES), [0.0] * 9, 0.0)
    row = models.gradient_step(regression, zero, eta=0.5).first()
    assert row.intercept > 0


def sequential(pdf, scaler, w, b, eta, target=MOISTURE_TARGET):
    """SGD row by row: weights, intercept and the summed loss before each step."""
    z = (pdf[MOISTURE_FEATURES].to_numpy() - np.array(scaler.mean)) / np.array(scaler.std)
    w, loss = np.array(w), 0.0
    for zi, yi in zip(z, pdf[target]):
        g = b + zi @ w - yi
        loss += g * g / 2
        w, b = w - eta * g * zi, b - eta * g
    return w, b, loss


def test_online_epoch_changes_weights_and_round_trips(spark, regression, scratch):
    base = models.fit_least_squares(regression)
    shifted = regression.withColumn(MOISTURE_TARGET, F.col(MOISTURE_TARGET) + 5.0)
    upd = online.sgd_epoch(shifted.coalesce(1), base, eta=0.01)
    assert upd.version == base.version + 1
    assert upd.intercept != base.intercept
    assert upd.scaler == base.scaler  # the scaler stays frozen
    upd.save(spark, f"{scratch}/m")
    back = models.LinearModel.load(spark, f"{scratch}/m")
    assert back == upd


def many_rows(spark, regression, n=30):
    """The rows ``n`` times over, shifted in time, dealt to a hot station and small ones."""
    copies = regression.crossJoin(spark.range(n).withColumnRenamed("id", "copy"))
    row = F.col("copy") * 1000 + F.col("event_id")
    return copies.withColumns({
        "station_id": F.when(F.col("copy") % 3 != 0, 1).when(F.col("event_id") < 5, None).otherwise(F.col("event_id") % 7 + 2),
        "ts": F.col("ts") + F.make_dt_interval(days=F.col("copy").cast("int")), "event_id": row,
        MOISTURE_TARGET: F.col(MOISTURE_TARGET) + F.sin(row)}).drop("copy")


@pytest.mark.parametrize("parts", [1, 7])
def test_online_epoch_equals_sequential_sgd(spark, regression, monkeypatch, parts):
    """Also where a task's rows come in many blocks and the fold takes several rounds."""
    monkeypatch.setattr(online, "FAN", 2)
    monkeypatch.setattr(online, "STEPS", 5)
    base = models.fit_least_squares(regression)
    rows = many_rows(spark, regression)
    upd = online.sgd_epoch(rows.repartition(parts), base, eta=0.01)
    w, b, _ = sequential(rows.orderBy("ts", "event_id").toPandas(), base.scaler, base.weights, base.intercept, 0.01)
    assert upd.weights == pytest.approx(list(w), abs=1e-9) and upd.intercept == pytest.approx(b, abs=1e-9)


def test_every_series_has_its_own_epoch(spark, regression, monkeypatch):
    """A hot station over several tasks, small stations and a NULL one, broken rows left out."""
    monkeypatch.setattr(online, "FAN", 2)
    base = models.fit_least_squares(regression)
    rows = many_rows(spark, regression)
    broken = rows.limit(5).withColumn("prev_1", F.lit(float("nan"))).unionByName(rows.limit(3).withColumn(MOISTURE_TARGET, F.lit(None)))
    got = {r.station_id: r for r in online.series_epochs(rows.unionByName(broken), base).collect()}
    pdf = rows.orderBy("ts", "event_id").toPandas()
    for station, part in pdf.groupby("station_id", dropna=False):
        r = got.pop(None if station != station else int(station))
        w, b, loss = sequential(part, base.scaler, base.weights, base.intercept, 0.01)
        assert [r[f"w_{f}"] for f in MOISTURE_FEATURES] == pytest.approx(list(w), abs=1e-9)
        assert (r.n, r.intercept, r.loss) == (len(part), pytest.approx(b, abs=1e-9), pytest.approx(loss / len(part)))
    assert not got
    spread = online.epoch_maps(rows, base.scaler, keys=["station_id"])
    assert "rangepartitioning(station_id" in spread._jdf.queryExecution().executedPlan().toString()


def test_sgd_fit_equals_sequential_epochs(spark, regression):
    """Weights and the number of epochs of the stopping rule, for several rates in one pass."""
    pdf = regression.orderBy("ts", "event_id").toPandas()
    fits = online.fit_sgd(regression, [0.1, 0.01, 1e9], max_iter=300)
    for fit in fits[:2]:
        w, b, best, bad, n_iter = np.zeros(9), 0.0, np.inf, 0, 0
        while n_iter < 300 and bad < 5:
            w, b, loss = sequential(pdf, fit.model.scaler, w, b, fit.eta)
            n_iter += 1
            bad = bad + 1 if loss > best - 1e-8 * len(pdf) else 0
            best = min(best, loss)
        assert fit.n_iter == n_iter
        assert fit.model.weights == pytest.approx(list(w), abs=1e-9) and fit.model.intercept == pytest.approx(b, abs=1e-9)
    assert np.isnan(fits[2].model.intercept)  # diverges
    assert online.fit_sgd(regression, [0.1], scaler=fits[0].model.scaler, max_iter=2)[0].n_iter == 2


def test_metrics_use_complete_pairs_only(spark):
    rows = [(1.0, 1.1), (2.0, 1.8), (3.0, None), (9.0, float("nan")), (None, 1.0), (4.0, float("inf")), (5.0, 5.2)]
    r = metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    y, p = np.array([1.0, 2.0, 5.0]), np.array([1.1, 1.8, 5.2])
    assert r.n == 3 and r.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_refit_replaces_the_saved_classifier(spark, scratch):
    nut = adapters.nutrients(table(spark, SF_MID, "embeddings"))
    path = f"{scratch}/refit"
    first = fertility.load_or_train_fertility(nut, path, num_trees=3)
    model, report = fertility.refit_fertility(nut, path, num_trees=5)
    again = fertility.load_or_train_fertility(nut, path)
    assert first.stages[-1].getNumTrees == 3 and again.stages[-1].getNumTrees == 5
    assert {"accuracy", "macro avg"} <= {r.label for r in report.collect()}
    assert fertility.newest_version(spark, path) == 1
    assert fertility.load_fertility(spark, path, 0).stages[-1].getNumTrees == 3  # the old one stays


def test_a_refit_that_dies_halfway_publishes_nothing(spark, scratch, monkeypatch):
    nut = adapters.nutrients(table(spark, SF_MID, "embeddings"))
    path = f"{scratch}/half"
    fertility.load_or_train_fertility(nut, path, num_trees=2)
    model, _ = fertility.train_fertility(nut, num_trees=4)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)  # after the folder, before the commit
    with pytest.raises(ZeroDivisionError):
        fertility.publish(spark, model, path)
    monkeypatch.undo()
    assert fertility.newest_version(spark, path) == 0
    assert fertility.load_or_train_fertility(nut, path).stages[-1].getNumTrees == 2
    assert fertility.publish(spark, model, path) == 1  # the folder left behind is written anew
    assert fertility.load_fertility(spark, path).stages[-1].getNumTrees == 4


def test_learning_rate_sweep(spark, regression):
    split = models.ordered_split(regression)
    out = online.learning_rate_sweep(split.filter("split = 'train'"), split.filter("split = 'test'"),
                                     [0.1, 0.05, 0.01, 0.005, 0.001, 0.0005], max_iter=5000)
    rows = out.orderBy(F.col("eta").desc()).collect()
    assert [r.eta for r in rows] == [0.1, 0.05, 0.01, 0.005, 0.001, 0.0005]
    assert rows[2].r2 > 0.8
    assert rows[2].n_iter < rows[-1].n_iter


def test_spark_ml_regressors_compare(spark):
    from loamline.plans.catalog import _features
    feats = _features(spark, SF_MID)
    split = models.ordered_split(feats)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    fitted = {
        "linear": models.linear_regression().fit(train),
        "forest": models.forest_regressor(num_trees=10).fit(train),
        "boosted": models.boosted_regressor(max_iter=5).fit(train),
    }
    scored = None
    for name, m in fitted.items():
        part = m.transform(test).select(F.lit(name).alias("model"), "prediction", MOISTURE_TARGET)
        scored = part if scored is None else scored.unionByName(part)
    table_ = {r.model: r for r in models.model_comparison(scored).collect()}
    assert set(table_) == {"linear", "forest", "boosted"}
    assert all(r.rmse >= 0 for r in table_.values())
    sgd = models.fit_least_squares(train)
    lin = metrics.regression_metrics(sgd.score(test), MOISTURE_TARGET, "prediction").first()
    assert lin.rmse == pytest.approx(table_["linear"].rmse, rel=1e-6)


def test_fertility_forest(spark, scratch):
    nut = adapters.nutrients(table(spark, SF_MID, "embeddings"))
    model, test = fertility.train_fertility(nut, num_trees=100)
    scored, rejected = fertility.score_fertility(nut.filter(F.col("Output").isin(0, 1)), model)
    assert rejected.count() == 0
    assert {r.predicted_fertility for r in scored.select("predicted_fertility").distinct().collect()} <= {0, 1}
    acc = metrics.accuracy(scored, "Output", "predicted_fertility").first().accuracy
    assert acc > 0.75  # full filtered data, training rows included
    model.write().overwrite().save(f"{scratch}/fertility_model")
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(f"{scratch}/fertility_model")
    a = [r.predicted_fertility for r in fertility.score_fertility(nut, model)[0].orderBy("sample_id").collect()]
    b = [r.predicted_fertility for r in fertility.score_fertility(nut, again)[0].orderBy("sample_id").collect()]
    assert a == b


def test_fertility_rejects_incomplete(spark):
    row = [1.0] * 12
    df = spark.createDataFrame([(1, *row, 0), (2, None, *row[1:], 1)],
                               "sample_id long, " + ", ".join(f"`{c}` double" for c in NUTRIENTS) + ", Output int")
    from pyspark.ml import Pipeline
    m = Pipeline(stages=[models._assembled(NUTRIENTS)]).fit(df)

    class Const:
        def transform(self, d):
            return m.transform(d).withColumn("prediction", F.lit(1.0))

    scored, rejected = fertility.score_fertility(df, Const())
    assert [r.sample_id for r in rejected.collect()] == [2]
    assert [r.valid for r in scored.collect()] == [True]


def test_decision_tree_classifier_weighted(spark):
    nut = adapters.nutrients(table(spark, SF_MID, "embeddings")).filter(F.col("Output").isin(0, 1))
    weighted = metrics.with_class_weights(nut, "Output")
    m = models.tree_classifier(NUTRIENTS, max_depth=5).fit(weighted)
    report = metrics.classification_report(m.transform(nut), "Output", "prediction")
    labels = {r.label for r in report.collect()}
    assert {"accuracy", "macro avg", "weighted avg"} <= labels


def test_random_split_is_stable_and_proportional(spark):
    df = spark.range(20000).withColumnRenamed("id", "sample_id")
    a = models.random_split(df, "sample_id")
    b = models.random_split(df.repartition(7), "sample_id")
    ja = {r.sample_id: r.split for r in a.collect()}
    jb = {r.sample_id: r.split for r in b.collect()}
    assert ja == jb
    assert sum(v == "test" for v in ja.values()) == 4000
    by_hash = sorted(ja, key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
    assert all(ja[i] == ("test" if k < 4000 else "train") for k, i in enumerate(by_hash))
    for n, want in ((0, 0), (1, 1), (5, 1), (6, 2)):  # ceil(0.2 n)
        assert models.random_split(df.limit(n), "sample_id").filter("split = 'test'").count() == want


def test_load_or_fit_reuses_saved_models(spark, regression, scratch):
    from loamline.streaming import retrain
    m0 = retrain.load_or_seed(spark, regression, f"{scratch}/moist")
    shifted = regression.withColumn(MOISTURE_TARGET, F.col(MOISTURE_TARGET) + 100.0)
    again = retrain.load_or_seed(spark, shifted, f"{scratch}/moist")
    assert again == m0  # loaded, not refitted on the new rows
    nut = adapters.nutrients(table(spark, SF_MID, "embeddings"))
    f1 = fertility.load_or_train_fertility(nut, f"{scratch}/fertility_model", num_trees=10)
    f2 = fertility.load_or_train_fertility(nut.limit(0), f"{scratch}/fertility_model", num_trees=10)
    a = [r.predicted_fertility for r in fertility.score_fertility(nut, f1)[0].orderBy("sample_id").collect()]
    b = [r.predicted_fertility for r in fertility.score_fertility(nut, f2)[0].orderBy("sample_id").collect()]
    assert a == b


def test_scaler_on_empty_frame_raises(spark, regression):
    from loamline.operators.quality import FrameContractError
    with pytest.raises(FrameContractError, match="empty"):
        models.Scaler.fit(regression.limit(0), MOISTURE_FEATURES)


def _events(spark, path):
    """Stations of 3 to 400 readings, one without a number, ties in time."""
    rows = spark.createDataFrame([(0, 3), (1, 8), (2, 150), (None, 200), (4, 400)], "user_id long, n int")
    rows = rows.select("user_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    when = F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("i") / 3) * 3600).cast("timestamp_ntz")
    rows.select((F.coalesce("user_id", F.lit(3)) * 1000 + F.col("i")).cast("long").alias("event_id"), when.alias("ts"), "user_id",
                F.lit("view").alias("event_type"), (F.pmod(F.hash("user_id", "i"), F.lit(500)) / 4.0).alias("value"),
                F.concat(F.lit('{"k": '), F.col("i"), F.lit("}")).alias("props")).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("bucket_rows", [64, 1_000_000])
def test_split_features_of_hot_and_ordinary_stations(spark, scratch, monkeypatch, bucket_rows):
    from loamline.operators import series
    from loamline.plans import catalog
    monkeypatch.setattr(series, "BUCKET_ROWS", bucket_rows)
    train, test = catalog._split_features(spark, _events(spark, scratch))
    by = lambda rows: sorted(rows.collect(), key=str)
    w = Window.partitionBy("station_id").orderBy("ts", "event_id")
    rows = adapters.readings(table(spark, scratch, "events"))
    moisture = F.col("soil_moisture") * 100
    rows = rows.select("station_id", "ts", "event_id", *(F.lag(moisture, k).over(w).alias(f"prev_{k}") for k in range(1, 6)),
                       F.lead(moisture).over(w).alias(MOISTURE_TARGET)).dropna(subset=["prev_5", MOISTURE_TARGET])
    rows = rows.withColumns({"place": F.row_number().over(w), "n": F.count("*").over(Window.partitionBy("station_id"))})
    first = F.col("place") <= F.col("n") - F.ceil(0.2 * F.col("n"))
    cols = ["station_id", "ts", "event_id", *(f"prev_{k}" for k in range(1, 6)), MOISTURE_TARGET]
    assert by(train.select(cols)) == by(rows.filter(first).select(cols))
    assert by(test.select(cols)) == by(rows.filter(~first).select(cols))
    assert train.columns == [*cols[:3], *MOISTURE_FEATURES, MOISTURE_TARGET, "split"]


def test_split_features_are_computed_once(spark, scratch):
    """Fits and scores read a table, they do not build lags and positions again."""
    from loamline.plans import catalog
    for part in catalog._split_features(spark, _events(spark, scratch)):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange" not in plan and "Scan parquet" in plan


def _samples(spark, n):
    """Labelled samples in a single partition, as adaptive execution leaves them."""
    cols = [(F.pmod(F.xxhash64("sample_id", F.lit(i)), F.lit(1000)) / 10.0).alias(c) for i, c in enumerate(NUTRIENTS)]
    rows = spark.range(n).withColumnRenamed("id", "sample_id").coalesce(1)
    return rows.select("sample_id", *cols, (F.col("sample_id") % 2).cast("int").alias("Output"), F.lit(1.0).alias("weight"))


def test_rows_of_a_fit_are_dealt_over_the_cores(spark):
    data = _samples(spark, 3000)
    rows = models.fit_rows(data, "sample_id")
    assert data.rdd.getNumPartitions() == 1 and rows.rdd.getNumPartitions() > 1
    assert sorted(rows.collect()) == sorted(data.collect())
    few = _samples(spark, 100)
    assert models.fit_rows(few, "sample_id").collect() == few.collect()


def test_fertility_fit_runs_on_several_tasks(spark, monkeypatch):
    seen = []
    real = models.forest_classifier

    def watched(*a, **kw):
        pipe = real(*a, **{**kw, "num_trees": 2, "max_depth": 3})
        fit = pipe.fit
        pipe.fit = lambda rows: (seen.append(rows.rdd.getNumPartitions()), fit(rows))[1]
        return pipe

    monkeypatch.setattr(models, "forest_classifier", watched)
    fertility.train_fertility(_samples(spark, 4000).drop("weight"))
    assert seen[0] > 1


def test_forest_with_kept_nodes_grows_the_same_trees(spark):
    rows = models.fit_rows(_samples(spark, 1200), "sample_id")
    pipe = models.forest_classifier(NUTRIENTS, num_trees=3, max_depth=12)
    kept = pipe.fit(rows).stages[-1].toDebugString
    assert pipe.getStages()[-1].getCacheNodeIds()
    pipe.getStages()[-1].setCacheNodeIds(False)
    assert pipe.fit(rows).stages[-1].toDebugString == kept
