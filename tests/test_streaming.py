"""The streaming cycle equals the batch derivations; retraining consumes
completed rows exactly once."""

import os

import pytest
from pyspark.sql import functions as F

from loamline.operators import backfill, features, models
from loamline.plans.catalog import _fixed_model
from loamline.schemas import MOISTURE_FEATURES
from loamline.sources import adapters
from loamline.sources.tables import table
from loamline.operators import quality
from loamline.streaming import moisture, retrain

from paths import SF_SMALL

from loamline.schemas import READINGS as READ_SCHEMA  # noqa: E402


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stream"))
    readings = adapters.readings(table(spark, SF_SMALL, "events"), guard_errors=True)
    # three files in time order -> three micro-batches
    days = [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]
    for i, (a, b) in enumerate(days):
        part = readings.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) &
                               (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("overwrite").parquet(f"{base}/in/{i}")
    src = (spark.readStream.schema(READ_SCHEMA).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    model = _fixed_model()
    out = moisture.moisture_cycles(src, model)
    q = (out.writeStream.foreachBatch(moisture.idempotent_sink(f"{base}/out"))
         .option("checkpointLocation", f"{base}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    return base, readings, model


def _store(spark, base, name):
    return spark.read.parquet(f"{base}/out").filter(F.col("store") == name)


def test_permanent_rows_equal_batch(spark, streamed):
    base, readings, _ = streamed
    got = {r.event_id: r for r in _store(spark, base, "permanent").collect()}
    want = {r.event_id: r for r in backfill.completed(features.feature_rows_compat(readings)).collect()}
    assert set(got) == set(want) and len(got) > 0
    for k, w in want.items():
        assert got[k].label == pytest.approx(w.future_moisture)
        assert [got[k][c] for c in MOISTURE_FEATURES] == pytest.approx([w[c] for c in MOISTURE_FEATURES])


def test_training_rows_equal_batch(spark, streamed):
    base, readings, _ = streamed
    got = {r.event_id: r.label for r in _store(spark, base, "training").collect()}
    queue = backfill.training_rows(features.compat_cycles(readings))
    want = {r.event_id: r.future_moisture for r in backfill.completed(queue).collect()}
    assert got == pytest.approx(want)


def test_prediction_log_equals_batch(spark, streamed):
    base, readings, model = streamed
    got = {r.event_id: (r.predicted, r.label, r.absolute_error)
           for r in _store(spark, base, "prediction").collect()}
    cyc = model.score(features.compat_cycles(readings), "predicted")
    log = backfill.prediction_log(cyc, "predicted").filter(F.col("actual_moisture").isNotNull())
    want = {r.event_id: (r.predicted_moisture, r.actual_moisture, r.absolute_error) for r in log.collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_rejects_have_reasons(spark, streamed):
    base, readings, _ = streamed
    rej = _store(spark, base, "rejected")
    reasons = {r.reason.split(":")[0] for r in rej.select("reason").distinct().collect()}
    assert reasons <= {"incomplete", "prediction out of range", "late"}
    assert rej.filter(F.col("reason").startswith("incomplete")).count() > 0


def test_retraining_consumes_once(spark, streamed, tmp_path):
    base, readings, _ = streamed
    model_path, ckpt = str(tmp_path / "model"), str(tmp_path / "rckpt")
    seed = features.moisture_features(readings)
    v0 = retrain.seed_model(spark, seed, model_path)
    schema = spark.read.parquet(f"{base}/out").schema
    assert retrain.retrain(spark, f"{base}/out", schema, model_path, ckpt) is True
    v1 = retrain.latest_version(spark, model_path)
    assert v1.version > v0.version and v1.weights != v0.weights and v1.scaler == v0.scaler
    # nothing new completed: no training, no new version
    assert retrain.retrain(spark, f"{base}/out", schema, model_path, ckpt) is False
    assert retrain.latest_version(spark, model_path).version == v1.version


def test_replayed_rows_and_a_lost_checkpoint_train_nothing(spark, streamed, tmp_path):
    base, readings, _ = streamed
    model_path = str(tmp_path / "model")
    retrain.seed_model(spark, features.moisture_features(readings), model_path)
    rows = spark.read.parquet(f"{base}/out")
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    run = lambda ckpt: retrain.retrain(spark, path, rows.schema, model_path, str(tmp_path / ckpt))
    assert run("a") is True
    v1 = retrain.latest_version(spark, model_path)
    rows.write.mode("append").parquet(path)  # the sink writes the same rows again
    assert run("a") is False
    assert run("b") is False  # a new checkpoint reads everything again
    assert retrain.latest_version(spark, model_path) == v1


def test_retraining_rejects_bad_rows_and_keeps_them(spark, tmp_path):
    rows = spark.createDataFrame(
        [("training", 1, 1, None) + (1.0,) * 9 + (float("nan"),)],
        "store string, station_id long, event_id long, ts timestamp_ntz, "
        + ", ".join(f"{c} double" for c in MOISTURE_FEATURES) + ", label double")
    rows.write.parquet(str(tmp_path / "rows"))
    zero = models.LinearModel(models.Scaler(MOISTURE_FEATURES, [0.0] * 9, [1.0] * 9), [0.0] * 9, 0.0)
    zero.save(spark, str(tmp_path / "model"))
    with pytest.raises(Exception):
        retrain.retrain(spark, str(tmp_path / "rows"), rows.schema, str(tmp_path / "model"), str(tmp_path / "ck"))
    assert retrain.latest_version(spark, str(tmp_path / "model")).version == 0


@pytest.fixture(scope="module")
def windowed(spark, tmp_path_factory, streamed):
    from loamline.streaming import windowed as wmod
    base, readings, model = streamed
    wbase = str(tmp_path_factory.mktemp("wstream"))
    src = (spark.readStream.schema(READ_SCHEMA).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    q = (src.writeStream.foreachBatch(wmod.windowed_sink(spark, model, f"{wbase}/out", f"{wbase}/state"))
         .option("checkpointLocation", f"{wbase}/ckpt").start())
    q.processAllAvailable()
    q.stop()
    return wbase


@pytest.mark.parametrize("store", ["permanent", "training", "prediction", "rejected"])
def test_windowed_stream_equals_state_machine(spark, streamed, windowed, store):
    """Both streaming paths emit the same rows, and the state machine equals
    the batch derivation (tests above), so the windowed path does too."""
    base, _, _ = streamed
    cols = ["event_id", "label", "predicted", "absolute_error", "reason"] + MOISTURE_FEATURES
    a = sorted(tuple(r) for r in _store(spark, base, store).select(*cols).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(f"{windowed}/out").filter(F.col("store") == store)
               .select(*cols).collect())
    assert len(a) == len(b) and len(a) > 0
    for x, y in zip(a, b):
        assert x[0] == y[0] and x[4] == y[4]
        assert [v for v in x[1:4] + x[5:]] == pytest.approx([v for v in y[1:4] + y[5:]], nan_ok=True)


def test_windowed_tail_is_bounded(spark, windowed):
    from loamline.streaming import windowed as wmod
    tail = wmod.read_tail(spark, f"{windowed}/state", 2)
    assert tail.groupBy("station_id").count().agg(F.max("count")).first()[0] <= 14
    # folders that the last two manifests do not name are gone
    named = {(p, at) for n in (1, 2) for p, at in wmod._manifest(spark, f"{windowed}/state", n).items()}
    left = spark.read.parquet(f"{windowed}/state/tail").select("part", "batch_id").distinct().collect()
    assert {(r.part, r.batch_id) for r in left} == named
    assert not os.path.exists(f"{windowed}/state/manifest/batch_id=0")


def test_a_hot_station_of_a_batch_is_cut(spark, streamed, monkeypatch):
    """The same rows and tail with one window per station and with small buckets."""
    from loamline.operators import series
    from loamline.streaming import windowed as wmod
    _, readings, model = streamed
    rows = lambda df: sorted(map(str, df.collect()))
    first, second = (readings.filter(f"ts {op} timestamp_ntz'2024-01-16'") for op in ("<", ">="))
    _, tail = wmod.cycle_batch(first, spark.createDataFrame([], wmod.TAIL_SCHEMA), model, whole=True)
    tail = tail.cache()
    want = wmod.cycle_batch(second, tail, model, whole=True)
    monkeypatch.setattr(series, "BUCKET_ROWS", 12)
    got = wmod.cycle_batch(second, tail, model, sized=True)
    assert rows(got[0]) == rows(want[0]) and rows(got[1]) == rows(want[1])


def test_state_written_follows_the_stations_of_a_batch(spark, streamed, tmp_path):
    """A batch of one station rewrites one state partition; a replayed batch changes nothing."""
    from loamline.streaming import windowed as wmod
    _, readings, model = streamed
    first = readings.filter("ts < timestamp_ntz'2024-01-11'")
    one = first.agg(F.min("station_id")).first()[0]
    second = readings.filter((F.col("station_id") == one) & (F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz")))
    sink = wmod.windowed_sink(spark, model, f"{tmp_path}/out", f"{tmp_path}/state")
    sink(first, 0)
    sink(second, 1)
    written = spark.read.parquet(f"{tmp_path}/state/tail/batch_id=1")
    assert written.select("part").distinct().count() == 1
    assert written.count() < spark.read.parquet(f"{tmp_path}/state/tail/batch_id=0").count() / 5
    rows = lambda df: sorted(map(str, df.drop("logged_at").collect()))
    out, tail = rows(spark.read.parquet(f"{tmp_path}/out")), rows(wmod.read_tail(spark, f"{tmp_path}/state", 1))
    sink(second, 1)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == out
    assert rows(wmod.read_tail(spark, f"{tmp_path}/state", 1)) == tail
    both = wmod.cycle_batch(first.unionByName(second), spark.createDataFrame([], wmod.TAIL_SCHEMA), model, whole=True)
    assert rows(spark.read.parquet(f"{tmp_path}/out").select(both[0].columns)) == rows(both[0])
    sink(second.limit(0), 2)  # an empty batch keeps the state
    assert rows(wmod.read_tail(spark, f"{tmp_path}/state", 2)) == tail


def test_fertility_stream_appends_scored_rows(spark, tmp_path):
    from loamline.schemas import NUTRIENT_ROWS
    from loamline.streaming import fertility
    nut = adapters.nutrients(table(spark, SF_SMALL, "embeddings"))
    model, _ = fertility.train_fertility(nut, num_trees=10)
    nut = adapters.gappy_nutrients(nut)
    nut.write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(NUTRIENT_ROWS).parquet(str(tmp_path / "in"))
    q = fertility.fertility_stream(src, model, str(tmp_path / "audit"), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    got = {r.sample_id: r.predicted_fertility for r in spark.read.parquet(str(tmp_path / "audit")).collect()}
    want = {r.sample_id: r.predicted_fertility for r in fertility.audit_rows(nut, model).collect()}
    assert got == want and len(got) == nut.count()
    reasons = {r.sample_id: r.reason for r in spark.read.parquet(str(tmp_path / "audit")).collect()}
    assert reasons[50] == "incomplete: N" and reasons[75] == "incomplete: Fe" and reasons[1] is None
    with pytest.raises(quality.FrameContractError):
        fertility.score_fertility(nut.drop("K"), model)
