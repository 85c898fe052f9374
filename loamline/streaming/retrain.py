"""Periodic retraining of the moisture regressor from completed rows only.

The training rows emitted by the moisture stream are read as a file stream
with ``Trigger.AvailableNow``. What a model was trained on is recorded with
the model: every version has a table of marks, the newest consumed (ts,
event_id) of each station, written before the version itself. A run trains on
the rows beyond the newest version's marks and saves the next version, so rows
that come again -- a replayed micro-batch of the sink, a replayed batch here,
or a lost checkpoint -- train nothing a second time. A batch that fails
validation raises, no version is written, and its rows stay queued.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamline.operators import models, online, quality
from loamline.operators.series import join_null_safe
from loamline.schemas import MOISTURE_FEATURES, MOISTURE_TARGET, SGD_LEARNING_RATE
from loamline.sources.tables import exists

MARKS = "station_id long, ts timestamp_ntz, event_id long"


def completed_training_rows(rows: DataFrame) -> DataFrame:
    return (rows.filter((F.col("store") == "training") & F.col("label").isNotNull())
            .select("station_id", "event_id", "ts", *MOISTURE_FEATURES,
                    F.col("label").alias(MOISTURE_TARGET)))


def latest_version(spark: SparkSession, model_path: str) -> models.LinearModel:
    row = spark.read.parquet(model_path).orderBy(F.col("version").desc()).limit(1).first()
    return models.LinearModel.from_json(row["state"])


def marks_path(model_path: str, version: int) -> str:
    return f"{model_path}_marks/v={version}"


def consumed_marks(spark: SparkSession, model_path: str, version: int) -> DataFrame:
    """station_id and the newest (ts, event_id) the version was trained on."""
    path = marks_path(model_path, version)
    if exists(spark, path):
        return spark.read.schema(MARKS).parquet(path)
    return spark.createDataFrame([], MARKS)


def train_batch(spark: SparkSession, batch: DataFrame, model_path: str, eta: float = SGD_LEARNING_RATE) -> bool:
    """Validate the rows beyond the newest version's marks, run one online epoch
    over them in time order and save the next version with its marks."""
    model = latest_version(spark, model_path)
    marks = consumed_marks(spark, model_path, model.version)
    seen = marks.select("station_id", F.struct("ts", "event_id").alias("_mark"))
    rows = join_null_safe(completed_training_rows(batch), seen, ["station_id"], "left")
    rows = rows.filter(F.col("_mark").isNull() | (F.struct("ts", "event_id") > F.col("_mark"))).drop("_mark")
    rows = rows.dropDuplicates(["station_id", "ts", "event_id"]).persist()  # read by the checks, the epoch and the marks
    try:
        if rows.isEmpty():
            return False
        train = rows.drop("station_id", "event_id", "ts")
        quality.check_frame(train, MOISTURE_FEATURES, MOISTURE_TARGET)
        quality.check_values(train, MOISTURE_FEATURES + [MOISTURE_TARGET])
        updated = online.sgd_epoch(rows, model, eta=eta)
        newest = (marks.unionByName(rows.select("station_id", "ts", "event_id")).groupBy("station_id")
                  .agg(F.max(F.struct("ts", "event_id")).alias("m")).select("station_id", "m.ts", "m.event_id"))
        newest.write.mode("overwrite").parquet(marks_path(model_path, updated.version))
        updated.save(spark, model_path)  # commits the version
        return True
    finally:
        rows.unpersist()


def retrain(spark: SparkSession, rows_path: str, rows_schema, model_path: str,
            checkpoint: str) -> bool:
    """One ``AvailableNow`` run over newly completed rows. Returns whether any
    batch trained."""
    trained = []

    def each(batch: DataFrame, batch_id: int) -> None:
        trained.append(train_batch(spark, batch, model_path))

    q = (spark.readStream.schema(rows_schema).parquet(rows_path)
         .writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint)
         .foreachBatch(each).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return any(trained)


def seed_model(spark: SparkSession, seed_rows: DataFrame, model_path: str) -> models.LinearModel:
    """Initial SGD fit (version 0) on the first 80 % of each station's history;
    the scaler is frozen here for every later update."""
    split = models.ordered_split(seed_rows)
    model = online.fit_sgd(split.filter(F.col("split") == "train"))[0].model
    model.save(spark, model_path)
    return model


def load_or_seed(spark: SparkSession, seed_rows: DataFrame, model_path: str) -> models.LinearModel:
    """Reuse the newest saved regressor; fit and save version 0 only when
    none exists (any other failure to read it is raised)."""
    if exists(spark, model_path):
        return latest_version(spark, model_path)
    return seed_model(spark, seed_rows, model_path)
