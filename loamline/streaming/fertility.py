"""Nutrient classification: batch training job and stateless scoring that
works the same on a batch or a streaming DataFrame (narrow transformations
only, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamline.operators import metrics, models, quality
from loamline.sources.tables import exists
from loamline.schemas import (FOREST_MAX_DEPTH, FOREST_TREES, NUTRIENT_LABEL, NUTRIENTS,
                              RANDOM_TRAIN_PERCENT, SEED)


def train_fertility(nutrients: DataFrame, *, num_trees: int = FOREST_TREES,
                    max_depth: int = FOREST_MAX_DEPTH, seed: int = SEED,
                    train_percent: int = RANDOM_TRAIN_PERCENT):
    """Refit the classifier: keep labels 0/1, hash split 80/20, balanced class
    weights, random forest. Returns (model, test rows)."""
    data = quality.binary_labels(nutrients, NUTRIENT_LABEL)
    data = quality.complete_cases(data, NUTRIENTS)
    split = models.random_split(data, "sample_id", train_percent, seed)
    train = metrics.with_class_weights(split.filter(F.col("split") == "train"), NUTRIENT_LABEL)
    train = models.fit_rows(train, "sample_id")
    test = split.filter(F.col("split") == "test")
    pipe = models.forest_classifier(NUTRIENTS, NUTRIENT_LABEL, num_trees=num_trees,
                                    max_depth=max_depth, seed=seed)
    return pipe.fit(train), test


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The newest published version of the classifier at ``path``."""
    if not exists(spark, f"{path}/versions"):
        return None
    return spark.read.schema("version long").parquet(f"{path}/versions").agg(F.max("version")).first()[0]


def publish(spark: SparkSession, model, path: str) -> int:
    """Save the classifier as the next version: a folder of its own first, then
    a row in the table of versions, which commits it. A save that dies in
    between leaves the last version as it was; its folder is written anew."""
    newest = newest_version(spark, path)
    version = 0 if newest is None else newest + 1
    model.write().overwrite().save(f"{path}/models/v={version}")
    (spark.createDataFrame([(version,)], "version long").coalesce(1)
     .write.mode("append").parquet(f"{path}/versions"))
    return version


def load_fertility(spark: SparkSession, path: str, version: int | None = None):
    """A published classifier, the newest unless ``version`` says which."""
    from pyspark.ml import PipelineModel
    if version is None:
        version = newest_version(spark, path)
    return PipelineModel.load(f"{path}/models/v={version}")


def load_or_train_fertility(nutrients: DataFrame, path: str, **kw):
    """Reuse the newest published classifier; fit and publish one only when none exists."""
    spark = nutrients.sparkSession
    if newest_version(spark, path) is None:
        model, _ = train_fertility(nutrients, **kw)
        publish(spark, model, path)
    return load_fertility(spark, path)


def refit_fertility(nutrients: DataFrame, path: str, **kw) -> tuple[object, DataFrame]:
    """Refit the classifier, score its held-out rows and publish it as the next
    version. Returns (model, classification report)."""
    model, test = train_fertility(nutrients, **kw)
    scored, _ = score_fertility(test, model)
    report = metrics.classification_report(scored, NUTRIENT_LABEL, "predicted_fertility")
    publish(nutrients.sparkSession, model, path)
    return model, report


def split_rows(nutrients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejected rows with a reason), after the frame contract:
    a missing or non-numeric nutrient column raises ``FrameContractError``."""
    quality.check_frame(nutrients.select(*[c for c in nutrients.columns if c in NUTRIENTS]), NUTRIENTS)
    return quality.split_complete(nutrients, NUTRIENTS)


def score_fertility(nutrients: DataFrame, model) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected). Incomplete rows are rejected before scoring;
    predictions outside {0, 1} are flagged ``valid = false``."""
    ok, rejected = split_rows(nutrients)
    ok = ok.withColumns({c: F.col(c).cast("float").cast("double") for c in NUTRIENTS})
    scored = model.transform(ok).select(
        *nutrients.columns, F.col("prediction").cast("int").alias("predicted_fertility"))
    scored = scored.withColumn("valid", F.col("predicted_fertility").isin(0, 1))
    return scored, rejected


def audit_rows(nutrients: DataFrame, model) -> DataFrame:
    """Every row: scored, or rejected with a reason and no prediction."""
    scored, rejected = score_fertility(nutrients, model)
    return scored.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejected.withColumns({"predicted_fertility": F.lit(None).cast("int"), "valid": F.lit(False)}))


def fertility_stream(nutrient_stream: DataFrame, model, sink_path: str, checkpoint: str):
    """Stream nutrient rows through the classifier into an append-only audit
    table that holds the rejected rows, too."""
    return (audit_rows(nutrient_stream, model).writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append").start())
