"""Map the driver tables onto the soil data model.

* readings  <- events:     station = user, temperature from ``props.k``,
                           rain = value, moisture fraction = value / 500.
* nutrients <- embeddings: the first 12 vector elements, label = label.
* binary prediction pairs <- labels: actual = quality, predicted = 1 - toxic.

Each adapter has a DuckDB twin in ``loamline.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loamline.functions.scalar import json_number
from loamline.schemas import NUTRIENTS, NUTRIENT_LABEL

# Fixed value: moisture fraction = value / MOISTURE_DIVISOR.
MOISTURE_DIVISOR = 500.0


def readings(events: DataFrame, guard_errors: bool = False) -> DataFrame:
    """Hourly readings per station. With ``guard_errors`` the temperature of
    ``error`` events is NULL, which exercises the incomplete-row guard."""
    temp = json_number("props", "k")
    if guard_errors:
        temp = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(temp)
    return events.select(
        F.col("user_id").alias("station_id"),
        "event_id",
        "ts",
        F.hour("ts").alias("hour"),
        temp.alias("soil_temp"),
        F.col("value").alias("rain_fall"),
        (F.col("value") / F.lit(MOISTURE_DIVISOR)).alias("soil_moisture"),
    )


def nutrients(embeddings: DataFrame) -> DataFrame:
    """Twelve nutrient columns (float vector elements widened to double) and
    the raw label (0..9; only 0 and 1 are valid fertility labels)."""
    cols = [F.element_at("embedding", i + 1).cast("double").alias(n) for i, n in enumerate(NUTRIENTS)]
    return embeddings.select(F.col("vec_id").alias("sample_id"), *cols,
                             F.col("label").alias(NUTRIENT_LABEL))


def label_pairs(labels: DataFrame) -> DataFrame:
    """(actual, predicted) 0/1 pairs keyed by ``doc_id``."""
    return labels.select("doc_id", F.col("quality").alias("actual"),
                         (F.lit(1) - F.col("toxic")).alias("predicted"))


# Which rows of the driver tables the variants below spoil.
def gappy_keys(rows: DataFrame) -> DataFrame:
    """Some rows without a station, some without a time."""
    return rows.withColumns({
        "station_id": F.when(F.col("event_id") % 97 != 0, F.col("station_id")),
        "ts": F.when(F.col("event_id") % 89 != 0, F.col("ts"))})


def gappy_scores(rows: DataFrame, col: str, huge: float = 1e300) -> DataFrame:
    """Some scores NULL, some NaN, some huge."""
    i = F.col("event_id")
    return rows.withColumn(col, F.when(i % 101 == 0, F.lit(float("nan"))).when(i % 103 == 0, F.lit(huge))
                           .when(i % 107 != 0, F.col(col)))


def gappy_nutrients(rows: DataFrame) -> DataFrame:
    """Some samples without nitrogen, some without iron."""
    return rows.withColumns({"N": F.when(F.col("sample_id") % 50 != 0, F.col("N")),
                             "Fe": F.when(F.col("sample_id") % 75 != 0, F.col("Fe"))})
