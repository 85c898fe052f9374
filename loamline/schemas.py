"""Fixed schemas and column lists of the soil data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Feature and nutrient column names and their order, as the
# trained models expect them.
MOISTURE_FEATURES = ["hour_sin", "hour_cos", "soil_temp", "rain_fall",
                     "prev_5", "prev_4", "prev_3", "prev_2", "prev_1"]
MOISTURE_TARGET = "future_moisture"
NUTRIENTS = ["N", "P", "K", "pH", "EC", "OC", "S", "Zn", "Fe", "Cu", "Mn", "B"]
NUTRIENT_LABEL = "Output"
# The prediction range and the label domain.
MOISTURE_RANGE = (0.0, 100.0)
LABEL_DOMAIN = (0, 1)
HISTORY = 5  # lags per feature row

# Model settings the results depend on, in one place.
SEED = 42                          # every seeded split and model
TEST_FRACTION = 0.2                # ordered split: last ceil(0.2 n) rows test
BOOSTED_TRAIN_FRACTION = 0.3       # boosted regressor: first floor(0.3 n) rows train
RANDOM_TRAIN_PERCENT = 80          # seeded random split of nutrient rows
SGD_LEARNING_RATE = 0.01           # constant step of the online linear update
SGD_MAX_ITER = 50_000
SGD_TOL = 1e-8
SWEEP_LEARNING_RATES = [0.1, 0.05, 0.01, 0.005, 0.001, 0.0005]
FOREST_TREES = 100
FOREST_REGRESSOR_DEPTH = 6
BOOSTED_ITERATIONS = 100
BOOSTED_STEP = 0.1
TREE_CLASSIFIER_DEPTH = 5
FOREST_CLASSIFIER_DEPTH = 5        # the comparison forest; production forests grow to Spark's cap
FOREST_MAX_DEPTH = 30              # Spark's depth limit

# Default series layout: one series per station, ordered by time then id.
KEYS = ["station_id"]
ORDER = ["ts", "event_id"]

READINGS = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("hour", T.IntegerType(), True),
    T.StructField("soil_temp", T.DoubleType(), True),
    T.StructField("rain_fall", T.DoubleType(), True),
    T.StructField("soil_moisture", T.DoubleType(), True),
])

FEATURE_ROWS = T.StructType(
    [T.StructField("station_id", T.LongType(), False),
     T.StructField("event_id", T.LongType(), False),
     T.StructField("ts", T.TimestampNTZType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in MOISTURE_FEATURES]
    + [T.StructField(MOISTURE_TARGET, T.DoubleType(), True)])

NUTRIENT_ROWS = T.StructType(
    [T.StructField("sample_id", T.LongType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in NUTRIENTS]
    + [T.StructField(NUTRIENT_LABEL, T.IntegerType(), True)])

PREDICTIONS = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("predicted_moisture", T.DoubleType(), False),
    T.StructField("actual_moisture", T.DoubleType(), True),
    T.StructField("absolute_error", T.DoubleType(), True),
])
