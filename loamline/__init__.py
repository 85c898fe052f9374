"""loamline: soil-telemetry analytics on Spark.

Raw hourly readings become lag/lead/cyclic-hour features, bad rows are
quarantined, delayed labels and prediction errors are derived from
immutable logs, moisture regressors and nutrient classifiers are fitted and
compared, and batches and streams are scored with one feature definition.
Everything is DataFrames, Spark SQL, Spark ML and Structured Streaming.
"""

from loamline.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
