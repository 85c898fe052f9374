"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; a cluster's own spark-defaults win where set.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "loamline", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or join) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, target_partition_mb: int = 128) -> dict[str, str]:
    """Partition sizing for a given input size.

    Shuffles start with about one partition per ``target_partition_mb`` of
    input (AQE coalesces them when the shuffled data is smaller, and splits
    skewed partitions of sort-merge joins); scans read splits of the same
    size. For 100 TB at 128 MB that is ~800k.
    """
    target = target_partition_mb * 1024 * 1024
    parts = max(200, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
    }


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: computed
    once, lineage cut, sizes known to the planner, readable after an executor is lost."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; whoever
    builds the session names it (tests and the bench name a scratch folder)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path
