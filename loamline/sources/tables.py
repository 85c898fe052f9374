"""Table scans and writes. Parquet is the storage format: column pruning and
filter pushdown reach the scan; CSV only enters through an explicit schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, e.g. ``table(spark, '/root/testdata/sf0.01', 'events')``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the driver tables to ``spark.sql`` under their own names."""
    for n in names:
        path = os.path.join(sf_dir, f"{n}.parquet")
        if os.path.exists(path) or "://" in path:
            table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan. With a schema nothing is inferred (no extra pass over the
    data); without one types are inferred, as the reference's CSV reader
    does -- only sensible for small files."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str, predicate=None, columns=None) -> DataFrame:
    """Filtered Parquet scan; the predicate is pushed to the reader."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.filter(predicate)
    if columns:
        df = df.select(*columns)
    return df


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``? Only "no such path" counts as no; any
    other failure (storage, permission) is raised."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True
