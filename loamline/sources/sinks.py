"""Writes: typed tables, appends, replaces, CSV export with a row index.

Tables are Parquet folders (or catalog tables when a name is given); every
write is a whole-file operation, so a failed task is simply retried -- no
partial rows become visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loamline.operators.series import join_null_safe, prefix_sum, row_ids


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Drop-and-create: an empty, typed table at ``path`` (re-runnable)."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Bulk append (new files next to the existing ones)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Bulk replace: the table becomes exactly ``df``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table folder, on whatever store it lies; one that is gone already is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def with_row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   name: str = "id", key_bucket: float = 1024) -> DataFrame:
    """A stable 0-based row index in (keys, order) order: per-series
    positions from the bucketed ``row_ids`` plus the sizes of all preceding
    series. Those start offsets are themselves a bucketed ``prefix_sum`` over
    the per-key size table (buckets of ``key_bucket`` consecutive numeric
    keys), so no window ever orders all keys in one task."""
    keys, order = list(keys), list(order)
    if not keys:
        return (row_ids(df, [], order, "_si_pos")
                .withColumn(name, F.col("_si_pos") - 1).drop("_si_pos"))
    pos = row_ids(df, keys, order, "_si_pos")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_si_n"))
    starts = prefix_sum(sizes, [], keys, "_si_n", "_si_start", inclusive=False,
                        bucket=F.floor(F.col(keys[0]) / F.lit(key_bucket))).drop("_si_n")
    return (join_null_safe(pos, starts, keys)
            .withColumn(name, F.col("_si_start") + F.col("_si_pos") - 1)
            .drop("_si_pos", "_si_start"))


def export_csv(df: DataFrame, path: str, keys: Sequence[str] = (), order: Sequence[str] = (),
               index: str | None = "id") -> None:
    """CSV export with a header; with ``index`` a leading row-index column
    (what a pandas ``to_csv`` with its index writes)."""
    out = with_row_index(df, keys, order, index) if index else df
    if index:
        out = out.select(index, *[c for c in df.columns])
    out.write.mode("overwrite").option("header", True).csv(path)
