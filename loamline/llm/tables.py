"""Reading the driver's tables and running Arrow code over them in bounded batches."""

from __future__ import annotations

import os
import posixpath
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 16 << 20
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and whole ``text`` of the documents table (null text: empty)."""
    return texts(table(spark, sf_dir, "documents"))


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """The two columns every text operator works on, and the columns ``keep``;
    others are dropped here, so clashing names cannot reach an operator."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"), *(docs[c] for c in keep))


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Cap the bytes of an Arrow batch sent to Python, so that long texts do
    not add up to 10,000 rows of any size. A smaller cap set by the user stays."""
    now = str(spark.conf.get(BATCH_CONF, "2147483647"))
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = now.rstrip("bkmgBKMG")
    size = int(digits) * unit.get(now[len(digits):len(digits) + 1].lower(), 1) if digits else 0
    if not 0 < size <= most:
        spark.conf.set(BATCH_CONF, str(most))


@contextmanager
def batches_of(spark: SparkSession, size: int):
    """Jobs run inside send batches of ``size`` bytes at most to Python."""
    before = spark.conf.get(BATCH_CONF)
    bounded_batches(spark, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that end inside leave no shuffle files: what they wrote replaces them."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def scratch(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared folder in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return posixpath.join(base, f"{name}-{os.urandom(8).hex()}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: computed
    once, lineage cut, readable after any executor is lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_groups(batches, column: str):
    """Tables that hold whole runs of equal values of a column the batches are
    sorted by; at most one run and one batch are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(column).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(key[1:] != key[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(column)[0].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def joined_by_size(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with the row of their group. Groups of more than a
    thousandth of ``total`` rows, fewer than 1,000, are broadcast; the others
    are shuffled, so no task gets a hot group."""
    hot = F.broadcast(groups.where(F.col(size) * 1000 > total))
    rest = groups.where(F.col(size) * 1000 <= total)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(rest, on))
