"""The moisture prediction cycle as ``foreachBatch`` over bucketed windows.

Each micro-batch runs the batch derivation (``features.compat_cycles`` and
the ``backfill`` leads) over the new readings plus a small per-station tail
carried from the previous batch:

* the last ``seed + 1`` readings (the positional lags of the chain rule),
* the last five rows whose reading entered the lag chain,
* the last accepted cycle (waiting for the next accepted reading),
* the last logged prediction (waiting for the next logged reading),
* the last reading, flagged when it is an accepted cycle still waiting for
  the next reading.

Tail rows keep their derived values (``ctx_*``). Because all work is the
bucketed, skew-safe batch plan, a station with a huge backlog in one
micro-batch is spread over its buckets instead of landing in one task; the
tail is at most ~14 rows per station.

Exactly once: outputs and new tails are written to ``batch_id=N`` folders with
overwrite, and batch N reads the tail as batch N-1 left it, so a replayed batch
reproduces the same files. Bytes read and written as state follow the stations
of a batch, not all stations (``windowed_sink``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loamline.operators import features, series
from loamline.operators.models import LinearModel
from loamline.functions.scalar import is_missing
from loamline.operators.quality import in_range
from loamline.schemas import HISTORY, KEYS, MOISTURE_FEATURES, ORDER
from loamline.sources.sinks import drop
from loamline.sources.tables import exists

STATE_PARTS = 256  # hash partitions of the stations' tails

_RAW = ["hour", "soil_temp", "rain_fall", "soil_moisture"]
_CTX = "_ctx"

TAIL_SCHEMA = T.StructType(
    [T.StructField("station_id", T.LongType()), T.StructField("event_id", T.LongType()),
     T.StructField("ts", T.TimestampNTZType()), T.StructField("hour", T.IntegerType()),
     T.StructField("soil_temp", T.DoubleType()), T.StructField("rain_fall", T.DoubleType()),
     T.StructField("soil_moisture", T.DoubleType()),
     T.StructField("ctx_seed", T.BooleanType()), T.StructField("ctx_chain", T.DoubleType()),
     T.StructField("ctx_accepted", T.BooleanType()), T.StructField("ctx_pred", T.DoubleType())]
    + [T.StructField(f"ctx_{c}", T.DoubleType()) for c in MOISTURE_FEATURES]
    + [T.StructField("pend_perm", T.BooleanType()), T.StructField("pend_train", T.BooleanType()),
       T.StructField("pend_pred", T.BooleanType())])

def _out(df: DataFrame, store: str, label=None, predicted=None, err=None, reason=None,
         feats: bool = True) -> DataFrame:
    none = F.lit(None).cast("double")
    cols = [F.lit(store).alias("store"), "station_id", "event_id", "ts"]
    cols += [F.col(c) if feats else none.alias(c) for c in MOISTURE_FEATURES]
    cols += [(label if label is not None else none).alias("label"),
             (predicted if predicted is not None else none).alias("predicted"),
             (err if err is not None else none).alias("absolute_error"),
             (reason if reason is not None else F.lit(None).cast("string")).alias("reason")]
    return df.select(*cols)


def cycle_batch(new: DataFrame, tail: DataFrame, model: LinearModel,
                lo: float = 0.0, hi: float = 100.0, cache: list | None = None,
                sized: bool = False, **how) -> tuple[DataFrame, DataFrame]:
    """(emitted rows, next tail) for one batch of readings (moisture as a
    fraction) and the previous tail. The cycle frame feeds six outputs; with
    ``cache`` (a list) it is persisted and appended to the list, so the caller
    can release it after writing. With ``sized`` the batch is sampled now, by one
    small job: without hot stations all windows are one per station, otherwise
    one per station and bucket. ``how`` is passed to ``series.shift``."""
    keys, order = KEYS, ORDER
    # rows not newer than the station's last processed reading are late
    last = tail.groupBy(*keys).agg(F.max(F.struct("ts", "event_id")).alias("_last"))
    marked = series.join_null_safe(new, last, keys, "left").withColumn(
        "_late", F.coalesce(F.struct("ts", "event_id") <= F.col("_last"), F.lit(False)))
    late = marked.filter("_late")
    null_reading = marked.filter(~F.col("_late") & is_missing("soil_moisture"))
    new = marked.filter(~F.col("_late") & ~is_missing("soil_moisture")).drop("_late", "_last")
    raw = [F.col(c).alias(f"raw_{c}") for c in _RAW]
    # tail rows have no bucket, and NULL sorts before all buckets: they are older than all new rows
    part = [series.PART] if series.PART in new.columns else []
    new_rows = new.select(*keys, "event_id", "ts", *_RAW, *raw, *part).withColumn(_CTX, F.lit(False))
    ctx_rows = tail.select("*", *raw).withColumn(_CTX, F.lit(True))
    u = new_rows.unionByName(ctx_rows, allowMissingColumns=True)
    if sized:
        cuts = series.borders(u, keys, order, series.BUCKET_ROWS).persist(StorageLevel.MEMORY_AND_DISK)
        if cache is not None:
            cache.append(cuts)
        hot = not cuts.isEmpty()
        # windows over buckets read their input several times: it is written to the shared folder first
        u = series.hot_parts(u, keys, cuts, "left").checkpoint() if hot else u
        how = {"bucket": F.col(series.PART)} if hot else {"whole": True}
    carry = [f"raw_{c}" for c in _RAW] + ["ctx_pred", "pend_perm", "pend_train", "pend_pred"]
    cyc = features.compat_cycles(u, keys, order, context=_CTX, carry=carry, **how)
    predicted = F.when(F.col(_CTX), F.col("ctx_pred")).otherwise(model.predict())
    cyc = cyc.withColumn("predicted", F.when(F.col("accepted"), predicted))
    cyc = cyc.withColumn("logged", F.col("accepted") & in_range("predicted", lo, hi))
    if sized and hot:
        cyc = cyc.checkpoint()
    elif cache is not None:
        cyc = cyc.persist(StorageLevel.MEMORY_AND_DISK)
        cache.append(cyc)
    fresh = ~F.col(_CTX)
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull() | F.isnan(c), F.lit(c)) for c in MOISTURE_FEATURES])
    ingest = (_out(late, "rejected", reason=F.lit("late"), feats=False)
              .unionByName(_out(null_reading, "rejected", reason=F.lit("null reading"), feats=False)))
    emitted = emitted_rows(cyc, fresh, missing, keys, order, how)
    return emitted.unionByName(ingest), next_tail(cyc, keys, order)


def emitted_rows(cyc: DataFrame, fresh, missing, keys, order, how) -> DataFrame:
    """All stores' rows of every cycle in one pass: the next accepted and the
    next logged reading are leads that skip NULLs, and each cycle explodes into
    the rows it emits."""
    cyc = cyc.withColumns({
        "_a": F.when(F.col("accepted"), F.col("soil_moisture")), "_g": F.when(F.col("logged"), F.col("soil_moisture"))})
    cyc = series.shift(cyc, keys, order, leads={"_label": ("_a", 1)}, skip_nulls=True, **how)
    cyc = series.shift(cyc, keys, order, leads={"_actual": ("_g", 1)}, skip_nulls=True, **how)
    due = lambda flag: fresh | F.coalesce(F.col(flag), F.lit(False))
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def row(when, store, label=none, predicted=none, err=none, reason=text, feats=True):
        return F.when(when, F.struct(
            F.lit(store).alias("store"), *[(F.col(c) if feats else none).alias(c) for c in MOISTURE_FEATURES],
            label.alias("label"), predicted.alias("predicted"), err.alias("absolute_error"), reason.alias("reason")))

    accepted, p = F.col("accepted"), F.col("predicted")
    rows = F.array(
        row(accepted & F.col("future_permanent").isNotNull() & due("pend_perm"), "permanent", F.col("future_permanent")),
        row(accepted & F.col("_label").isNotNull() & due("pend_train"), "training", F.col("_label")),
        row(F.col("logged") & F.col("_actual").isNotNull() & due("pend_pred"), "prediction", F.col("_actual"), p,
            F.abs(p - F.col("_actual")), feats=False),
        row(fresh & ~F.col("is_seed") & ~accepted, "rejected", reason=F.concat(F.lit("incomplete: "), missing)),
        row(fresh & accepted & ~F.col("logged"), "rejected", predicted=p, reason=F.lit("prediction out of range")))
    out = cyc.select("station_id", "event_id", "ts", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
    return out.select("r.store", "station_id", "event_id", "ts", *[f"r.{c}" for c in MOISTURE_FEATURES],
                      "r.label", "r.predicted", "r.absolute_error", "r.reason")


def next_tail(cyc: DataFrame, keys, order) -> DataFrame:
    """The rows the next batch needs: bounded selections per station, each a partial top-k."""
    base = cyc.select(
        *keys, "event_id", "ts", *[F.col(f"raw_{c}").alias(c) for c in _RAW],
        F.col("is_seed").alias("ctx_seed"), F.col("chain").alias("ctx_chain"),
        F.col("accepted").alias("ctx_accepted"), F.col("predicted").alias("ctx_pred"),
        *[F.col(c).alias(f"ctx_{c}") for c in MOISTURE_FEATURES], "logged")
    last_reading = series.last_n(base, keys, order, 1).select(
        *keys, "event_id", F.col("ctx_accepted").alias("_f_perm"))
    picks = [
        series.last_n(base, keys, order, HISTORY + 1).select(*keys, "event_id"),
        series.last_n(base.filter(F.col("ctx_chain").isNotNull()), keys, order, HISTORY).select(*keys, "event_id"),
        series.last_n(base.filter("ctx_accepted"), keys, order, 1).select(*keys, "event_id",
                                                                          F.lit(True).alias("_f_train")),
        series.last_n(base.filter("logged"), keys, order, 1).select(*keys, "event_id",
                                                                   F.lit(True).alias("_f_pred")),
        last_reading,
    ]
    chosen = picks[0]
    for p in picks[1:]:
        chosen = chosen.unionByName(p, allowMissingColumns=True)
    flags = chosen.groupBy(*keys, "event_id").agg(
        F.coalesce(F.max("_f_perm"), F.lit(False)).alias("pend_perm"),
        F.coalesce(F.max("_f_train"), F.lit(False)).alias("pend_train"),
        F.coalesce(F.max("_f_pred"), F.lit(False)).alias("pend_pred"))
    nxt = series.join_null_safe(base, flags, [*keys, "event_id"]).drop("logged")
    return nxt.select(*[f.name for f in TAIL_SCHEMA.fields])


def _part(parts: int):
    return F.pmod(F.xxhash64("station_id"), F.lit(parts)).cast("int")


def _manifest(spark: SparkSession, state_path: str, batch_id: int) -> dict[int, int]:
    """Which batch wrote the newest tail of each state partition, as of ``batch_id``."""
    if batch_id < 0:
        return {}
    rows = spark.read.schema("part int, at long").parquet(f"{state_path}/manifest/batch_id={batch_id}")
    return {r["part"]: r["at"] for r in rows.collect()}


def _folder(state_path: str, part: int, at: int) -> str:
    return f"{state_path}/tail/batch_id={at}/part={part}"


def read_tail(spark: SparkSession, state_path: str, batch_id: int, only: list[int] | None = None) -> DataFrame:
    """The tail after ``batch_id``, of all state partitions or of some."""
    now = _manifest(spark, state_path, batch_id)
    paths = [_folder(state_path, p, at) for p, at in now.items() if only is None or p in only]
    empty = spark.createDataFrame([], TAIL_SCHEMA)
    return spark.read.schema(TAIL_SCHEMA).parquet(*paths) if paths else empty


def windowed_sink(spark: SparkSession, model: LinearModel, out_path: str, state_path: str, parts: int = STATE_PARTS):
    """``foreachBatch`` function: read the tails of the stations in the batch, emit,
    write the output and the new tails.

    The tail is kept in ``parts`` hash partitions of the stations. A batch reads
    and writes those of its own stations only; a manifest per batch (at most
    ``parts`` rows) says which batch's folder is each partition's newest. Batch N
    reads what the manifest of N - 1 names, so a replayed batch gives the same
    files; folders that neither of the last two manifests names are dropped."""
    def run(batch: DataFrame, batch_id: int) -> None:
        before = _manifest(spark, state_path, batch_id - 1)
        cached: list = [batch.persist(StorageLevel.MEMORY_AND_DISK)]
        try:
            touched = [r[0] for r in batch.select(_part(parts)).distinct().collect()]
            tail = read_tail(spark, state_path, batch_id - 1, touched)
            emitted, nxt = cycle_batch(batch, tail, model, cache=cached, sized=True)
            emitted = emitted.withColumn("logged_at", F.current_timestamp())
            emitted.write.mode("overwrite").partitionBy("store").parquet(f"{out_path}/batch_id={batch_id}")
            nxt = nxt.withColumn("part", _part(parts)).repartition("part")
            nxt.write.mode("overwrite").partitionBy("part").parquet(f"{state_path}/tail/batch_id={batch_id}")
            # a station with rejected readings only has no tail yet
            new = {p: batch_id for p in touched if exists(spark, _folder(state_path, p, batch_id))}
            rows = sorted({**before, **new}.items())
            (spark.createDataFrame(rows, "part int, at long").coalesce(1).write.mode("overwrite")
             .parquet(f"{state_path}/manifest/batch_id={batch_id}"))
            if batch_id > 1 and exists(spark, f"{state_path}/manifest/batch_id={batch_id - 2}"):
                older = _manifest(spark, state_path, batch_id - 2)
                for p, at in older.items():
                    if before.get(p) != at:
                        drop(spark, _folder(state_path, p, at))
                drop(spark, f"{state_path}/manifest/batch_id={batch_id - 2}")
        finally:
            for df in cached:
                df.unpersist()
    return run
