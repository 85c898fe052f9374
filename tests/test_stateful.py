"""The event-time cycle: any order within the delay, restarts, late and idle stations."""

import datetime as dt
import random

from pyspark.sql import types as T

from loamline.plans.catalog import _fixed_model
from loamline.schemas import MOISTURE_FEATURES, READINGS
from loamline.streaming import moisture, stateful, windowed

BASE = dt.datetime(2024, 3, 1)
SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in READINGS])  # a reading may lack its time


def readings(n=40, stations=(1, 2, 3), seed=5):
    rnd = random.Random(seed)
    rows = []
    for s in stations:
        at = 0
        for i in range(n):
            at += rnd.choice([1, 600, 1800, 5400])
            temp = None if rnd.random() < 0.1 else 20 + rnd.random()
            moist = None if rnd.random() < 0.05 else rnd.uniform(0.2, 0.4) + (1.5 if rnd.random() < 0.05 else 0)
            rows.append((s, 1000 * s + i, BASE + dt.timedelta(seconds=at), (at // 3600) % 24, temp, rnd.random(), moist))
    return rows


CLOSE = (99, 99_999, BASE + dt.timedelta(days=20), 0, 1.0, 1.0, 0.3)  # moves the watermark past all others
COLUMNS = ["store", "event_id", "label", "predicted", "absolute_error", "reason", *MOISTURE_FEATURES]


def run(spark, base, files, **kw):
    """One AvailableNow run over the files written so far; restarts from the checkpoint."""
    for k, v in stateful.STATE_STORE.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for name, rows in files:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in/{name}")
        src = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
               .parquet(f"{base}/in"))
        q = (stateful.event_time_cycles(src, _fixed_model(), **kw).writeStream
             .foreachBatch(moisture.idempotent_sink(f"{base}/out"))
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        for k in stateful.STATE_STORE:
            spark.conf.unset(k)
    return spark.read.parquet(f"{base}/out")


def rows_of(df):
    key = lambda r: tuple((x is None, x) for x in r)
    rounded = lambda x: round(x, 9) if isinstance(x, float) else x
    rows = df.filter("station_id != 99").select(*COLUMNS).collect()
    return sorted((tuple(rounded(x) for x in r) for r in rows), key=key)


def test_restarted_out_of_order_stream_equals_batch(spark, tmp_path):
    """Shuffled arrival within the delay, stopped and restarted in the middle."""
    rows = sorted(readings(), key=lambda r: r[2])
    rnd = random.Random(3)
    jittered = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rnd.uniform(0, 5000)))
    parts = [jittered[i::1][k:k + 30] for i in (0,) for k in range(0, len(jittered), 30)]
    half = len(parts) // 2
    run(spark, tmp_path, [(f"a{i}", p) for i, p in enumerate(parts[:half])])
    out = run(spark, tmp_path, [(f"b{i}", p) for i, p in enumerate([*parts[half:], [CLOSE]])], idle_seconds=10**9)
    tail = spark.createDataFrame([], windowed.TAIL_SCHEMA)
    want, _ = windowed.cycle_batch(spark.createDataFrame(rows, READINGS), tail, _fixed_model(), whole=True)
    got = rows_of(out)
    assert got == rows_of(want) and {r[0] for r in got} == {"permanent", "training", "prediction", "rejected"}


def test_late_and_idle_stations(spark, tmp_path):
    steady = [(1, i, BASE + dt.timedelta(hours=i), i % 24, 20.0, 0.1, 0.3) for i in range(12)]
    late = (1, 500, BASE + dt.timedelta(hours=1, minutes=5), 1, 20.0, 0.1, 0.3)
    untimed = (1, 501, None, 1, 20.0, 0.1, 0.3)
    back = [(1, 100 + i, BASE + dt.timedelta(days=12, hours=i), i % 24, 20.0, 0.1, 0.3) for i in range(7)]
    other = (2, 700, BASE + dt.timedelta(days=9), 0, 20.0, 0.1, 0.3)  # station 1 expires before it returns
    out = run(spark, tmp_path, [("0", steady), ("1", [other]), ("2", [late, untimed]), ("3", back), ("4", [CLOSE])],
              idle_seconds=5 * 86_400)
    reasons = {(r.event_id, r.reason) for r in out.filter("store = 'rejected'").collect()}
    assert {(500, "late"), (501, "no time"), (11, "idle: permanent"), (11, "idle: prediction"), (11, "idle: training")} <= reasons
    # five readings warm the station up again; the sixth is its first cycle
    assert {r.event_id for r in out.filter("store = 'permanent' and event_id >= 100").collect()} == {105}
    assert (106, "idle: permanent") in reasons and out.filter("store = 'permanent'").count() == 12 - 5 - 1 + 1
