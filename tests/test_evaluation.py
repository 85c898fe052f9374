"""Streamed quality equals its batch form; late rows and late labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loamline.operators import metrics
from loamline.plans.catalog import QUERIES, _prediction_log
from loamline.streaming import evaluation

from paths import SF_SMALL

FAR = dt.datetime(2030, 1, 1)


def run(spark, out, base, name="out"):
    """One AvailableNow run into an append-only table; restarts from its checkpoint."""
    q = (out.writeStream.format("parquet").option("path", f"{base}/{name}").outputMode("append")
         .option("checkpointLocation", f"{base}/ckpt-{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q, spark.read.schema(out.schema).parquet(f"{base}/{name}")


def stream(spark, path, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path))


@pytest.fixture(scope="module")
def log(spark):
    return _prediction_log(spark, SF_SMALL).select("station_id", "event_id", "ts", "absolute_error").cache()


def test_streamed_mae_equals_batch(spark, log, tmp_path):
    """A week a file, rows out of order inside it, one file sent twice, and a restart."""
    weeks = [(d, d + 7) for d in range(1, 32, 7)]
    end = spark.createDataFrame([(0, -1, FAR, 0.0)], "station_id long, event_id long, ts timestamp_ntz, absolute_error double")
    day = F.dayofmonth("ts")
    parts = [log.filter((day >= a) & (day < b)).orderBy(F.rand(a)) for a, b in weeks]
    for i, part in enumerate(parts[:3]):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    parts[2].coalesce(1).write.parquet(f"{tmp_path}/in/2-again")
    out = evaluation.daily_mae_stream(stream(spark, f"{tmp_path}/in", log.schema), delay="8 days")
    first, _ = run(spark, out, tmp_path)
    for i, part in enumerate([*parts[3:], end]):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{3 + i}")
    last, table = run(spark, out, tmp_path)
    got = {r.day: (r.mae, r.n) for r in table.collect()}
    want = {r.day: (r.mae, r.n) for r in metrics.daily_mae(log).collect()}
    got.pop("2030-01-01", None)
    assert len(want) > 20 and set(got) == set(want)
    assert all(got[d] == (pytest.approx(want[d][0]), want[d][1]) for d in want)
    assert evaluation.late_rows(first) == evaluation.late_rows(last) == 0


def test_late_rows_are_counted_one_by_one(spark, tmp_path):
    schema = "station_id long, event_id long, ts timestamp_ntz, absolute_error double"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    files = [[(1, 1, day(1), 1.0), (1, 2, day(1, 5), 3.0), (1, 3, day(2), None)],
             [(1, 4, day(10), 2.0)],
             [(1, 4, day(10), 2.0)],  # sent again; a batch's late rows are judged by the watermark before the last batch
             [(1, 5, day(1, 6), 100.0), (2, 6, day(1, 7), 100.0), (1, 7, day(9, 12), 4.0)],  # two late, one in time
             [(0, 0, FAR, 0.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    out = evaluation.daily_mae_stream(stream(spark, f"{tmp_path}/in", schema), delay="1 day")
    q, table = run(spark, out, tmp_path)
    assert {r.day: (r.mae, r.n) for r in table.collect() if r.day < "2030"} == {
        "2024-01-01": (2.0, 2), "2024-01-09": (4.0, 1), "2024-01-10": (2.0, 1)}
    assert evaluation.late_rows(q) == 2


def test_labels_before_with_after_and_never(spark, tmp_path):
    """Equals the batch query, however late the labels are."""
    want = QUERIES["fertility_correct"](spark, SF_SMALL).cache()
    at = lambda c, days: F.timestamp_seconds(1_700_000_000 + F.col(c) * 60 + F.lit(days * 86_400))
    p = want.select("sample_id", "predicted_fertility", at("sample_id", 0).alias("predicted_at"))
    late = F.pmod("sample_id", F.lit(3))
    truth = want.filter("actual_fertility is not null").select("sample_id", F.col("actual_fertility").alias("Output"))
    other = want.filter("actual_fertility is null").select("sample_id", F.lit(7).alias("Output"))  # no valid label
    labels = truth.unionByName(other).withColumn("labelled_at", F.when(late == 0, at("sample_id", -3)).when(
        late == 1, at("sample_id", 0)).otherwise(at("sample_id", 9)))
    far = lambda cols: spark.createDataFrame([(-1, 0, FAR)], cols)
    sides = {"p": (p, far("sample_id long, predicted_fertility int, predicted_at timestamp"), 0),
             "l": (labels, far("sample_id long, Output int, labelled_at timestamp"), 1)}
    for name, (rows, end, _) in sides.items():
        cut = F.pmod("sample_id", F.lit(2)) if name == "l" else F.lit(0)
        for i in range(2):  # half of the labels come in a later file
            rows.filter(cut == i).coalesce(1).write.parquet(f"{tmp_path}/{name}/{i}")
        end.coalesce(1).write.parquet(f"{tmp_path}/{name}/9")
    out = evaluation.fertility_correct_stream(
        stream(spark, f"{tmp_path}/p", p.schema), stream(spark, f"{tmp_path}/l", labels.schema), delay="20 days")
    _, table = run(spark, out, tmp_path)
    key = lambda r: r[0]
    got = sorted((tuple(r) for r in table.filter("sample_id >= 0").collect()), key=key)
    assert got == sorted(map(tuple, want.select(*table.columns).collect()), key=key)
    assert {r[3] for r in got} == {None, 0, 1}
