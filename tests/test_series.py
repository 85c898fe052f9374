"""The bucketed lag/lead must equal one window over the whole series, for
any spread of rows over buckets (dense, sparse, empty gaps)."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from loamline.operators import series

BASE = dt.datetime(2024, 1, 1)


def _frame(spark, rows):
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v"])
    return spark.createDataFrame(pdf, "k long, ts timestamp_ntz, id long, v double")


rows_strategy = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 5000), st.booleans(), st.floats(-100, 100)),
    min_size=1, max_size=60)


def _rows(draw):
    out = []
    for i, (k, sec, null, v) in enumerate(draw):
        out.append((k, BASE + dt.timedelta(seconds=sec), i, None if null else v))
    return out


def _collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy, st.sampled_from([7, 60, 600, 86400]))
def test_shift_equals_plain_window(spark, draw, width):
    df = _frame(spark, _rows(draw))
    lags = {f"l{k}": ("v", k) for k in (1, 3, 5)}
    leads = {"n1": ("v", 1), "n2": ("v", 2)}
    got = series.shift(df, ["k"], ["ts", "id"], lags=lags, leads=leads, bucket_seconds=width)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("*", *[F.lag("v", k).over(w).alias(n) for n, (_, k) in lags.items()],
                     *[F.lead("v", k).over(w).alias(n) for n, (_, k) in leads.items()])
    cols = ["k", "id", "l1", "l3", "l5", "n1", "n2"]
    assert _collect(got, cols) == _collect(want, cols)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy, st.sampled_from([7, 60, 600]))
def test_shift_ignore_nulls(spark, draw, width):
    df = _frame(spark, _rows(draw))
    lags = {f"l{k}": ("v", k) for k in range(1, 6)}
    got = series.shift(df, ["k"], ["ts", "id"], lags=lags, skip_nulls=True, bucket_seconds=width)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("*", *[F.expr(f"lag(v, {k}) IGNORE NULLS").over(w).alias(f"l{k}") for k in range(1, 6)])
    cols = ["k", "id"] + [f"l{k}" for k in range(1, 6)]
    assert _collect(got, cols) == _collect(want, cols)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy, st.sampled_from([7, 600]))
def test_row_ids(spark, draw, width):
    df = _frame(spark, _rows(draw))
    got = series.row_ids(df, ["k"], ["ts", "id"], bucket_seconds=width)
    want = df.withColumn("row_id", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    assert _collect(got, ["k", "id", "row_id"]) == _collect(want, ["k", "id", "row_id"])


def test_one_hot_station_is_split_across_tasks(spark):
    """A single key with many buckets: the final window partitions by
    (key, bucket), so the rows spread over several shuffle partitions."""
    n = 5000
    df = spark.range(n).select(F.lit(1).cast("long").alias("k"),
                               (F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 60)).cast("timestamp_ntz").alias("ts"),
                               F.col("id"), F.col("id").cast("double").alias("v"))
    out = series.shift(df, ["k"], ["ts", "id"], lags={"p": ("v", 1)}, bucket_seconds=3600)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1
    assert out.filter(F.col("p") != F.col("v") - 1).count() == 0
    assert out.filter(F.col("p").isNull()).count() == 1


def test_last_n_plans_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = series.last_n(df, ["k"], ["o"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert series.last_n(df, ["k"], ["o"], 5).count() == 15


def test_hot_station_from_events(spark, monkeypatch):
    """A third of all readings re-keyed to one station: the flagship stays
    exact, and that station's rows are spread over many window tasks."""
    from paths import SF_MID
    from loamline.operators import features
    from loamline.sources import adapters
    from loamline.sources.tables import table
    monkeypatch.setattr(series, "BUCKET_ROWS", 300)
    ev = table(spark, SF_MID, "events").withColumn(
        "user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id")))
    readings = adapters.readings(ev)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = features.moisture_features(readings)
        per_task = (got.filter(F.col("station_id") == 0)
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    hot = sum(r["count"] for r in per_task)
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < 0.5 * hot
    r = features.normalise(readings)
    w = Window.partitionBy("station_id").orderBy("ts", "event_id")
    want = (r.select("station_id", "event_id", *[F.lag("soil_moisture", k).over(w).alias(f"prev_{k}") for k in range(1, 6)],
                     F.lead("soil_moisture").over(w).alias("future_moisture"))
            .filter("prev_5 IS NOT NULL AND future_moisture IS NOT NULL"))
    cols = ["station_id", "event_id", "prev_1", "prev_5", "future_moisture"]
    assert _collect(got, cols) == _collect(want, cols)


def test_bucket_width_from_session(spark):
    df = spark.range(10).select(F.lit(1).cast("long").alias("k"),
                                (F.lit(BASE) + F.make_dt_interval(secs=F.col("id") * 60)).cast("timestamp_ntz").alias("ts"),
                                F.col("id"), F.col("id").cast("double").alias("v"))
    spark.conf.set(series.BUCKET_CONF, "120")
    try:
        buckets = df.select(series.bucket_of(df, "ts").alias("b")).distinct().count()
    finally:
        spark.conf.unset(series.BUCKET_CONF)
    assert buckets == 5
    assert df.select(series.bucket_of(df, "ts").alias("b")).distinct().count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_strategy, st.sampled_from([7, 600]), st.booleans())
def test_prefix_sum(spark, draw, width, inclusive):
    df = _frame(spark, _rows(draw)).withColumn("v", F.coalesce("v", F.lit(0.0)))
    got = series.prefix_sum(df, ["k"], ["ts", "id"], "v", "s", inclusive=inclusive, total="t",
                            bucket_seconds=width)
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(*frame)
    want = (df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0.0)))
              .withColumn("t", F.sum("v").over(Window.partitionBy("k"))))
    a = {r.id: (r.s, r.t) for r in got.collect()}
    b = {r.id: (r.s, r.t) for r in want.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_first_n_and_latest(spark):
    df = spark.range(30).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), (F.col("id") * 10).alias("v"))
    first = series.first_n(df, ["k"], ["o"], 2, name="rank")
    assert sorted((r.k, r.o, r.rank) for r in first.collect()) == [
        (0, 0, 1), (0, 3, 2), (1, 1, 1), (1, 4, 2), (2, 2, 1), (2, 5, 2)]
    last = {r.k: (r.o, r.v) for r in series.latest(df, ["k"], ["o"], ["v"]).collect()}
    assert last == {0: (27, 270), 1: (28, 280), 2: (29, 290)}


def test_rows_without_key_or_time_are_kept(spark):
    df = spark.createDataFrame([(1, 5, 1), (None, 7, 2), (1, None, 3)], "k long, ts long, id long")
    for rows in (None, 1):  # plain windows; every key of two rows is hot
        out = series.row_ids(df, ["k"], ["ts", "id"], total="n", bucket_rows=rows)
        assert {(r.k, r.ts): (r.row_id, r.n) for r in out.collect()} == {
            (1, None): (1, 2), (1, 5): (2, 2), (None, 7): (1, 1)}
    from loamline.operators.models import ordered_split
    from loamline.sources.sinks import with_row_index
    assert ordered_split(df, ["k"], ["ts", "id"]).count() == 3
    assert sorted(r.id for r in with_row_index(df.withColumnRenamed("id", "i"), ["k"], ["ts", "i"]).collect()) == [0, 1, 2]


def _same_as_one_window(df, keys=("k",), order=("ts", "id"), bucket_rows=200):
    """Every series operator over buckets equals one window per key."""
    keys, order = list(keys), list(order)
    key = lambda r: tuple((x is None, x) for x in r)
    rows = lambda d: sorted(map(tuple, d.collect()), key=key)
    args = (keys, order, {"p": ("v", 3)}, {"n": ("v", 1)})
    assert rows(series.shift(df, *args, bucket_rows=bucket_rows)) == rows(series.shift(df, *args, whole=True))
    thin = df.withColumn("v", F.when(F.col("id") % 7 == 0, F.col("v")))
    for lags, leads in (({"p": ("v", 2)}, None), (None, {"p": ("v", 2)})):
        want = rows(series.shift(thin, keys, order, lags, leads, whole=True, skip_nulls=True))
        assert rows(series.shift(thin, keys, order, lags, leads, bucket_rows=bucket_rows, skip_nulls=True)) == want
    ids = series.row_ids(df, keys, order, total="t", bucket_rows=bucket_rows)
    assert rows(ids) == rows(series.row_ids(df, keys, order, total="t", bucket_rows=10**9))


def _bucket_sizes(df, bucket_rows=200, key=0):
    cuts = series.borders(df, ["k"], ["ts", "id"], bucket_rows)
    parts = series.hot_parts(df, ["k"], cuts).filter(F.col("k").eqNullSafe(F.lit(key)))
    return [r["count"] for r in parts.groupBy(series.PART).count().collect()]


HOT_SERIES = {
    "one day": lambda i: i * 40,
    "one time": lambda i: 5,
    "a burst": lambda i: i * 1_000_000 if i % 10 == 0 else 77_000_000 + i % 3,
    "no times": lambda i: None,
}


@pytest.mark.parametrize("name", sorted(HOT_SERIES))
def test_hot_series_is_split(spark, name):
    """A third of all rows in one station, however its times lie: same values,
    buckets of about the size asked for."""
    rows = [(0, HOT_SERIES[name](i), i) for i in range(2000)] + [(1 + i % 50, i * 977, 10_000 + i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, ts long, id long").withColumn("v", F.col("id") * 2.0)
    sizes = _bucket_sizes(df)
    assert sum(sizes) == 2000 and len(sizes) >= 7 and max(sizes) < 500
    _same_as_one_window(df)


def test_a_null_station_may_be_hot(spark):
    df = spark.createDataFrame([(None, i % 4, i) for i in range(1500)] + [(1, i, 5000 + i) for i in range(100)],
                               "k long, ts long, id long").withColumn("v", F.col("id") * 1.0)
    sizes = _bucket_sizes(df, key=None)
    assert sum(sizes) == 1500 and max(sizes) < 500
    _same_as_one_window(df)


def test_many_borders_are_found_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(series, "BORDER_FAN", 4)
    df = spark.createDataFrame([(0, i // 7, i) for i in range(3000)], "k long, ts long, id long").withColumn("v", F.col("id") * 1.0)
    cuts = series.borders(df, ["k"], ["ts", "id"], 40)
    parts = series.hot_parts(df, ["k"], cuts)
    n = cuts.count()
    assert n > 40 and parts.select(series.PART).distinct().count() == n + 1
    w = Window.orderBy("ts", "id")
    back = parts.withColumn("d", F.col(series.PART) - F.lag(series.PART).over(w))
    assert back.filter("d < 0").count() == 0  # buckets grow along the key
    at = {tuple(r["_sx_at"]) for r in cuts.collect()}
    assert {(r.ts, r.id) for r in back.filter("d > 0").collect()} == at  # and start at the borders
    _same_as_one_window(df, bucket_rows=40)


def test_ordinary_keys_run_no_second_branch(spark):
    """Two scans of the rows run, that of the sample and that of the window; the hot branch is dropped."""
    df = spark.createDataFrame([(i % 5, i, i) for i in range(500)], "k long, ts long, id long").withColumn("v", F.col("id") * 1.0)
    out = series.shift(df, ["k"], ["ts", "id"], {"p": ("v", 1)})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Union" not in final and final.count("Window") <= plan.count("Window") // 2


def test_sql_features_split_hot_stations(spark):
    from loamline.operators import features
    from loamline.plans.sql import moisture_features_sql
    from loamline.sources import adapters
    from loamline.sources.tables import table
    from paths import SF_SMALL
    ev = table(spark, SF_SMALL, "events").withColumn(
        "user_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id")))
    readings = adapters.readings(ev)
    want = features.moisture_features(readings)
    got = moisture_features_sql(spark, readings, bucket_rows=40).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rows_of_ordinary_keys_are_shuffled_once(spark):
    """Hot keys are broadcast where the rows are read: the only exchange of all
    rows is that of the window, also where nothing else may be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id % 7 k", "id ts", "id", "double(id) v")
        out = series.per_size(df, ["k"], ["ts", "id"], lambda rows, part: series.shift(
            rows, ["k"], ["ts", "id"], lags={"p": ("v", 1)}, whole=True) if part is None else rows.limit(0).selectExpr(
                "k", "ts", "id", "v", "v p"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        anti = [line for line in plan.splitlines() if "LeftAnti" in line]
        assert anti and all("BroadcastHashJoin" in line for line in anti)
        assert out.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
