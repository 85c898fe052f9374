import pytest
from pyspark.sql import functions as F, types as T

from loamline.operators import features
from loamline.schemas import FEATURE_ROWS, MOISTURE_FEATURES, MOISTURE_TARGET
from loamline.sources import adapters, sinks, tables

from paths import SF_SMALL


def test_register_views_and_sql(spark):
    tables.register_views(spark, SF_SMALL, ["events"])
    n = spark.sql("SELECT count(*) AS n FROM events").first().n
    assert n == tables.table(spark, SF_SMALL, "events").count()


def test_csv_round_trip_with_schema_and_inference(spark, scratch):
    feats = features.moisture_features(adapters.readings(tables.table(spark, SF_SMALL, "events")))
    sinks.export_csv(feats.drop("ts"), f"{scratch}/csv", keys=["station_id"], order=["event_id"])
    schema = T.StructType([T.StructField("id", T.LongType())]
                          + [f for f in FEATURE_ROWS.fields if f.name != "ts"])
    back = tables.read_csv(spark, f"{scratch}/csv", schema)
    assert back.count() == feats.count()
    ids = sorted(r.id for r in back.select("id").collect())
    assert ids == list(range(len(ids)))
    inferred = tables.read_csv(spark, f"{scratch}/csv")
    assert dict(inferred.dtypes)["prev_1"] == "double"
    raw = spark.createDataFrame([(0.5, 0.8, 20.0, 0.1, 0.35)],
                                "Hour_sin double, Hour_cos double, Soil_Temp double, Rainfall double, Soil_Moisture double")
    norm = features.normalise_columns(raw).first()
    assert norm.soil_moisture == pytest.approx(35.0) and norm.rain_fall == 0.1


def test_create_append_replace(spark, scratch):
    path = f"{scratch}/store"
    empty = sinks.create_table(spark, path, FEATURE_ROWS)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in FEATURE_ROWS]
    import datetime as dt
    row = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1)) + (1.0,) * 9 + (None,)], FEATURE_ROWS)
    sinks.append(row, path)
    sinks.append(row, path)
    assert spark.read.parquet(path).count() == 2
    sinks.replace(row, path)
    assert spark.read.parquet(path).count() == 1
    # filtered scan: pending rows only, the predicate reaches the reader
    got = tables.read_table(spark, path, F.col(MOISTURE_TARGET).isNull(), ["station_id"] + MOISTURE_FEATURES)
    assert got.count() == 1
    assert "PushedFilters: [IsNull(future_moisture)]" in got._jdf.queryExecution().executedPlan().toString()


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(50).select((F.col("id") % 4).alias("k"), F.col("id").alias("o"))
    out = sinks.with_row_index(df, ["k"], ["o"]).orderBy("k", "o").collect()
    assert [r.id for r in out] == list(range(50))


def test_typed_tables_for_every_store(spark, scratch):
    from loamline.schemas import NUTRIENT_ROWS, PREDICTIONS, READINGS
    for name, schema in [("readings", READINGS), ("nutrients", NUTRIENT_ROWS), ("predictions", PREDICTIONS)]:
        t = sinks.create_table(spark, f"{scratch}/{name}", schema)
        assert t.count() == 0
        assert [f.name for f in t.schema] == [f.name for f in schema]


def test_single_series_from_csv_with_row_order(spark, scratch):
    """The reference's own input: one series in file order, columns in the
    raw casing. With no key the buckets are ranges of the row index."""
    from pyspark.sql import Window
    ev = tables.table(spark, SF_SMALL, "events")
    raw = ev.select(
        F.col("event_id").alias("row_id"),
        F.sin(F.lit(6.283185307179586) * F.hour("ts") / F.lit(24)).alias("Hour_sin"),
        F.cos(F.lit(6.283185307179586) * F.hour("ts") / F.lit(24)).alias("Hour_cos"),
        F.get_json_object("props", "$.k").try_cast("double").alias("Soil_Temp"),
        F.col("value").alias("Rainfall"), (F.col("value") / F.lit(500.0)).alias("Soil_Moisture"))
    raw.write.option("header", True).csv(f"{scratch}/raw")
    schema = T.StructType([T.StructField("row_id", T.LongType())] + [
        T.StructField(c, T.DoubleType()) for c in ["Hour_sin", "Hour_cos", "Soil_Temp", "Rainfall", "Soil_Moisture"]])
    back = features.normalise_columns(tables.read_csv(spark, f"{scratch}/raw", schema))
    got = features.moisture_features(back, keys=[], order=["row_id"], bucket_seconds=37, normalised=True)
    w = Window.orderBy("row_id")
    want = (back.select("row_id", *[F.lag("soil_moisture", k).over(w).alias(f"prev_{k}") for k in range(1, 6)],
                        F.lead("soil_moisture").over(w).alias("future_moisture"))
            .filter("prev_5 IS NOT NULL AND future_moisture IS NOT NULL"))
    cols = ["row_id", "prev_1", "prev_3", "prev_5", "future_moisture"]
    a = sorted(tuple(r[c] for c in cols) for r in got.collect())
    b = sorted(tuple(r[c] for c in cols) for r in want.collect())
    assert a == b and len(a) == ev.count() - 6
