"""The feature query as SQL text for ``spark.sql``.

Buckets are sized by key as in ``series.per_size``: a hashed sample of each
station gives the borders of stations that are too large for one window.
Windows are partitioned by (station, bucket); ordinary stations have bucket 0.
For stations with borders the rows within five of a bucket's end are
windowed again per station, over these rows only.
"""

from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from loamline.operators import series


def features_sql(view: str = "readings", bucket_rows: int | None = None) -> str:
    """SQL over a view with ``station_id, event_id, ts, hour, soil_temp,
    rain_fall, soil_moisture`` (moisture as a fraction)."""
    rows = bucket_rows or series.BUCKET_ROWS
    step = max(1, rows // series.SAMPLES)
    each = max(1, rows // step)
    two_pi = repr(2 * math.pi)  # a double literal (D): plain decimals parse as DECIMAL
    lags = ",\n               ".join(f"lag(soil_moisture, {k}) OVER w AS prev_{k}" for k in range(1, 6))
    fixes = ",\n               ".join(
        f"CASE WHEN rn <= 5 THEN lag(soil_moisture, {k}) OVER e ELSE prev_{k} END AS prev_{k}"
        for k in range(1, 6))
    cols = ("station_id, event_id, ts, hour_sin, hour_cos, soil_temp, rain_fall, "
            "prev_5, prev_4, prev_3, prev_2, prev_1, future_moisture")
    return f"""
WITH r AS (
    SELECT station_id, event_id, ts,
           sin({two_pi}D * hour / 24D) AS hour_sin,
           cos({two_pi}D * hour / 24D) AS hour_cos,
           soil_temp, rain_fall, soil_moisture * 100 AS soil_moisture
    FROM {view}),
sampled AS (
    SELECT DISTINCT station_id, struct(ts, event_id) AS at FROM r
    WHERE pmod(xxhash64(station_id, ts, event_id), {step}) = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY at) AS place FROM sampled),
borders AS (
    SELECT station_id, sort_array(collect_list(at)) AS cuts FROM ranked WHERE place % {each} = 0 GROUP BY station_id),
parted AS (
    SELECT r.*, cuts IS NOT NULL AS hot,
           coalesce(size(filter(cuts, c -> c <= struct(ts, event_id))), 0) AS bkt
    FROM r LEFT JOIN borders b ON r.station_id <=> b.station_id),
a AS (
    SELECT *, {lags},
           lead(soil_moisture, 1) OVER w AS future_moisture,
           row_number() OVER w AS rn,
           count(1) OVER (PARTITION BY station_id, bkt) - row_number() OVER w + 1 AS rdesc
    FROM parted
    WINDOW w AS (PARTITION BY station_id, bkt ORDER BY ts, event_id)),
fixed AS (
    SELECT station_id, event_id, ts, hour_sin, hour_cos, soil_temp, rain_fall,
           {fixes},
           CASE WHEN rdesc <= 1 THEN lead(soil_moisture, 1) OVER e ELSE future_moisture END AS future_moisture
    FROM a WHERE hot AND (rn <= 5 OR rdesc <= 5)
    WINDOW e AS (PARTITION BY station_id ORDER BY bkt, ts, event_id)),
all_rows AS (
    SELECT {cols} FROM a WHERE NOT hot OR (rn > 5 AND rdesc > 5)
    UNION ALL
    SELECT {cols} FROM fixed)
SELECT * FROM all_rows WHERE prev_5 IS NOT NULL AND future_moisture IS NOT NULL"""


def moisture_features_sql(spark: SparkSession, readings: DataFrame, bucket_rows: int | None = None) -> DataFrame:
    """Run the feature SQL over ``readings``, registered under a name of its own."""
    view = f"readings_{uuid4().hex}"
    readings.createOrReplaceTempView(view)
    return spark.sql(features_sql(view, bucket_rows))
