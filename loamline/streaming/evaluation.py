"""Model quality over time on streams: event-time windows, late rows, late labels.

* ``daily_mae_stream`` -- mean absolute error per UTC day as predictions get
  their actual value. A day is emitted once, when the watermark has passed its
  end; rows that come later are not added, and ``late_rows`` counts them.
* ``fertility_correct_stream`` -- predictions joined with labels that come
  before, with or after them, or never: a stream-stream left outer join.

Both keep bounded state: rows and windows older than their watermark leave it.
Both emit in append mode, so the sinks are plain append-only tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from loamline.operators.quality import binary_labels
from loamline.schemas import KEYS, NUTRIENT_LABEL

MAE_DELAY = "1 day"
LABEL_DELAY = "1 day"
LABEL_WITHIN = "30 days"


def daily_mae_stream(log: DataFrame, ts: str = "ts", err: str = "absolute_error", *, delay: str = MAE_DELAY,
                     ids: tuple[str, ...] = (*KEYS, "event_id")) -> DataFrame:
    """(day, mae, n) over a streaming log of predictions with a known actual.

    A prediction that comes again -- a replayed batch of its sink -- counts once:
    rows are told apart by ``ids`` while they are within the delay. That step is
    also the first to meet a row older than the watermark, so it drops and counts
    late rows one by one, before anything is summed (Spark judges a batch by the
    watermark of the batch before). Days are summed partially
    before they are shuffled: a day of any size is one row per task and day."""
    known = log.filter(F.col(err).isNotNull()).select(*ids, F.col(ts).cast("timestamp").alias("at"), F.col(err).alias("error"))
    once = known.withWatermark("at", delay).dropDuplicates([*ids, "at"])
    day = F.window("at", "1 day")
    return (once.groupBy(day.alias("w")).agg(F.avg("error").alias("mae"), F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "mae", "n"))


def late_rows(query: StreamingQuery) -> int:
    """Rows a query dropped because they were older than its watermark, by its
    progress reports (the session keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates`` of them)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def fertility_correct_stream(predictions: DataFrame, labels: DataFrame, *, delay: str = LABEL_DELAY,
                             within: str = LABEL_WITHIN) -> DataFrame:
    """sample_id, predicted_fertility, actual_fertility, correct of each streamed
    prediction (sample_id, predicted_fertility, predicted_at) and the label
    (sample_id, Output, labelled_at) that lies up to ``within`` before or after it.
    Labels that are not 0 or 1 are none. A prediction is emitted with its label as
    soon as both are there, and without one, actual and correct NULL, when the
    watermark shows that none can come any more."""
    p = predictions.select("sample_id", "predicted_fertility", F.col("predicted_at").cast("timestamp").alias("predicted_at"))
    truth = binary_labels(labels, NUTRIENT_LABEL).select(
        F.col("sample_id").alias("of"), F.col(NUTRIENT_LABEL).alias("actual_fertility"),
        F.col("labelled_at").cast("timestamp").alias("labelled_at"))
    span = F.expr(f"INTERVAL {within}")
    p, truth = p.withWatermark("predicted_at", delay), truth.withWatermark("labelled_at", delay)
    near = (F.col("sample_id") == F.col("of")) & F.col("labelled_at").between(
        F.col("predicted_at") - span, F.col("predicted_at") + span)
    correct = (F.col("predicted_fertility") == F.col("actual_fertility")).cast("int")
    return p.join(truth, near, "left_outer").select(
        "sample_id", "predicted_fertility", "actual_fertility", correct.alias("correct"))
