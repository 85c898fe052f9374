"""Aggregations and model metrics, each one partial+final aggregation.

Only bounded results (one row per feature, per class or per model) reach the
driver; the scans themselves stay on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target over pairwise
    complete rows; NULL (not an error) when a column is constant."""
    aggs = []
    y = F.col(target)
    for c in features:
        x = F.col(c)
        both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
        xm, ym = F.when(both, x), F.when(both, y)
        aggs.append(F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym)).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in features)
    return wide.selectExpr(f"stack({len(features)}, {stack}) as (feature, correlation)")


def scaler_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population mean and standard deviation per feature; a zero deviation
    is replaced by 1 so constant columns pass through unscaled."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in features)
    return (wide.selectExpr(f"stack({len(features)}, {stack}) as (feature, mean, std)")
            .withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))))


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """R^2 (1 - SS_res/SS_tot; 1 for a perfect fit of a constant target, 0
    otherwise) and RMSE per group, over the rows that have both a target and a
    prediction (no NULL, NaN or infinity); ``n`` counts them."""
    finite = F.lit(True)
    for c in (y, pred):
        x = F.col(c).cast("double")
        finite = finite & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    df = df.withColumns({"_rm_y": F.when(finite, F.col(y)), "_rm_p": F.when(finite, F.col(pred))})
    e2 = F.pow(F.col("_rm_p") - F.col("_rm_y"), 2)
    ss_res = F.sum(e2)
    ss_tot = F.var_pop("_rm_y") * F.count("_rm_y")
    r2 = (F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - ss_res / ss_tot))
    aggs = [r2.alias("r2"), F.sqrt(F.avg(e2)).alias("rmse"), F.count("_rm_y").alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def daily_mae(log: DataFrame, ts: str = "ts", err: str = "absolute_error") -> DataFrame:
    """Mean absolute error per UTC day over predictions with a known actual."""
    day = F.date_format(F.window(ts, "1 day").start, "yyyy-MM-dd")
    return (log.filter(F.col(err).isNotNull())
            .groupBy(day.alias("day"))
            .agg(F.avg(err).alias("mae"), F.count(F.lit(1)).alias("n")))


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Counts per (actual, predicted): at most k^2 rows."""
    return df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy, macro and
    weighted averages; a zero denominator gives 0."""
    # each (actual, predicted) count feeds the actual and the predicted class: one scan
    n, hit = F.col("n"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("cls"), n.alias("support"), F.lit(0).cast("long").alias("predicted_n"),
                 hit.cast("long").alias("tp")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("long").alias("support"), n.alias("predicted_n"),
                 F.lit(0).cast("long").alias("tp")))
    per = (confusion(df, y, pred).select(F.explode(sides).alias("s")).select("s.*")
           .groupBy("cls").agg(*(F.sum(c).alias(c) for c in ("support", "predicted_n", "tp"))))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", prec.cast("double")).withColumn("recall", rec.cast("double"))
    per = per.withColumn("f1", F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        F.lit(0.0)))
    classes = per.select(F.col("cls").cast("string").alias("label"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    total = F.sum("support")
    summary = per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("wf"),
        total.cast("long").alias("total"))
    rows = summary.selectExpr(
        "stack(3, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), accuracy, total, "
        "'macro avg', mp, mr, mf, total, 'weighted avg', wp, wr, wf, total) "
        "as (label, precision, recall, f1, support)")
    return classes.unionByName(rows)


def accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("int")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class; k classes, n rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()  # over the k-row count table only
    return counts.select(label, "n_c",
                         (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach balanced weights. The weight table has one row per class; adaptive
    execution picks the join from its measured size."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return df.join(weights, on=label, how="left")


def queue_counts(rows: DataFrame, target: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"),
                    F.count_if(F.col(target).isNotNull()).alias("completed"),
                    F.count_if(F.col(target).isNull()).alias("pending"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
