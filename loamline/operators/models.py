"""Model operators: splits, population scaler, linear models, trees.

Linear work is reduced to one aggregation pass: the Gram matrix of the
standardised features (d x d numbers, d = 9) is summed on the executors and
only that bounded result reaches the driver, where a d x d system is solved.
Sequential SGD (online epochs, fits with a stopping rule) is in ``online``.
Scoring is a column expression (codegen, no UDF). Tree models are Spark ML.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loamline.operators.metrics import scaler_stats
from loamline.operators.series import row_ids
from loamline.schemas import (BOOSTED_ITERATIONS, BOOSTED_STEP, FOREST_MAX_DEPTH,
                              FOREST_REGRESSOR_DEPTH, FOREST_TREES, KEYS, MOISTURE_FEATURES,
                              MOISTURE_TARGET, ORDER, RANDOM_TRAIN_PERCENT, SEED, SGD_LEARNING_RATE,
                              TEST_FRACTION, TREE_CLASSIFIER_DEPTH)
from loamline.session import materialized

# Rows of a fit below which one task is enough.
FIT_TASK_ROWS = 500


# --------------------------------------------------------------------- splits

def ordered_split(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, *,
                  test_fraction: float | None = TEST_FRACTION, train_fraction: float | None = None,
                  bucket_seconds: float | None = None, bucket: Column | None = None,
                  whole: bool = False) -> DataFrame:
    """Unshuffled split per series: the first rows train, the rest test.

    ``test_fraction=f`` -> test = ceil(f*n); ``train_fraction=f`` -> train =
    floor(f*n). Positions and series lengths come from the bucketed
    ``row_ids`` (no single task per key, no join on the key alone); ``whole``
    and ``bucket`` are passed on to it.
    """
    keys, order = list(keys), list(order)
    pos = row_ids(df, keys, order, "_ms_pos", total="_ms_n", bucket_seconds=bucket_seconds,
                  bucket=bucket, whole=whole)
    n = F.col("_ms_n")
    if train_fraction is not None:
        n_train = F.floor(F.lit(float(train_fraction)) * n)
    else:
        n_train = n - F.ceil(F.lit(float(test_fraction)) * n)
    return (pos
            .withColumn("split", F.when(F.col("_ms_pos") <= n_train, F.lit("train")).otherwise(F.lit("test")))
            .drop("_ms_pos", "_ms_n"))


def random_split(df: DataFrame, id_col: str, train_percent: int = RANDOM_TRAIN_PERCENT,
                 seed: int = SEED) -> DataFrame:
    """Seeded split of exact size: the ceil(n * (100 - train_percent) / 100) rows
    with the smallest hashes of their id test, the rest train. Nothing is sorted
    as a whole: the rows are counted by the first 16 bits of the hash (at most
    65,536 cells), which decides all cells but the one in which the number of test
    rows is reached; only that one, about n / 65,536 rows, is put in order, by
    hash and id. A recomputed partition gives the same rows. MD5, because other
    engines have it, too."""
    digest = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))).cast("binary"))
    rows = df.withColumn("_rs_hash", digest).withColumn("_rs_cell", F.substring("_rs_hash", 1, 4))
    cells = rows.groupBy("_rs_cell").agg(F.count(F.lit(1)).alias("_rs_n"))
    upto, total = F.sum("_rs_n").over(Window.orderBy("_rs_cell")), F.sum("_rs_n").over(Window.partitionBy())
    wanted = F.floor((total * (100 - train_percent) + 99) / 100)
    cells = cells.withColumn("_rs_test", wanted - (upto - F.col("_rs_n")))  # test rows in this cell, if within its size
    marked = rows.join(cells, "_rs_cell")
    within = (F.col("_rs_test") > 0) & (F.col("_rs_test") < F.col("_rs_n"))
    place = F.row_number().over(Window.partitionBy("_rs_cell").orderBy("_rs_hash", id_col))
    side = lambda test: F.when(test, F.lit("test")).otherwise(F.lit("train"))
    whole = marked.filter(~within).withColumn("split", side(F.col("_rs_test") > 0))
    cut = marked.filter(within).withColumn("_rs_place", place).withColumn("split", side(F.col("_rs_place") <= F.col("_rs_test")))
    return whole.unionByName(cut.drop("_rs_place")).select(*df.columns, "split")


def fit_rows(train: DataFrame, id_col: str, name: str = "fit-rows") -> DataFrame:
    """``train`` as a table dealt by ``id_col`` over all cores, in order of it. A
    fit passes over its rows once a level and more; adaptive execution sizes
    tasks by bytes, and rows of a few numbers, however costly for a forest, would
    all share one. Up to ``FIT_TASK_ROWS`` rows stay as they are."""
    rows = materialized(train, name)
    tasks = -(-rows.count() // FIT_TASK_ROWS)
    if tasks <= 1:
        return rows
    # a forest's statistics are sent by every task: no more tasks than keep all cores busy
    tasks = max(min(tasks, train.sparkSession.sparkContext.defaultParallelism), rows.rdd.getNumPartitions())
    return rows.repartition(tasks, id_col).sortWithinPartitions(id_col)


# --------------------------------------------------------------------- scaler

@dataclass
class Scaler:
    features: list[str]
    mean: list[float]
    std: list[float]

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str]) -> "Scaler":
        """Population statistics; one aggregation, |features| rows collected."""
        rows = {r["feature"]: r for r in scaler_stats(df, features).collect()}
        if any(rows[f]["mean"] is None for f in features):
            from loamline.operators.quality import FrameContractError
            raise FrameContractError("cannot fit a scaler on an empty frame")
        return cls(list(features), [float(rows[f]["mean"]) for f in features],
                   [float(rows[f]["std"]) for f in features])

    def columns(self) -> list[Column]:
        return [((F.col(f) - F.lit(m)) / F.lit(s)).alias(f)
                for f, m, s in zip(self.features, self.mean, self.std)]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f: (F.col(f) - F.lit(m)) / F.lit(s)
                               for f, m, s in zip(self.features, self.mean, self.std)})


def standardise(df: DataFrame, scaler: Scaler) -> DataFrame:
    return scaler.transform(df)


# --------------------------------------------------------------- linear model

@dataclass
class LinearModel:
    """Linear regressor on standardised features. The scaler is frozen with
    the weights; retraining updates weights only."""
    scaler: Scaler
    weights: list[float]
    intercept: float
    version: int = 0
    mark: dict = field(default_factory=dict)

    def predict(self) -> Column:
        expr = F.lit(float(self.intercept))
        for f, m, s, w in zip(self.scaler.features, self.scaler.mean, self.scaler.std, self.weights):
            expr = expr + F.lit(float(w)) * ((F.col(f) - F.lit(m)) / F.lit(s))
        return expr

    def score(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.predict())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "LinearModel":
        d = json.loads(text)
        d["scaler"] = Scaler(**d["scaler"])
        return cls(**d)

    def save(self, spark: SparkSession, path: str) -> None:
        """Versioned one-row table; a new version is a new sub-folder, so a
        half-written save never replaces the last good one."""
        (spark.createDataFrame([(self.version, self.to_json())], "version long, state string")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/v={self.version}"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LinearModel":
        row = (spark.read.parquet(path).orderBy(F.col("version").desc()).limit(1).first())
        return cls.from_json(row["state"])


def gram_moments(df: DataFrame, features: Sequence[str], target: str,
                 scaler: Scaler | None = None) -> DataFrame:
    """One row: n and the means of z_i, z_i*z_j (i <= j), z_i*y, y and y^2,
    where z are the (optionally standardised) features. Means rather than
    sums keep the magnitudes, and the rounding error, independent of n."""
    feats = list(features)
    z = ({f: c for f, c in zip(feats, scaler.columns())} if scaler
         else {f: F.col(f) for f in feats})
    y = F.col(target)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("m_y"), F.avg(y * y).alias("m_yy")]
    for i, a in enumerate(feats):
        aggs += [F.avg(z[a]).alias(f"m_{a}"), F.avg(z[a] * y).alias(f"m_{a}_y")]
        for b in feats[i:]:
            aggs.append(F.avg(z[a] * z[b]).alias(f"m_{a}_{b}"))
    return df.agg(*aggs)


def _normal_equations(row, feats: list[str]) -> tuple[np.ndarray, np.ndarray, float, float]:
    """E[[z 1]^T [z 1]] and E[[z 1]^T y] from a gram_moments row."""
    d = len(feats)
    a = np.zeros((d + 1, d + 1))
    v = np.zeros(d + 1)
    for i, fa in enumerate(feats):
        for j, fb in enumerate(feats[i:], start=i):
            a[i, j] = a[j, i] = row[f"m_{fa}_{fb}"]
        a[i, d] = a[d, i] = row[f"m_{fa}"]
        v[i] = row[f"m_{fa}_y"]
    a[d, d] = 1.0
    v[d] = row["m_y"]
    return a, v, float(row["n"]), float(row["m_yy"])


def fit_least_squares(df: DataFrame, features: Sequence[str] = MOISTURE_FEATURES,
                      target: str = MOISTURE_TARGET, scaler: Scaler | None = None) -> LinearModel:
    """Unpenalised squared-loss linear fit -- the point a constant-rate SGD
    regressor converges to -- from one distributed Gram pass."""
    feats = list(features)
    scaler = scaler or Scaler.fit(df, feats)
    row = gram_moments(df, feats, target, scaler).first()
    a, v, _, _ = _normal_equations(row, feats)
    beta = np.linalg.lstsq(a, v, rcond=None)[0]
    return LinearModel(scaler, [float(x) for x in beta[:-1]], float(beta[-1]))


def gradient_step(df: DataFrame, model: LinearModel, target: str = MOISTURE_TARGET,
                  eta: float = SGD_LEARNING_RATE) -> DataFrame:
    """One full-batch gradient step of the squared loss (1/2 mean residual^2)
    from ``model``: one row with the new intercept and weights."""
    resid = model.predict() - F.col(target)
    z = model.scaler.columns()
    aggs = [(F.lit(model.intercept) - F.lit(eta) * F.avg(resid)).alias("intercept")]
    for f, w, zc in zip(model.scaler.features, model.weights, z):
        aggs.append((F.lit(w) - F.lit(eta) * F.avg(resid * zc)).alias(f"w_{f}"))
    return df.agg(*aggs)


# ---------------------------------------------------------------- tree models

def _assembled(features: Sequence[str]):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def linear_regression(features=MOISTURE_FEATURES, target=MOISTURE_TARGET):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    return Pipeline(stages=[_assembled(features),
                            LinearRegression(featuresCol="features", labelCol=target,
                                             solver="normal", regParam=0.0)])


def forest_regressor(features=MOISTURE_FEATURES, target=MOISTURE_TARGET,
                     max_depth=FOREST_REGRESSOR_DEPTH, num_trees=FOREST_TREES, seed=SEED):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import RandomForestRegressor
    return Pipeline(stages=[_assembled(features),
                            RandomForestRegressor(featuresCol="features", labelCol=target,
                                                  maxDepth=max_depth, numTrees=num_trees, seed=seed)])


def boosted_regressor(features=MOISTURE_FEATURES, target=MOISTURE_TARGET,
                      max_iter=BOOSTED_ITERATIONS, step_size=BOOSTED_STEP, seed=SEED):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import GBTRegressor
    return Pipeline(stages=[_assembled(features),
                            GBTRegressor(featuresCol="features", labelCol=target, maxIter=max_iter,
                                         stepSize=step_size, seed=seed)])


def tree_classifier(features, label="Output", max_depth=TREE_CLASSIFIER_DEPTH, weight_col="weight",
                    seed=SEED):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    return Pipeline(stages=[_assembled(features),
                            DecisionTreeClassifier(featuresCol="features", labelCol=label,
                                                   maxDepth=max_depth, weightCol=weight_col, seed=seed)])


def forest_classifier(features, label="Output", num_trees=FOREST_TREES, max_depth=FOREST_MAX_DEPTH,
                      weight_col="weight", seed=SEED):
    """Random forest with sqrt feature sampling and balanced class weights.
    Spark caps depth at 30 (the reference grows trees without a limit). The node
    of every row is kept between levels: deep trees are not sent to the tasks and
    walked from the root again at each; the trees are the same."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    return Pipeline(stages=[_assembled(features),
                            RandomForestClassifier(featuresCol="features", labelCol=label,
                                                   numTrees=num_trees, maxDepth=max_depth,
                                                   featureSubsetStrategy="sqrt", cacheNodeIds=True,
                                                   weightCol=weight_col, seed=seed)])


def model_comparison(scored: DataFrame, target: str = MOISTURE_TARGET,
                     model_col: str = "model", pred: str = "prediction") -> DataFrame:
    """(model, r2, rmse) from the union of every model's test predictions."""
    from loamline.operators.metrics import regression_metrics
    return regression_metrics(scored, target, pred, by=[model_col]).drop("n")
