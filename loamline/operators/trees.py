"""Classification trees with exact splits, grown level by level.

Every cut between two neighbouring values of every feature is scored by the
decrease of the weighted Gini impurity. The class weights of each (node,
feature, value) are one aggregation; running sums along the values
(``series.prefix_sums``, so a node or feature that holds most rows is cut into
buckets) give both sides of every cut, and a partial minimum per node picks the
best. A level costs the same few shuffles whatever its number of nodes.

The tree stays a table of nodes, in heap order (children of i: 2 i and
2 i + 1), and is applied level by level by joins, so neither its size nor its
depth is bounded by the driver; 61 levels fit the node number. Rows and nodes of a
level are written to the shared folder: a lost executor repeats one level at most.

Labels are 0 or 1; rows with a missing label, weight or feature take no part in
the fit, and rows with a missing feature get no prediction. Ties between cuts go
to the first feature, then to the smallest value. Missing weights are 1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamline.functions.scalar import is_missing
from loamline.operators.series import prefix_sums
from loamline.session import materialized

LEAST_GAIN = 1e-12
MOST_LEVELS = 61
_NODE, _X, _Y, _W = "_tr_node", "_tr_x", "_tr_y", "_tr_w"


def _gini(ones, weight):
    """Gini impurity times weight."""
    return 2 * ones * (weight - ones) / weight


def best_splits(rows: DataFrame, bucket_rows: int | None = None) -> DataFrame:
    """(node, feature, threshold, gain) of each node with a cut that gains; rows
    are (node, features as an array, label, weight). ``feature`` counts from 0;
    the threshold lies halfway between the values on both sides of the cut."""
    each = rows.select(_NODE, _Y, _W, F.posexplode(_X).alias("feature", "value"))
    sums = each.groupBy(_NODE, "feature", "value").agg(F.sum(_W).alias("w"), F.sum(F.col(_W) * F.col(_Y)).alias("w1"))
    keys = [_NODE, "feature"]
    cuts = prefix_sums(sums, keys, ["value"], {"left": "w", "left1": "w1"}, totals={"all": "w", "all1": "w1"},
                       bucket_rows=bucket_rows)
    right, right1 = F.col("all") - F.col("left"), F.col("all1") - F.col("left1")
    gain = (_gini(F.col("all1"), F.col("all")) - _gini(F.col("left1"), F.col("left")) - _gini(right1, right)) / F.col("all")
    # what rounding leaves to the right of the last value is no weight
    inner = cuts.filter(right > 1e-9 * F.col("all")).withColumn("gain", F.round(gain, 12))
    best = inner.groupBy(_NODE).agg(F.min(F.struct((-F.col("gain")).alias("loss"), "feature", "value")).alias("b"))
    best = best.select(_NODE, "b.feature", F.col("b.value").alias("at"), (-F.col("b.loss")).alias("gain")).filter(
        F.col("gain") > LEAST_GAIN)
    after = sums.join(best, keys).filter(F.col("value") > F.col("at")).groupBy(_NODE).agg(F.min("value").alias("next"))
    return best.join(after, _NODE).select(_NODE, "feature", ((F.col("at") + F.col("next")) / 2).alias("threshold"), "gain")


def tree_rows(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """The rows of a fit, all at the root."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    whole = ~is_missing(label)
    for f in features:
        whole = whole & ~is_missing(f)
    return df.filter(whole).select(F.lit(1).cast("long").alias(_NODE), F.array(*[F.col(f).cast("double") for f in features]).alias(_X),
                                   F.col(label).cast("double").alias(_Y), w.alias(_W))


@dataclass
class Tree:
    """``nodes``: node, level, weight, p1 (share of the weight with label 1), feature
    and threshold (NULL in leaves), gain."""
    features: list[str]
    nodes: DataFrame
    levels: int

    def predict(self, df: DataFrame, name: str = "prediction", probability: str | None = None) -> DataFrame:
        """``df`` with the class of the leaf that each row falls into."""
        x = F.array(*[F.col(f).cast("double") for f in self.features])
        missing = F.exists(x, lambda v: v.isNull() | F.isnan(v))
        out = df.withColumn(_X, x).withColumn(_NODE, F.when(~missing, F.lit(1).cast("long")))
        for level in range(self.levels):
            out = descended(out, self.nodes.filter((F.col("level") == level) & F.col("feature").isNotNull()), "left")
        leaves = self.nodes.select(F.col("node").alias(_NODE), "p1")
        out = out.join(leaves.withColumnRenamed("p1", "_tr_p1"), _NODE, "left")
        out = out.withColumn(name, (F.col("_tr_p1") > 0.5).cast("int"))
        if probability:
            out = out.withColumn(probability, F.col("_tr_p1"))
        return out.drop(_X, _NODE, "_tr_p1")

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str]) -> "Tree":
        nodes = spark.read.parquet(path)
        return cls(list(features), nodes, nodes.agg(F.max("level")).first()[0] or 0)


def descended(rows: DataFrame, splits: DataFrame, how: str) -> DataFrame:
    """Rows one level further down; ``left`` keeps those already in a leaf."""
    s = splits.select(F.col("node").alias("_tr_of"), F.col("feature").alias("_tr_f"), F.col("threshold").alias("_tr_t"))
    found = rows.join(s, F.col(_NODE) == F.col("_tr_of"), how)
    right = (F.get(_X, F.col("_tr_f")) > F.col("_tr_t")).cast("long")
    down = F.when(F.col("_tr_of").isNull(), F.col(_NODE)).otherwise(2 * F.col(_NODE) + right)
    return found.withColumn(_NODE, down).drop("_tr_of", "_tr_f", "_tr_t")


def fit_tree(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None,
             max_depth: int = MOST_LEVELS, bucket_rows: int | None = None) -> Tree:
    """The tree of all rows. Only whether a level has a split reaches the driver."""
    rows = materialized(tree_rows(df, features, label, weight), "tree-rows")
    nodes, level = None, 0
    while True:
        stats = rows.groupBy(_NODE).agg(F.sum(_W).alias("weight"), (F.sum(F.col(_W) * F.col(_Y)) / F.sum(_W)).alias("p1"))
        splits = best_splits(rows, bucket_rows)
        if level == max_depth:
            splits = splits.limit(0)
        here = materialized(stats.join(splits, _NODE, "left").select(
            F.col(_NODE).alias("node"), F.lit(level).alias("level"), "weight", "p1", "feature", "threshold", "gain"), "tree-nodes")
        nodes = here if nodes is None else nodes.unionByName(here)
        inner = here.filter(F.col("feature").isNotNull())
        if inner.isEmpty():
            return Tree(list(features), nodes, level)
        rows = materialized(descended(rows, inner, "inner"), "tree-rows")
        level += 1
