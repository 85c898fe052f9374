"""Exact trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.operators import series, trees


def brute_tree(x, y, w, depth, node=1, out=None):
    """node -> (feature, threshold, p1) by trying every cut."""
    out = {} if out is None else out
    gini = lambda m: 2 * (w[m] * y[m]).sum() * (w[m].sum() - (w[m] * y[m]).sum()) / w[m].sum()
    every = np.ones(len(y), bool)
    p1, best = (w * y).sum() / w.sum(), None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                left = x[:, f] <= a
                gain = round((gini(every) - gini(left) - gini(~left)) / w.sum(), 12)
                if gain > 1e-12 and (best is None or gain > best[0]):
                    best = (gain, f, (a + b) / 2, left)
    out[node] = (best[1], pytest.approx(best[2]), pytest.approx(p1)) if best else (None, None, pytest.approx(p1))
    if best:
        for side, m in ((0, best[3]), (1, ~best[3])):
            brute_tree(x[m], y[m], w[m], depth - 1, 2 * node + side, out)
    return out


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(1000, 3)), 2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] + 0.3 * rng.normal(size=1000) > 0)).astype(int)
    w = np.where(y, 1.5, 0.75)
    df = spark.createDataFrame([(*map(float, r), int(c), float(v)) for r, c, v in zip(x, y, w)], "a double, b double, c double, y int, w double")
    broken = spark.createDataFrame([(None, 1.0, 1.0, 1, 1.0), (1.0, float("nan"), 1.0, 0, 1.0), (1.0, 1.0, 1.0, None, 1.0)], df.schema)
    return x, y, w, df.unionByName(broken)


@pytest.mark.parametrize("bucket_rows", [None, 60])
def test_tree_equals_brute_force(spark, points, bucket_rows):
    """Also where the values of a node are cut into buckets."""
    x, y, w, df = points
    tree = trees.fit_tree(df, ["a", "b", "c"], "y", "w", max_depth=2, bucket_rows=bucket_rows)
    got = {r.node: (r.feature, r.threshold, r.p1) for r in tree.nodes.collect()}
    assert got == brute_tree(x, y, w, 2) and tree.levels == 2


def test_prediction_and_round_trip(spark, points, scratch):
    x, y, w, df = points
    tree = trees.fit_tree(df, ["a", "b", "c"], "y", "w", max_depth=4)
    tree.save(f"{scratch}/tree")
    again = trees.Tree.load(spark, f"{scratch}/tree", tree.features)
    rows = again.predict(df, probability="p").collect()
    nodes = brute_tree(x, y, w, 4)

    def leaf(r):
        node = 1
        while nodes[node][0] is not None:
            f, t, _ = nodes[node]
            node = 2 * node + int(r[f] > t.expected)
        return nodes[node][2]

    ok = [r for r in rows if r.y is not None and r.a is not None and r.b == r.b]
    assert len(rows) == len(x) + 3 and all(r.p == leaf((r.a, r.b, r.c)) and r.prediction == (r.p > 0.5) for r in ok)
    assert sum(r.prediction == r.y for r in ok) > 0.85 * len(ok)
    assert sorted(str(r.prediction) for r in rows if r.a is None or r.b != r.b) == ["None", "None"]


def test_a_tree_without_limit_is_pure(spark):
    df = spark.createDataFrame([(float(i), (i // 3) % 2) for i in range(60)], "a double, y int")
    tree = trees.fit_tree(df, ["a"], "y")
    assert tree.levels > 4 and tree.predict(df).filter("prediction != y").isEmpty()
    one = trees.fit_tree(df.filter("y = 1"), ["a"], "y")
    assert one.nodes.count() == 1 and one.predict(df).agg(F.min("prediction")).first()[0] == 1
    assert trees.fit_tree(df.limit(0), ["a"], "y").nodes.count() == 0


def test_prefix_sums_equal_one_window(spark):
    df = spark.createDataFrame([(i % 3 if i % 4 else 0, i, float(i % 7), 1.0) for i in range(900)], "k long, o long, a double, b double")
    args = (df, ["k"], ["o"], {"x": "a", "y": "b"})
    small, large = (sorted(map(tuple, series.prefix_sums(*args, totals={"t": "a"}, bucket_rows=n).collect())) for n in (50, 10**9))
    assert small == large
