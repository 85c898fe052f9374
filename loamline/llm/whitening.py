"""Whitening of embeddings from exact, bit-sliced cross-products.

Each entry c of a vector becomes the integer x = floor(64 c) + 1,000,000.
Passes over the table:

1. rows, sums, least and largest x of every dimension;
2. cross-products: x, less the dimension's least value, is cut into bit planes;
   each plane of ``BLOCK_ROWS`` rows is packed into 64-bit words, and the ones
   of the AND of two planes are counted. Planes a and b of dimensions i and j
   weigh 2 ** (a + b), so the counts per (i, j, a + b), summed over all rows as
   integers, give every cross-product exactly;
3. the whitened vectors' covariance, measured on the rows;
4. the output.

The driver holds numbers per pair of dimensions only: the counts are weighted
and centred there as Python integers of any size, (n * sum xy - sum x * sum y)
/ n ** 2, before eigh. Components are numbered by falling eigenvalue; of the
two signs that one is taken that makes an eigenvector's largest entry positive.

Rows whose vector is null, empty, or has null or non-finite entries are
dropped, and those of another length than most rows have (ties: the longer).
Entries beyond +-2 ** 55 are cut to that, so that x is a long. Zero vectors,
null and repeated vec_ids and repeated rows are rows like others. Components
without variance (an eigenvalue below ``NOTHING`` of the largest) do not exist,
so a table of equal vectors or of one row gives an empty result, as an empty
one does. A deviation beyond a long is null. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, written

STEP, SHIFT = 64, 1_000_000
LARGEST = float(1 << 55)
COMPONENTS = 32
BLOCK_ROWS = 1 << 15
NOTHING = 1e-11
LONG = (1 << 63) - 1
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that are fitted."""
    v = F.col("vector")
    good = (rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].cast("array<double>").alias("vector"))
            .where((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))))
    sizes = good.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return good.where(F.size("vector") == (most[0]["d"] if most else 0))


def scaled(column) -> np.ndarray:
    """x of each entry, one row per vector."""
    if not len(column):
        return np.zeros((0, 1), np.int64)
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(np.clip(STEP * c, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _bounds(batches):
    for batch in batches:
        x = scaled(batch.column("vector"))
        if not len(x):
            continue
        least = x.min(axis=0)
        above = x - least
        # sums as two halves of 32 bits that no number of rows makes overflow
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(x.shape[1]), pa.int32()), pa.array([len(x)] * x.shape[1], pa.int64()), pa.array(least),
             pa.array(x.max(axis=0)), pa.array((above >> 32).sum(axis=0) + len(x) * (least >> 32)),
             pa.array((above & 0xFFFFFFFF).sum(axis=0) + len(x) * (least & 0xFFFFFFFF))],
            names=["i", "n", "least", "most", "high", "low"])


def planes(x: np.ndarray, least: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes of x - least, packed along the rows; a dimension's planes are
    neighbours, the lowest bit first."""
    above = (x - least).astype(np.uint64)
    rows = -(-len(x) // 64) * 64
    out = np.zeros((int(bits.sum()), rows // 8), np.uint8)
    first = np.cumsum(bits) - bits
    for a in range(int(bits.max())):
        has = np.flatnonzero(bits > a)
        ones = np.zeros((rows, len(has)), np.uint8)
        ones[:len(x)] = (above[:, has] >> np.uint64(a)) & np.uint64(1)
        out[first[has] + a] = np.packbits(ones, axis=0).T
    return out.view(np.uint64)


def _scatter(batches, least: np.ndarray, bits: np.ndarray):
    """(i, j, weight, ones): how often bits a of dimension i and b of dimension
    j >= i with a + b = weight are set together, over the rows of this task."""
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.arange(len(dim)) - np.repeat(np.cumsum(bits) - bits, bits)
    total = np.zeros((len(bits), len(bits), max(1, 2 * int(bits.max()) - 1)), np.int64)
    held, size = [], 0

    def add(x):
        packed = planes(x, least, bits)
        for p in range(len(packed)):
            ones = np.bitwise_count(packed[p:] & packed[p]).sum(axis=1, dtype=np.int64)
            twice = (dim[p:] == dim[p]) & (bit[p:] > bit[p])  # (a, b) and (b, a) of one dimension
            np.add.at(total, (dim[p], dim[p:], bit[p] + bit[p:]), ones * (1 + twice))

    for batch in batches:
        x = scaled(batch.column("vector"))
        for k in range(0, len(x), BLOCK_ROWS):
            held.append(x[k:k + BLOCK_ROWS])
            size += len(held[-1])
            if size >= BLOCK_ROWS:
                add(np.concatenate(held))
                held, size = [], 0
    if size:
        add(np.concatenate(held))
    i, j, weight = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(weight.astype(np.int32)),
         pa.array(total[i, j, weight])], names=["i", "j", "weight", "ones"])


@dataclass
class Whitener:
    """What the tasks need to whiten rows; its size depends on the dimensions alone."""
    n: int
    least: np.ndarray  # smallest x of each dimension
    rest: list[int]    # sums of x - least
    widest: int        # largest |n * x - sum of x| of any entry
    values: np.ndarray
    directions: np.ndarray  # one column per component
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum of x, exact (Python integers where a long is too small)."""
        above = x - self.least
        if self.widest * self.widest * x.shape[1] <= LONG:
            return self.n * above - np.array(self.rest, np.int64)
        return self.n * above.astype(object) - np.array(self.rest, object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        z = (self.centred(x) / self.n).astype(float)
        return z @ self.directions / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        found = (self.centred(x) ** 2).sum(axis=1).tolist()
        return [v if v <= LONG else None for v in found]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of all rows (vec_id, vector); None without variance."""
    vector = rows.select("vector")
    found = (vector.mapInArrow(_bounds, "i int, n long, least long, most long, high long, low long")
             .groupBy("i").agg(F.sum("n"), F.min("least"), F.max("most"), F.sum("high"), F.sum("low")).orderBy("i").collect())
    if not found:
        return None
    n = found[0][1]
    least = np.array([r[2] for r in found], np.int64)
    bits = np.array([(r[3] - r[2]).bit_length() for r in found])
    rest = [(r[4] << 32) + r[5] - n * r[2] for r in found]  # sums of x - least
    if not bits.any():
        return None
    counted = (vector.mapInArrow(lambda batches: _scatter(batches, least, bits), "i int, j int, weight int, ones long")
               .groupBy("i", "j", "weight").agg(F.sum("ones").alias("ones")).collect())
    above: dict[tuple[int, int], int] = {}
    for r in counted:
        above[r.i, r.j] = above.get((r.i, r.j), 0) + (r.ones << r.weight)
    d = len(found)
    covariance = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            covariance[i, j] = covariance[j, i] = (n * above.get((i, j), 0) - rest[i] * rest[j]) / (n * n)
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > NOTHING * values.max()]
    directions = directions[:, order]
    sign = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(order))])
    widest = max(max(s, n * (r[3] - r[2]) - s) for r, s in zip(found, rest))
    return Whitener(n, least, rest, widest, values[order], directions * sign, values[order] / np.trace(covariance))


def identity_error(rows: DataFrame, fitted: Whitener) -> float:
    """Largest difference between the whitened rows' covariance and the identity."""
    k = len(fitted.values)

    def moments(batches):
        mean, square, n = np.zeros(k), np.zeros((k, k)), 0
        for batch in batches:
            w = fitted.whitened(scaled(batch.column("vector")))
            if len(w):
                centre = w.mean(axis=0)
                move, both = centre - mean, n + len(w)
                square += (w - centre).T @ (w - centre) + np.outer(move, move) * n * len(w) / both
                mean, n = mean + move * len(w) / both, both
        # sums and products, relative to the tasks' own means
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(square.ravel()), pa.array(n * mean[i]),
             pa.array(n * mean[i] * mean[j])], names=["i", "j", "square", "total", "between"])

    found = (rows.select("vector").mapInArrow(moments, "i int, j int, square double, total double, between double")
             .groupBy("i", "j").agg(F.sum("square"), F.sum("total"), F.sum("between")).collect())
    total = {r[0]: r[3] / fitted.n for r in found}
    return max(abs((r[2] + r[4]) / fitted.n - total[r[0]] * total[r[1]] - (r[0] == r[1])) for r in found)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of
    each usable row of (vec_id, embedding) and each component."""
    spark = rows.sparkSession
    bounded_batches(spark)
    usable = written(vectors(rows), "vectors")
    fitted = fit(usable, components)
    if fitted is None:
        return spark.createDataFrame([], OUT)
    error = identity_error(usable, fitted)
    k = len(fitted.values)

    def out(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = scaled(part.column("vector"))
                at = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, fitted.n)), pa.array(fitted.deviation(x), pa.int64()).take(at),
                     pa.array(fitted.whitened(x).ravel()), pa.array(np.tile(fitted.explained, len(x))),
                     pa.array(np.full(len(x) * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(out, OUT)
