"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample by balanced bisection: a two-means
split at the median, again and again, so that lists are of equal weight. The
centroids' neighbourhood graph is searched in memory, best first, by every
task. A vector goes to its nearest lists: besides the first, those within
``REPLICA_RATIO`` of its distance (so boundary vectors are in several, up to
REPLICAS). A query reads the lists within
``SEARCH_RATIO`` of its nearest centroid's distance.

Lists are joined with queries by (list, block): a list is cut into blocks of
``BLOCK`` rows, so no list is too large for a task. Of equal vectors only the
k + 1 smallest ids can be among the nearest, so more are not indexed, and
equal queries are searched once; a vector that a third of all rows share costs
no more than others. Distances are Euclidean in double precision on the
original vectors; ties go to the smaller vec_id.

Driver and broadcast hold SAMPLE vectors and MAX_LISTS centroids at most.
Vectors that are null, empty, zero, of another length than most, or hold a
null or non-finite component take no part, nor do null ids; rows that repeat
an id count once. Extra columns are dropped; an empty table has no result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

SAMPLE = 20_000
MAX_LISTS = 2048
LIST_ROWS = 64
LINKS = 24
BEAM = 96
REPLICAS, REPLICA_RATIO = 8, 1.08
LEAST_SEARCHED, MOST_SEARCHED, SEARCH_RATIO = 48, 96, 1.15
BLOCK = 4096
ROUTED = "id long, vector array<float>, list int"
FOUND = "q long, vec_id long, score double"


def balanced_centroids(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Means of ``lists`` parts of ``x``, each split off by two-means at the proportional quantile."""
    if lists <= 1 or len(x) < 2:
        return x.mean(axis=0, keepdims=True)
    a, b = x[rng.choice(len(x), 2, replace=False)]
    left = lists // 2
    cut = max(1, min(len(x) - 1, round(len(x) * left / lists)))
    for _ in range(6):
        side = x @ (a - b) * 2 - (a @ a - b @ b)
        order = np.argsort(-side, kind="stable")
        a, b = x[order[:cut]].mean(axis=0), x[order[cut:]].mean(axis=0)
    return np.concatenate([balanced_centroids(x[order[:cut]], left, rng),
                           balanced_centroids(x[order[cut:]], lists - left, rng)])


@dataclass(frozen=True)
class Graph:
    centroids: np.ndarray
    links: np.ndarray  # neighbours of each centroid

    @classmethod
    def of(cls, centroids: np.ndarray, rng: np.random.Generator, links: int = LINKS) -> Graph:
        n = len(centroids)
        near = min(links, n - 1)
        out = np.zeros((n, near + min(4, n)), np.int64)
        for i in range(n):
            d = ((centroids - centroids[i]) ** 2).sum(axis=1)
            d[i] = np.inf
            out[i, :near] = np.argsort(d, kind="stable")[:near]
        out[:, near:] = rng.integers(0, n, (n, out.shape[1] - near))  # long links keep the graph connected
        return cls(centroids, out)

    def nearest(self, v: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """About ``beam`` nearest centroids, nearest first, and their distances."""
        n = len(self.centroids)
        if n <= 2 * beam:  # the graph saves nothing
            d = np.sqrt(((self.centroids - v) ** 2).sum(axis=1))
            order = np.argsort(d, kind="stable")[:beam]
            return order, d[order]
        starts = np.arange(0, n, max(1, n // 16))
        seen = np.zeros(n, bool)
        seen[starts] = True
        d = ((self.centroids[starts] - v) ** 2).sum(axis=1)
        todo = list(zip(d.tolist(), starts.tolist()))
        heapq.heapify(todo)
        best = [(-x, c) for x, c in todo]
        heapq.heapify(best)
        while todo:
            x, c = heapq.heappop(todo)
            if len(best) >= beam and x > -best[0][0]:
                break
            new = self.links[c]
            new = np.unique(new[~seen[new]])
            if not len(new):
                continue
            seen[new] = True
            for y, e in zip(((self.centroids[new] - v) ** 2).sum(axis=1).tolist(), new.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (-y, e))
                    heapq.heappush(todo, (y, e))
                elif y < -best[0][0]:
                    heapq.heapreplace(best, (-y, e))
                    heapq.heappush(todo, (y, e))
        found = sorted((-y, e) for y, e in best)
        return np.array([e for _, e in found]), np.sqrt([y for y, _ in found])

    def home(self, v: np.ndarray) -> list[int]:
        """Lists a vector is stored in."""
        ids, d = self.nearest(v, 16)
        kept = [int(ids[0])]
        for c, x in zip(ids[1:].tolist(), d[1:].tolist()):
            if x > REPLICA_RATIO * d[0] or len(kept) == REPLICAS:
                break
            kept.append(c)
        return kept

    def searched(self, v: np.ndarray) -> list[int]:
        """Lists a query reads."""
        ids, d = self.nearest(v, BEAM)
        n = int(np.searchsorted(d, SEARCH_RATIO * d[0], "right"))
        return ids[:max(LEAST_SEARCHED, min(MOST_SEARCHED, n))].tolist()


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(flat):
        return np.zeros((0, 1))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def _routed(batches, graph: Graph, query: bool):
    for batch in batches:
        x = matrix(batch.column(1))
        lists = [graph.searched(v) if query else graph.home(v) for v in x]
        at = np.repeat(np.arange(len(x)), [len(c) for c in lists])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
             pa.array([c for cs in lists for c in cs], pa.int32())], names=["id", "vector", "list"])


def _searched(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of a block for each query that reads it."""
    q, x = matrix(queries.column("vector")), matrix(rows.column("vector"))
    ids = rows.column("id").to_numpy()
    out = []
    for name, v in zip(queries.column("id").to_pylist(), q if len(ids) else ()):
        score = np.sqrt(((x - v) ** 2).sum(axis=1))
        if len(score) > 4 * k:  # all that tie with the k-th stay
            some = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
        else:
            some = np.arange(len(score))
        some = some[np.lexsort((ids[some], score[some]))[:k]]
        out.append((np.full(len(some), name), ids[some], score[some]))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
    return pa.table({"q": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)),
                     "score": pa.array(cols[2], pa.float64())})


def usable(rows: DataFrame) -> DataFrame:
    """(id, vector), one row per id, of the vectors that take part."""
    v = F.col("vector")
    good = (rows.select(rows["vec_id"].cast("long").alias("id"), rows["embedding"].cast("array<float>").alias("vector"))
            .where(F.col("id").isNotNull() & (F.size(v) > 0)
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                   & F.exists(v, lambda x: x != 0)))
    good = good.groupBy("id").agg(F.min("vector").alias("vector"))
    sizes = good.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return good.where(F.size("vector") == (most[0]["d"] if most else 0))


def fit(rows: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Graph | None:
    """Centroid graph from the ``sample`` vectors with the smallest hashes."""
    n = rows.count()
    if not n:
        return None
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    x, rng = matrix(picked.column("vector")), np.random.default_rng(seed)
    lists = max(1, min(MAX_LISTS, n // LIST_ROWS, len(x) // 4))
    return Graph.of(np.unique(balanced_centroids(x, lists, rng), axis=0), rng)


def search(rows: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row
    whose vec_id is divisible by ``every``."""
    spark = rows.sparkSession
    rows = written(usable(rows), "vectors")
    graph = fit(rows)
    if graph is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # of equal vectors, the k + 1 smallest ids (Spark limits each task's groups before the shuffle)
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    stored = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1).select("id", "vector")
    queries = rows.where(F.col("id") % every == 0)
    leaders = queries.groupBy("vector").agg(F.min("id").alias("q"))
    asked = queries.join(leaders, "vector").select("q", F.col("id").alias("query_id"))
    lists = written(stored.mapInArrow(partial(_routed, graph=graph, query=False), ROUTED), "lists")
    # at most MAX_LISTS rows
    blocks = lists.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    stored = lists.join(F.broadcast(blocks), "list").select(
        "id", "vector", "list", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"))
    reads = (leaders.select(F.col("q").alias("id"), "vector")
             .mapInArrow(partial(_routed, graph=graph, query=True), ROUTED)
             .join(F.broadcast(blocks), "list")
             .select("id", "vector", "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    found = (reads.groupBy("list", "block").cogroup(stored.groupBy("list", "block"))
             .applyInArrow(lambda key, a, b: _searched(a, b, k + 1), FOUND))
    nearest = Window.partitionBy("q").orderBy("score", "vec_id")
    merged = (found.groupBy("q", "vec_id").agg(F.min("score").alias("score"))
              .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1).drop("rank"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (merged.join(asked, "q").where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
