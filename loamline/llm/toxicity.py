"""Toxicity by a classifier chain over word and word-stem features.

The categories are predicted in turn: ``explicit`` (insults in plain words),
``coded`` (none of them), ``toxic`` (the label). Each is a logistic model
over the text's features and the probabilities of the categories before it.
In training those probabilities are out of fold, so a later model sees them
as wrong as they will be on new texts.

A feature is a whole lower-cased word or the first 3 to 8 bytes of one; its
value is log(1 + SCALE * share of the text's words), so a word met by chance
in a long text weighs little. The labelled rows with the smallest hashes,
``SAMPLE`` of each class at most, train the models (the bound is what the
driver holds: SAMPLE * 2 rows of ``FEATURES`` numbers); the features are those
whose means differ most between the classes, by Welch's statistic over the
sample. Class weights restore the shares that all labels have.

A null or empty text gets the models' intercepts. Labels that are null are no
labels; of several for one document the largest counts. Without labels of
both classes nothing is toxic. Rows are scored one by one: repeated rows get
equal scores; extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import U, chunks, letter_values, mix, utf8, words
from .tables import bounded_batches, texts, written

SAMPLE = 4000
FEATURES = 512
FOLDS = 3
LEAST_TEXTS = 8
SCALE = 100.0
STEMS = range(3, 9)
WORD_BYTES = 24
THRESHOLD = 0.5
CATEGORIES = ("explicit", "coded", "toxic")
# fixed values: plain insults that tell the first category from the second in training
PLAIN = ("clown", "disgusting", "dumb", "fool", "garbage", "idiot", "imbecile", "jerk", "loser", "moron",
         "pathetic", "scum", "stupid", "trash", "useless", "worthless")
SCHEMA = "doc_id long, p_explicit double, p_coded double, p_toxic double, toxic boolean"
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def features(data: np.ndarray, offsets: np.ndarray):
    """Yield (text numbers, feature hashes, words of each text, first text) per chunk of texts."""
    for a, b in chunks(offsets):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        start, end, word_at = words(part, at, _BETWEEN)
        n = np.diff(word_at)
        if not len(start):
            yield np.zeros(0, np.int64), np.zeros(0, np.uint64), n, a
            continue
        letters, first, size = letter_values(part, start, end, lower=True)
        total = np.concatenate([[U(0)], np.cumsum(letters, dtype=np.uint64)])
        text = np.repeat(np.arange(b - a), n)
        found = [(text[size <= WORD_BYTES], mix((total[first + size] - total[first])[size <= WORD_BYTES] + U(255)))]
        for k in STEMS:
            long = size >= k
            found.append((text[long], mix((total[first[long] + k] - total[first[long]]) + U(k))))
        yield np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]), n, a


def counted(text: np.ndarray, feature: np.ndarray, n_words: np.ndarray):
    """(text, feature, value) of each distinct feature in each text."""
    if not len(text):
        return text, feature, np.zeros(0)
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])]))
    count = np.diff(np.append(first, len(text)))
    text, feature = text[first], feature[first]
    return text, feature, np.log1p(SCALE * count / np.maximum(n_words[text], 1))


@dataclass(frozen=True)
class Chain:
    names: np.ndarray  # feature hashes, sorted
    weights: np.ndarray  # (categories, features + earlier categories)
    biases: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (texts, categories) of dense feature rows."""
        out = np.zeros((len(x), len(self.biases)))
        for c, (w, b) in enumerate(zip(self.weights, self.biases)):
            out[:, c] = sigmoid(x @ w[:x.shape[1]] + out[:, :c] @ w[x.shape[1]:x.shape[1] + c] + b)
        return out


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, steps: int = 200):
    """Weighted logistic regression with an L2 penalty, by accelerated gradient descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)
    rate = 1 / (0.25 * float((weight * (x1 * x1).sum(axis=1)).sum()) + decay)
    w = look = np.zeros(x1.shape[1], np.float32)
    for t in range(steps):
        grad = x1.T @ (weight * (sigmoid(x1 @ look) - y).astype(np.float32))
        grad[:-1] += decay * look[:-1]
        new = look - rate * grad
        look = new + (t / (t + 3)) * (new - w)
        w = new
    return w[:-1].astype(float), float(w[-1])


def fit_chain(names: np.ndarray, x: np.ndarray, labels: np.ndarray, weight: np.ndarray, fold: np.ndarray) -> Chain:
    """One model per column of ``labels``; earlier columns' out-of-fold
    probabilities are features of the later ones."""
    n, k = labels.shape
    weights, biases = np.zeros((k, x.shape[1] + k)), np.zeros(k)
    earlier = np.zeros((n, 0))
    for c in range(k):
        seen, y = np.hstack([x, earlier]), labels[:, c]
        w, biases[c] = fit_logistic(seen, y, weight)
        weights[c, :len(w)] = w
        held = np.zeros(n)
        for f in range(FOLDS) if c + 1 < k else ():
            out = fold == f
            if out.any() and (~out).any():
                w, b = fit_logistic(seen[~out], y[~out], weight[~out])
                held[out] = sigmoid(seen[out] @ w + b)
        earlier = np.hstack([earlier, held[:, None]])
    return Chain(names, weights, biases)


def _values(batches):
    """Training rows: document, classes and the values of all features."""
    for batch in batches:
        ids, toxic = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        data, offsets = utf8(batch.column(1))
        plain = [any(w in t.lower() for w in PLAIN) for t in batch.column(1).to_pylist()]
        for text, feature, n, a in features(data, offsets):
            text, feature, value = counted(text, feature, n)
            cut = np.searchsorted(text, np.arange(len(n) + 1))
            for i in range(len(n)):
                lo, hi = cut[i], cut[i + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a + i]], pa.int64()), pa.array([toxic[a + i]], pa.int32()),
                     pa.array([plain[a + i]], pa.bool_()),
                     pa.array([feature[lo:hi].astype(np.int64)], pa.list_(pa.int64())),
                     pa.array([value[lo:hi]], pa.list_(pa.float64()))],
                    names=["doc_id", "toxic", "plain", "features", "vals"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = FEATURES) -> Chain:
    """Fit the chain on a bounded sample of the labelled rows of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = texts(docs)
    known = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
             .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Chain(np.zeros(0, np.uint64), np.zeros((len(CATEGORIES), len(CATEGORIES))), np.full(len(CATEGORIES), -30.0))
    if len(total) < 2:
        return none
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = (known.where("toxic = 1").orderBy(*order).limit(sample)
              .union(known.where("toxic = 0").orderBy(*order).limit(sample)))
    # at most 2 * sample rows of two numbers
    rows = written(docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").mapInArrow(
        _values, "doc_id long, toxic int, plain boolean, features array<long>, vals array<double>"), "labelled")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return none
    each = rows.select("toxic", F.explode(F.arrays_zip("features", "vals")).alias("f")).select(
        "toxic", F.col("f.features").alias("name"), F.col("f.vals").alias("v"))
    sums = [e for c in (0, 1) for e in (
        F.sum(F.when(F.col("toxic") == c, F.col("v")).otherwise(0.0)).alias(f"s{c}"),
        F.sum(F.when(F.col("toxic") == c, F.col("v") * F.col("v")).otherwise(0.0)).alias(f"q{c}"))]
    mean, var = [F.col(f"s{c}") / size[c] for c in (0, 1)], []
    for c in (0, 1):
        var.append((F.col(f"q{c}") / size[c] - mean[c] * mean[c] + 1e-6) / size[c])
    top = (each.groupBy("name").agg(F.count("*").alias("n"), *sums).where(F.col("n") >= LEAST_TEXTS)
           .withColumn("t", F.round(F.abs(mean[1] - mean[0]) / F.sqrt(var[0] + var[1]), 9))
           .orderBy(F.desc("t"), "name").limit(n_features).select("name").collect())
    names = np.sort(np.array([r["name"] for r in top], np.int64).astype(np.uint64))
    if not len(names):
        return none
    table = np.int64(names.astype(np.int64)).tolist()
    kept = rows.select("doc_id", "toxic", "plain", F.filter(F.arrays_zip("features", "vals"),
                       lambda f: f["features"].isin(table)).alias("f")).orderBy("doc_id").collect()
    x = np.zeros((len(kept), len(names)), np.float32)
    for i, r in enumerate(kept):
        for f in r["f"]:
            x[i, np.searchsorted(names, np.uint64(f["features"] & 0xFFFFFFFFFFFFFFFF))] = f["vals"]
    toxic = np.array([r["toxic"] for r in kept])
    plain = np.array([r["plain"] for r in kept])
    targets = np.stack([toxic * plain, toxic * ~plain, toxic], axis=1).astype(float)
    weight = np.where(toxic == 1, total[1] / size[1], total[0] / size[0])
    ids = np.array([r["doc_id"] for r in kept], np.int64).astype(np.uint64)
    return fit_chain(names, x, targets, weight, (mix(ids) % U(FOLDS)).astype(int))


def probabilities(column, chain: Chain) -> np.ndarray:
    """(texts, categories) of a string column without nulls."""
    taken = np.bincount((chain.names & U(0xFFFF)).astype(np.int64), minlength=1 << 16) > 0
    data, offsets = utf8(column)
    parts = []
    for text, feature, n, _ in features(data, offsets):
        maybe = taken[(feature & U(0xFFFF)).astype(np.int64)]
        text, feature = text[maybe], feature[maybe]
        if len(chain.names):
            at = np.minimum(np.searchsorted(chain.names, feature), len(chain.names) - 1)
            real = chain.names[at] == feature
            text, feature = text[real], feature[real]
        text, feature, value = counted(text, feature, n)
        x = np.zeros((len(n), len(chain.names)))
        x[text, np.searchsorted(chain.names, feature)] = value
        parts.append(chain.scores(x))
    return np.concatenate(parts) if parts else np.zeros((0, len(CATEGORIES)))


def _scored(batches, chain: Chain, threshold: float):
    for batch in batches:
        p = probabilities(batch.column(1), chain)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(p[:, c], pa.float64()) for c in range(len(CATEGORIES))),
             pa.array(p[:, -1] >= threshold, pa.bool_())],
            names=["doc_id", "p_explicit", "p_coded", "p_toxic", "toxic"])


def _accepted(batches, chain: Chain, threshold: float, text: int):
    for batch in batches:
        p = probabilities(batch.column(text).fill_null(""), chain)
        yield batch.filter(pa.array(p[:, -1] < threshold, pa.bool_()))


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the categories' probabilities, and whether the text is toxic."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(partial(_scored, chain=chain, threshold=threshold), SCHEMA)


def accepted(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text is not toxic."""
    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(partial(_accepted, chain=chain, threshold=threshold, text=docs.columns.index("text")),
                           docs.schema)
