"""Quality rules by robust multivariate outliers (DataFrame functions only).

Counts are taken from every whole text. Texts of fewer than ``LEAST_WORDS``
words, or with more than 30 % of their words in repeated 8-word windows, fail
the base rule. The others' transformed statistics are judged per language and
source: minimum-covariance-determinant estimates of centre and scatter, then
rejection by Mahalanobis distance.

The estimates start from medians and quartiles and take ``STEPS``
concentration steps: mean and covariance of the share ``H`` of a group's rows
with the smallest distances, then new distances. The share's limit comes from
a histogram of distances on a fixed logarithmic grid, so it does not depend
on how rows are dealt, and a group of any size is aggregated before it is
shuffled. Covariances are scaled to be consistent for normal data and get
``FLOOR`` squared added on the diagonal, because most texts have no symbols or
repeats at all and a variance of zero would reject the first that has one.
The statistics are scaled so that each alone can pass the cut-off: where most
texts have none, half of four or more lines being duplicates, or a quarter of
250 or more words in repeated windows, is enough; one repeated line of a short
text is not (two lines and 40 words are added to the shares' divisors, so under
about 100 words repeats alone are left to the base rule).
Groups of fewer than ``LEAST_ROWS`` rows are pooled by language; what is left in
small pools, of all languages, is judged as one last group, however small, so
every row that passes the base rule is judged by the method.

A null text has no words and fails the base rule; null languages and sources
are groups of their own. Repeated rows are judged alike. Extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
STATS = ("word_length", "symbols", "dup_lines", "repeats")
H, STEPS = 0.75, 3
FLOOR = 0.5
LEAST_ROWS = 100
REST = 0
CUTOFF = 60.0  # far beyond chi-squared of 4 degrees of freedom: ordinary texts with a repeated line stay
GRID = 20.0
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def window_hashes(words: Column) -> Column:
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) > WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))))


def repeated_words(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s):
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        j = F.transform(s, lambda x, k: F.when(
            F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)), x["i"]))
        return F.array_sort(F.filter(j, lambda x: x.isNotNull()))

    def covered(positions):
        zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(positions, zero, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, covered(let(pairs, starts))).otherwise(0)


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].alias("lang"),
                       docs["source"].alias("source"), text.alias("text"))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.char_length(without(F.col("text"), BLANKS)).alias("word_chars"),
        (F.octet_length("text") - F.octet_length(without(F.col("text"), SYMBOLS))).alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "").alias("lines"),
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
    rows = rows.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("words").alias("n_words"), window_hashes(F.col("words")).alias("windows"))
    found = F.coalesce(repeated_words(F.col("windows")), F.lit(0))
    whole = [F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    return rows.select("doc_id", "lang", "source", *whole, found.cast("long").alias("n_repeat_words"), "n_lines")


def transformed(rows: DataFrame) -> DataFrame:
    """The base verdict and the statistics that are judged."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    share = lambda a, b: F.log1p(100 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return rows.withColumns({
        "base_failed": failed,
        "word_length": 4 * F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))),
        "symbols": 2 * share("n_symbols", "word_chars"),
        "dup_lines": 12 * F.col("n_dup_lines") / (F.col("n_lines") + 2),
        "repeats": 18 * F.col("n_repeat_words") / (F.col("n_words") + 40)})


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with the key of their group: language and source, or the language's
    pool of small groups, or ``REST``, the pool of small pools."""
    one = lambda *c: F.xxhash64(*c, *(F.col(x).isNull() for x in c))
    rows = rows.withColumn("own", one("lang", "source")).withColumn("pool", one("lang"))
    size = (rows.where(~F.col("base_failed")).groupBy("own").agg(F.count("*").alias("size"), F.first("pool").alias("p"))
            .withColumn("small", F.col("size") < LEAST_ROWS))
    pools = size.where("small").groupBy("p").agg(F.sum("size").alias("pool_size"))
    groups = size.join(pools, "p", "left").select("own", F.when(~F.col("small"), F.col("own")).when(
        F.col("pool_size") >= LEAST_ROWS, F.col("p")).otherwise(F.lit(REST)).alias("key"))
    return rows.join(groups, "own", "left").drop("own", "pool")


def quantiles(rows: DataFrame, cell: Column, by: list[str], **shares: float) -> DataFrame:
    """For each group the smallest cell that reaches each share of its rows."""
    cells = rows.groupBy(*by, cell.alias("cell")).agg(F.count("*").alias("n"))
    group = Window.partitionBy(*by)
    reached = cells.withColumn("share", F.sum("n").over(group.orderBy("cell")) / F.sum("n").over(group))
    return reached.groupBy(*by).agg(*(
        F.min(F.when(F.col("share") >= q, F.col("cell"))).alias(name) for name, q in shares.items()))


def distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` from the columns of the Cholesky factor."""
    solved: dict[int, Column] = {}
    for i, s in enumerate(STATS):
        y = F.col(s) - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
        solved[i] = F.col(f"y{i}")
    total = sum((y * y for y in solved.values()), F.lit(0.0))
    return rows.withColumn("d2", total).drop(*(f"y{i}" for i in solved))


def factored(estimates: DataFrame, scale: float) -> DataFrame:
    """Means and the Cholesky factor of the scaled covariance plus the floor."""
    p = range(len(STATS))
    for i in p:
        for j in range(i + 1):
            a = (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * scale + (FLOOR ** 2 if i == j else 0.0)
            for k in range(j):
                a = a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            a = F.sqrt(F.greatest(a, F.lit(1e-9))) if i == j else a / F.col(f"l{j}{j}")
            estimates = estimates.withColumn(f"l{i}{j}", a)
    return estimates.select("key", *(f"m{i}" for i in p), *(f"l{i}{j}" for i in p for j in range(i + 1)))


def consistency(h: float) -> float:
    """h / P(chi2 of p + 2 <= the h-quantile of chi2 of p) for the four statistics."""
    below = lambda x: 1 - math.exp(-x / 2) * (1 + x / 2)
    lo, hi = 0.0, 100.0
    while hi - lo > 1e-9:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < h else (lo, mid)
    return h / (1 - math.exp(-lo / 2) * (1 + lo / 2 + lo * lo / 8))


def estimated(rows: DataFrame) -> DataFrame:
    """Robust centre and Cholesky factor of each group."""
    p = range(len(STATS))
    rows = rows.where(~F.col("base_failed")).select("key", *STATS)
    start = rows
    stacked = rows.select("key", F.explode(F.array(*(
        F.struct(F.lit(i).alias("i"), F.col(s).alias("v")) for i, s in enumerate(STATS)))).alias("x"))
    q = quantiles(stacked.select("key", F.col("x.i").alias("i"), F.col("x.v").alias("v")),
                  F.floor(F.col("v") * GRID), ["key", "i"], low=0.25, mid=0.5, high=0.75)
    pick = lambda i, e: F.max(F.when(F.col("i") == i, e))
    width = ((F.col("high") - F.col("low")) / GRID / 1.349)
    now = q.groupBy("key").agg(
        *(pick(i, (F.col("mid") + 0.5) / GRID).alias(f"m{i}") for i in p),
        *(pick(i, F.sqrt(width * width + FLOOR ** 2)).alias(f"l{i}{i}") for i in p))
    now = now.select("*", *(F.lit(0.0).alias(f"l{i}{j}") for i in p for j in range(i)))
    scale = consistency(H)
    for _ in range(STEPS):
        now = written(now, "estimates")
        near = distance(start.join(now, "key")).withColumn("cell", F.floor(F.log1p("d2") * GRID))
        limit = quantiles(near, F.col("cell"), ["key"], top=H)
        core = near.join(limit, "key").where("cell <= top")
        now = factored(core.groupBy("key").agg(
            *(F.avg(s).alias(f"m{i}") for i, s in enumerate(STATS)),
            *(F.avg(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}{j}") for i in p for j in range(i + 1))), scale)
    return written(now, "estimates")


def quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the squared distance (null: not judged)."""
    rows = written(keyed(transformed(written(counts(docs), "counts"))), "statistics")
    judged = distance(rows.join(estimated(rows), "key", "left"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"), F.round("d2", 6).alias("distance"))
