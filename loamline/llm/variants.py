"""Spelling variants: words one edit apart, grouped under their commonest form.

Every whole text is cut into runs of Latin letters; the distinct words with
``LEAST_LETTERS`` code points and ``LEAST_COUNT`` occurrences or more are the
vocabulary. Two words are near if one inserted, deleted or replaced code point
turns one into the other.

Near words meet by what the edit leaves alone. The place of the edit in the
shorter word lies in a region [lo, hi) of it, at first its left or its right
half; all words with the same letters before and after the region form a group.
A group of more than ``GROUP_ROWS`` words is dealt anew by the halves of its
region, until the region is one letter, when few words can share a group. So
no group grows with the vocabulary, and no pair is lost.

Inside a group the method is dynamic programming along the sorted list: words
sorted by spelling (backwards, where the group's common letters are at the
end) form ranges that share a prefix, found from the longest common prefixes
(LCPs) of neighbours. A query word keeps, for each range it still follows, the
row of the edit matrix for the shared prefix, banded to the three cells that
one edit can reach. The row is computed once and reused by every word of the
range; ranges whose row exceeds one edit everywhere are skipped whole. All
queries of a block move down one letter at a time, as array operations.

A pair counts in one group only, that of its first differing letter, so a
group sends on one row per word: how many near words, and the commonest. A
word's form is its near word with the largest count (ties: the smallest in
code-point order) where that count is twice its own or more; forms are
followed to their end by pointer jumping, at most log2 of the largest count
of steps long.

A null text has no words; a null doc_id reads as empty in the hash that picks
the runs to damage. Repeated rows count again. Very long runs are words like
others. An empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, texts, whole_groups, written

RUN = re.compile("[a-zÀ-ÿ]+")
DAMAGED = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
FORM_RATIO = 2
GROUP_ROWS = 4096
QUERY_ROWS = 1 << 13
CELLS = 1 << 23  # letters of the words that are held as one matrix


def damaged(doc_id: int | None, run: str) -> str:
    """The run, without one of its letters for one document in ``DAMAGED``."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % DAMAGED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _counted(batches):
    for batch in batches:
        total: Counter = Counter()
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            start = zlib.crc32(f"{'' if i is None else i}:".encode())
            # bytes.lower() changes A-Z only
            for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                if not zlib.crc32(run.encode(), start) % DAMAGED:
                    run = damaged(i, run)
                if len(run) >= LEAST_LETTERS:
                    total[run] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of every word that counts."""
    bounded_batches(docs.sparkSession)
    counted = texts(docs).mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def regions(words: DataFrame) -> DataFrame:
    """Each word as the shorter and as the longer one of a pair, with the whole
    word as the region of the edit."""
    length = F.char_length("word")
    sides = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("shorter"))
    return sides.where(F.col("shorter") >= LEAST_LETTERS).select(
        "word", "n", "shorter", F.lit(0).alias("lo"), F.col("shorter").alias("hi"))


def halves(rows: DataFrame) -> DataFrame:
    """Each row once per half of its region [lo, hi) in words of ``shorter``
    letters, with the key of the letters around it; ``backwards``: ``spelled`` is
    the word from its end."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    cut = rows.select("word", "n", "shorter", F.explode(F.array(
        F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi")))).alias("x"))
    cut = cut.select("word", "n", "shorter", "x.lo", "x.hi")
    before = F.substr("word", F.lit(1), F.col("lo"))
    after = F.right(F.col("word"), F.col("shorter") - F.col("hi"))
    backwards = F.col("lo") < F.col("shorter") - F.col("hi")
    return cut.select(
        F.xxhash64("shorter", "lo", "hi", before, after).alias("key"), "shorter", "lo", "hi", backwards.alias("backwards"),
        F.when(backwards, F.reverse("word")).otherwise(F.col("word")).alias("spelled"), "n")


def grouped(words: DataFrame) -> DataFrame:
    """Rows of groups that hold every near pair, each group of a bounded size."""
    rows, done = halves(regions(words)), None
    while True:
        rows = written(rows, "groups")
        sizes = rows.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.col("hi") - F.col("lo")).alias("open"))
        hot = sizes.where((F.col("rows") > GROUP_ROWS) & (F.col("open") > 1)).select("key")
        if not hot.limit(1).count():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(hot, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        word = F.when(F.col("backwards"), F.reverse("spelled")).otherwise(F.col("spelled"))
        rows = halves(rows.join(hot, "key", "left_semi").withColumn("word", word))


def letters(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, one row each, zeros beyond their ends."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    size = np.array([len(w) for w in words])
    out = np.zeros((len(words), width), np.uint32)
    out[np.repeat(np.arange(len(words)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def within_one(chars: np.ndarray, size: np.ndarray, group: np.ndarray, shorter: int, start: int):
    """(query, word) index pairs exactly one edit apart inside a group; queries
    are the words of length ``shorter``. Rows are sorted by group and letters;
    the words of a group share their first ``start`` letters."""
    m, width = chars.shape
    differs = chars[1:] != chars[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    lcp = np.concatenate([[-1], np.where(group[1:] != group[:-1], -1, lcp)])  # -1: a new group
    padded = np.concatenate([chars, np.zeros((m, 2), chars.dtype)], axis=1)
    first = np.flatnonzero(lcp < start)
    end = np.append(first[1:], m)
    queries = np.flatnonzero(size == shorter)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k in range(0, len(queries), QUERY_ROWS):
        q = queries[k:k + QUERY_ROWS]
        at = np.searchsorted(first, q, "right") - 1
        lo, hi = first[at], end[at]
        one = np.ones(len(q), np.int8)
        # cells one letter before, at and after the diagonal, of the row for ``start`` letters
        row = [one if start else 2 * one, 0 * one, one]
        for d in range(start, width):
            # ranges of words that share d + 1 letters; those that end after d letters are left behind
            bound = np.flatnonzero(lcp <= d)
            a, b = np.searchsorted(bound, lo), np.searchsorted(bound, hi)
            parent = np.repeat(np.arange(len(q)), b - a)
            child = np.arange(len(parent)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
            lo = bound[child]
            hi = np.append(bound[1:], m)[child]
            longer = size[lo] > d
            parent, lo, hi = parent[longer], lo[longer], hi[longer]
            q, letter = q[parent], padded[lo, d]
            before, on, after = (cell[parent] for cell in row)
            new = [np.minimum(before + (padded[q, max(d - 1, 0)] != letter), on + 1)]
            new.append(np.minimum(np.minimum(on + (padded[q, d] != letter), after + 1), new[0] + 1))
            new.append(np.minimum(after + (padded[q, d + 1] != letter), new[1] + 1))
            row = [np.minimum(x, 2).astype(np.int8) for x in new]
            if d + 1 in (shorter, shorter + 1):  # words that end here: the cell of the query's last letter
                hit = (size[lo] == d + 1) & (row[1 if d + 1 == shorter else 0] == 1)
                found.append((q[hit], lo[hit]))
            alive = (row[0] < 2) | (row[1] < 2) | (row[2] < 2)
            q, lo, hi, row = q[alive], lo[alive], hi[alive], [x[alive] for x in row]
            if not len(q):
                break
    return tuple(np.concatenate(x) for x in zip(*found))


def neighbours(words: list[str], n: np.ndarray, group: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               backwards: np.ndarray, spelled: list[str], shorter: int):
    """(word, near words, count of the commonest, the commonest) of the words
    that have a near word whose edit lies in their group's region."""
    size = np.array([len(w) for w in words])
    open_from = int(np.where(backwards, shorter - hi, lo).min())
    x, y = within_one(letters(spelled, shorter + 1), size, group, shorter, open_from)
    plain = letters(words, shorter + 1)
    differs = plain[x] != plain[y]
    place = np.where(differs.any(axis=1), differs.argmax(axis=1), shorter)
    own = (place >= lo[x]) & ((place < hi[x]) | ((place == shorter) & (hi[x] == shorter)))
    x, y = x[own], y[own]
    back = size[y] > shorter  # queries are the shorter words only
    x, y = np.concatenate([x, y[back]]), np.concatenate([y, x[back]])
    if not len(x):
        return [], [], [], []
    some, where = np.unique(y, return_inverse=True)
    order = np.argsort(np.array([words[i] for i in some.tolist()], dtype=object), kind="stable")
    rank = np.empty(len(some), np.int64)
    rank[order] = np.arange(len(some))
    best = np.lexsort((rank[where], -n[y], x))
    x, y = x[best], y[best]
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    count = np.diff(np.append(first, len(x)))
    return ([words[i] for i in x[first].tolist()], count.tolist(), n[y[first]].tolist(),
            [words[i] for i in y[first].tolist()])


def _near(batches):
    for table in whole_groups(batches, "key"):
        shorter = table.column("shorter").to_numpy()
        key = table.column("key").to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for length in np.unique(shorter).tolist():
            # whole groups of one length, as many as fit in one matrix
            mine = edge[shorter[edge] == length]
            ends = np.append(edge[1:], len(key))[shorter[edge] == length]
            total, k = np.cumsum(ends - mine), 0
            while k < len(mine):
                room = (total[k - 1] if k else 0) + CELLS // (length + 1)
                last = max(k + 1, int(np.searchsorted(total, room, "right")))
                rows = np.concatenate([np.arange(a, b) for a, b in zip(mine[k:last], ends[k:last])])
                part = table.take(pa.array(rows))
                spelled = part.column("spelled").to_pylist()
                backwards = part.column("backwards").to_numpy()
                words = [s[::-1] if r else s for s, r in zip(spelled, backwards.tolist())]
                out = neighbours(words, *(part.column(c).to_numpy() for c in ("n", "key", "lo", "hi")),
                                 backwards, spelled, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["word", "near", "best_n", "best"])
                k = last


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near ones."""
    rows = grouped(words).repartition("key").sortWithinPartitions("key", "spelled")
    found = rows.mapInArrow(_near, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``form`` from each word (word, form) ends."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("via"), F.col("root").alias("next"))
        now = written(now.join(step, now["root"] == step["via"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """word, n, form, root, form_n, n_near of every word of the vocabulary."""
    words = written(vocabulary(docs), "vocabulary")
    near = near_words(words)
    good = F.col("best_n") >= FORM_RATIO * F.col("n")
    rows = written(words.join(near, "word", "left").select(
        "word", "n", F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")), "forms")
    ends = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
