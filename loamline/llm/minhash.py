"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct 5-word shingles (lower-cased A-Z). Two
permutations make the whole signature: the first scrambles the shingles, the
second, shifted circularly by k, gives coordinate k. ``ROWS`` coordinates
form a band; two sets at the similarity threshold miss all bands with
probability (1 - 0.75 ** ROWS) ** BANDS, about 3e-7.

Documents with equal sets form a class with a number of its own; doc_ids only
name the rows and the reported components, so null or repeated ids join
nothing. Links are confirmed on whole sets, never on signatures:

1. each class with the smallest one it shares a band with,
2. other such pairs that are still in different components,
3. in bands that still hold several components, those outside the band's
   largest with one member of it, another in each of HUB_ROUNDS rounds,
4. in bands that hold several components even then, every pair across them.
   A band is cut into cells: a block of the rows outside its largest component
   against a block of all its rows. First the sketches of a cell are compared
   in place, and rows that may have a link there stay; then their whole sets
   meet in the cell, and only links that join two components not joined in
   this cell yet leave it. So a cell emits fewer rows than it reads, whatever
   the number of pairs.

Pairs inside a component need no check, so no group of copies is expanded
into all pairs. Two sets whose full signatures agree in less than ``SKETCH``
of the coordinates are not checked in step 4: at the threshold that is 5
standard deviations below the mean (``tests/llm`` measures it).

A null or empty text has an empty set, linked with nothing; a text of fewer
than five words has one shingle. Equal rows belong to one class; ties do not
occur, as component ids are minima. A null doc_id counts as larger than all
others, and a component of null ids only has a null id; ``kept`` is true where
the row's doc_id is the component's, null included. Extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .sequences import U, gram, mix, utf8, word_values, words
from .tables import batches_of, bounded_batches, joined_by_size, texts, whole_groups, written

SHINGLE = 5
BANDS, ROWS = 56, 5
SKETCH = 0.62
HUB_ROUNDS = 2
CELL_ROWS = 512
CELL_SHINGLES = 1 << 20
PERCENT = 75
NO_ID = np.iinfo(np.int64).max
SIGNED = "doc long, h long, n long, f1 long, f2 long, bands array<long>, sketch binary"
CELL = "cell long, side int, id long, n long, label long"
PAIRS = 1 << 14  # compared at once
VOCABULARY = 4096
BATCH = 4 << 20  # bytes of an Arrow batch; hashes of words and shingles take ten times that in a task


def shingle_sets(column) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(column)
    start, end, at = words(data, offsets)
    values = word_values(data, start, end, lower=True)
    grams = gram(values, SHINGLE) if len(values) else values
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        else:  # the whole sequence, if there is one
            whole = np.full(1 if b > a else 0, b - a, np.uint64)
            for v in values[a:b]:
                whole = mix(whole * U(0x9E3779B97F4A7C15) + v)
            out.append(whole)
    return out


def second_permutation(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int = BANDS * ROWS, step: int = 2048) -> np.ndarray:
    """``size`` minima: of the second permutation shifted by 0, 1, 2, ... places."""
    first = (mix(shingles ^ U(0x5851F42D4C957F2D)) >> U(32)).astype(np.uint32)
    shift = np.arange(size, dtype=np.uint32)[:, None]
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(first), step):
        out = np.minimum(out, second_permutation(first[None, i:i + step] - shift).min(axis=1))
    return out


def _signed(batches):
    for batch in batches:
        n, f1, f2, bands, sketch = [], [], [], [], []
        for s in shingle_sets(batch.column("text")):
            n.append(len(s))
            f1.append(int(mix(s + U(1)).sum(dtype=np.uint64).astype(np.int64)))
            f2.append(int(mix(s * U(0xA0761D6478BD642F)).sum(dtype=np.uint64).astype(np.int64)))
            if not len(s):
                bands.append([])
                sketch.append(b"")
                continue
            found = signature(s)
            key = np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                key = mix(key * U(0x9E3779B97F4A7C15) + found[r::ROWS])
            bands.append(key.astype(np.int64))
            sketch.append(found.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("h"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
             pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
            names=["doc", "h", "n", "f1", "f2", "bands", "sketch"])


def _sets(batches):
    for batch in batches:
        sets = [s.tobytes() for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], names=["id", "shingles"])


def _alike(batches):
    """Pairs whose sketches agree often enough to be checked."""
    for batch in batches:
        keep = [np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) >= SKETCH
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _cells(table: pa.Table):
    """(edges of the cells, place of each cell's first y row) of rows sorted by cell and side."""
    cell, side = table.column("cell").to_numpy(), table.column("side").to_numpy()
    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    return edge, edge[:-1] + np.add.reduceat((side == 0).astype(np.int64), edge[:-1])


def _maybe(batches):
    """Of each cell, the rows that another label's row may link with: similar
    sizes and sketches that agree often enough."""
    for table in whole_groups(batches, "cell"):
        edge, middle = _cells(table)
        n, label = table.column("n").to_numpy(), table.column("label").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        x = np.concatenate([np.arange(a, b) for a, b in zip(edge[:-1], middle)])  # the x rows
        size, first = np.repeat(edge[1:] - middle, middle - edge[:-1]), np.repeat(middle, middle - edge[:-1])
        hit = np.zeros(table.num_rows, bool)
        total, done = np.cumsum(size), 0
        while done < len(x):
            last = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS, "right")))
            count = size[done:last]
            i = np.repeat(x[done:last], count)
            j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[done:last], count)
            near = (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
            i, j = i[near], j[near]
            near = (sketch[i] == sketch[j]).mean(axis=1) >= SKETCH
            hit[i[near]] = hit[j[near]] = True
            done = last
        for batch in table.drop_columns("sketch").filter(pa.array(hit)).to_batches():
            yield batch


def similar(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Which sets of x and y (rows, columns) are similar enough; sets are sorted and distinct."""
    both = np.zeros((len(x), len(y)), np.int64)
    if len(x) * len(y) <= 16:
        for i, a in enumerate(x):
            both[i] = [len(np.intersect1d(a, b, assume_unique=True)) for b in y]
    else:  # counts of common bits over the shingles that both sides have, some at a time
        vocabulary = np.intersect1d(np.concatenate(x), np.concatenate(y))
        found = []
        for sets in (x, y):
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            flat = np.concatenate(sets)
            at = np.searchsorted(vocabulary, flat)
            known = np.zeros(len(flat), bool)
            known[at < len(vocabulary)] = vocabulary[at[at < len(vocabulary)]] == flat[at < len(vocabulary)]
            found.append((row[known], at[known], len(sets)))
        for lo in range(0, len(vocabulary), VOCABULARY):
            part = []
            for row, at, size in found:
                some = (at >= lo) & (at < lo + VOCABULARY)
                has = np.zeros((size, VOCABULARY), bool)
                has[row[some], at[some] - lo] = True
                part.append(np.packbits(has, axis=1).view(np.uint64))
            for i, bits in enumerate(part[0]):
                both[i] += np.bitwise_count(part[1] & bits).sum(axis=1, dtype=np.int64)
    total = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])
    return 100 * both >= PERCENT * (total - both)


def _joining(batches):
    """Of each cell, links of labels that join what the cell's earlier links did not."""
    for table in whole_groups(batches, "cell"):
        edge, middle = _cells(table)
        label = table.column("label").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        a, b = [], []
        for lo, mid, hi in zip(edge[:-1].tolist(), middle.tolist(), edge[1:].tolist()):
            if lo == mid or mid == hi:
                continue
            i, j = np.nonzero(similar(sets[lo:mid], sets[mid:hi]) & (label[lo:mid, None] != label[mid:hi]))
            root: dict[int, int] = {}

            def top(k):
                while root.setdefault(k, k) != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for x, y in np.unique(np.stack([label[lo + i], label[mid + j]]), axis=1).T.tolist():
                p, q = top(x), top(y)
                if p != q:
                    root[p] = q
                    a.append(x)
                    b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _confirmed(batches):
    """Pairs whose whole sets are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a hash of the text; a row is known by doc and h together."""
    return texts(docs).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("h"), "text")


class Search:
    """The tables of one search; ``id`` is the number of a class of equal sets."""

    def __init__(self, docs: DataFrame):
        docs = _keyed(docs)
        self.signed = written(docs.mapInArrow(_signed, SIGNED), "signed")
        key = F.struct(F.coalesce("doc", F.lit(NO_ID)).alias("doc"), "h", "bands", "sketch")
        one = self.signed.where("n > 0").groupBy("f1", "f2", "n").agg(
            F.min("doc").alias("least"), F.count("*").alias("size"), F.min(key).alias("x"))
        # numbered once and read back: a partition's numbers do not depend on its rows' order
        self.classes = written(one.select(
            F.monotonically_increasing_id().alias("id"), "f1", "f2", "n", "least", "size", "x.*"), "classes")
        banded = self.classes.select("id", "n", F.explode("bands").alias("band"))
        shared = banded.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1")
        self.shared = written(banded.join(shared, "band").select("band", "id", "n", "hub"), "shared")
        ids = self.shared.select("id").distinct()
        self.sketches = written(self.classes.select("id", "n", "sketch").join(ids, "id", "left_semi"), "sketches")
        of = written(self.classes.select("id", F.col("doc").alias("rep"), F.col("h").alias("rep_h")).join(
            ids, "id", "left_semi"), "representatives")
        key = F.coalesce("doc", F.lit(NO_ID))
        # representatives grow with the input: shuffled at every size, not broadcast while they are few
        chosen = docs.join(of.hint("merge"), (key == F.col("rep")) & (F.col("h") == F.col("rep_h"))).select("id", "text")
        # rows that repeat both id and text would give the set of their class several times
        again = self.signed.where("n > 0").groupBy(key.alias("rep"), F.col("h").alias("rep_h")).count().where("count > 1")
        again = written(again.join(of, ["rep", "rep_h"]).select("id"), "repeated")
        sets = lambda rows: rows.mapInArrow(_sets, "id long, shingles binary")
        self.sets = written(sets(chosen.join(again, "id", "left_anti")).unionByName(
            sets(chosen.join(again, "id", "left_semi").dropDuplicates(["id"]))), "sets")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs a < b of similar size whose sketches agree."""
        x = self.sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        y = self.sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        near = (pairs.distinct().join(x, "a").join(y, "b")
                .where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)"))
        return near.select("a", "b", "sa", "sb").mapInArrow(_alike, "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        x = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        y = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "sa", "sb").mapInArrow(_confirmed, "a long, b long")

    def across(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs whose ends are in different components, with their labels."""
        x = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
        y = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
        return (pairs.join(x, "a", "left").join(y, "b", "left")
                .where("coalesce(la, a) != coalesce(lb, b)").select("a", "b"))

    def labelled(self, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
        """Members of shared bands with their labels; and for each band that holds
        several labels its most frequent one with a member (by ``turn``), and the
        rows and shingles of the whole band and of the other labels."""
        found = (self.shared.join(labels, "id", "left")
                 .select("band", "id", "n", F.coalesce("label", "id").alias("label")))
        each = found.groupBy("band", "label").agg(
            F.count("*").alias("size"), F.sum("n").alias("shingles"),
            F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id")).alias("hub"))
        main = each.groupBy("band").agg(
            F.max(F.struct("size", "label", "hub", "shingles")).alias("top"), F.count("*").alias("labels"),
            F.sum("size").alias("rows"), F.sum("shingles").alias("shingles")).where("labels > 1")
        return found, main.select(
            "band", F.col("top.label").alias("main"), F.col("top.hub.id").alias("hub"), "rows", "shingles",
            (F.col("rows") - F.col("top.size")).alias("other_rows"),
            (F.col("shingles") - F.col("top.shingles")).alias("other_shingles"))

    def cells(self, labels: DataFrame) -> DataFrame:
        """Rows of the cells of bands that hold several labels, with their sketches."""
        found, main = self.labelled(labels, HUB_ROUNDS)
        blocks = lambda rows, shingles: F.greatest(
            F.ceil(F.col(rows) / CELL_ROWS), F.ceil(F.col(shingles) / CELL_SHINGLES)).cast("int")
        main = main.select("band", "main", blocks("other_rows", "other_shingles").alias("xs"),
                           blocks("rows", "shingles").alias("ys"))
        members = found.join(main, "band").join(self.sketches.select("id", "sketch"), "id")
        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = lambda side: (F.xxhash64("band", "i", "j").alias("cell"), F.lit(side).alias("side"),
                                "id", "n", "label", "sketch")
        x = members.where("label != main").withColumn("i", own("xs")).withColumn("j", each("ys")).select(*columns(0))
        y = members.withColumn("j", own("ys")).withColumn("i", each("xs")).select(*columns(1))
        return x.unionByName(y)

    def joining(self, labels: DataFrame) -> DataFrame:
        """Links (a, b) of labels that join all components some pair of a band links."""
        near = written(self.cells(labels).repartition("cell").sortWithinPartitions("cell", "side")
                       .mapInArrow(_maybe, CELL), "cells")
        whole = near.join(self.sets, "id").repartition("cell").sortWithinPartitions("cell", "side")
        links = whole.select("cell", "side", "label", "shingles").mapInArrow(_joining, "a long, b long")
        return written(links.distinct(), "links")

    def run(self) -> DataFrame:
        """(id, label) of every representative that is linked with another."""
        star = written(self.alike(self.shared.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))), "pairs")
        links = written(self.confirmed(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")), "links")
        labels = components(links)
        links = written(links.union(self.confirmed(self.across(star, labels))), "links")
        labels = components(links)
        for turn in range(HUB_ROUNDS):
            found, main = self.labelled(labels, turn)
            pairs = found.drop("hub").join(main, "band").where("label != main").select(
                F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
            more = written(self.confirmed(self.alike(pairs)), "links")
            if not more.limit(1).count():
                break
            links = written(links.union(more), "links")
            labels = components(links)
        more = self.joining(labels)
        if not more.limit(1).count():
            return labels
        return components(links.union(more))

    def rows(self) -> DataFrame:
        """doc, h, n, label, component of each row; label and component are null without words."""
        classes = self.classes.join(self.run(), "id", "left").select(
            "id", "f1", "f2", "n", "least", "size", F.coalesce("label", "id").alias("label"))
        groups = classes.groupBy("label").agg(F.min("least").alias("component"), F.count("*").alias("members"))
        known = joined_by_size(classes, groups, ["label"], "members", self.classes.count())
        known = known.select("f1", "f2", "n", "label", "component", "size")
        signed = self.signed.select("doc", "h", "n", "f1", "f2")
        some = joined_by_size(signed.where("n > 0"), known, ["f1", "f2", "n"], "size", self.signed.count())
        none = signed.where("n = 0").withColumns({c: F.lit(None).cast("long") for c in ("label", "component")})
        columns = ("doc", "h", "n", "label", "component")
        return some.select(*columns).unionByName(none.select(*columns))


def searched(docs: DataFrame) -> DataFrame:
    """``Search.rows`` of the documents. All Python work is done when it returns."""
    bounded_batches(docs.sparkSession)
    with batches_of(docs.sparkSession, BATCH):
        return Search(docs).rows()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc"))
    return searched(docs).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of each component: that of
    the smallest doc_id (a null one only where all are), of rows that repeat this
    id that of the smallest hash of the text, one of equal ones. Rows without
    words all stay."""
    rows = written(searched(docs).where("n > 0").select("doc", "h", "label"), "components")
    each = rows.groupBy("label", "doc", "h").agg(F.count("*").alias("copies"))
    first = each.groupBy("label").agg(
        F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "h", "copies")).alias("x"),
        F.count("*").alias("members"))
    first = first.select("label", F.struct("x.doc", "x.h").alias("first"), "members")
    marked = joined_by_size(each, first, ["label"], "members", rows.count())
    named = docs.withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = lambda right: named["doc_id"].cast("long").eqNullSafe(right["doc"]) & (named["_h"] == right["h"])
    marked = marked.withColumn("stays", F.struct("doc", "h").eqNullSafe(F.col("first")))
    keys = written(marked.select("doc", "h", "copies", "stays"), "keys")
    gone, again = keys.where("not stays"), keys.where("stays and copies > 1")
    named = named.join(gone, same(gone), "left_anti")
    once = named.join(again, same(again), "left_anti")
    repeated = named.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "_h"])
    return once.unionByName(repeated).drop("_h")
