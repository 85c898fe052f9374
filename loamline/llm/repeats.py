"""First occurrences of all windows of W tokens in a corpus, as Spark jobs.

Every window has an anchor: the leftmost k-gram with the smallest hash in it.
Equal windows have equal anchors at equal places, so only occurrences of one
anchor need comparing. Consecutive windows with one anchor form a *run*
(tokens ``lo`` to ``hi + W``), about one per (W - k) / 2 tokens.

1. ``anchored``: each task finds the runs of the texts it reads and keeps, of
   runs with the same content, the first (the rest repeat it: their span is
   removed). All runs of an anchor share its hash, so contents are equal when
   two independent 64-bit hashes of the whole run are. This keeps groups of copies, however large, to one row a task.
2. ``sifted``: runs meet by anchor. Of equal runs all but the first are
   removed. An anchor with one content only is done; the runs of other anchors
   are *open*: they may agree in some windows. Step 1's shuffle files go then.
3. ``parted``: anchors with more than ``SPLIT`` open runs are *hot*. Their runs
   are cut into pieces by the anchor's place in the window, in ``PARTS`` steps.
   All windows of a piece share nearly a whole window, and pieces are dealt and
   sifted by that as runs are by their anchor; few stay open.
4. ``gathered``: open runs and pieces fetch their tokens from the documents.
5. ``resolve`` (the operator's own method) compares open runs of an anchor
   window by window. Pieces that are hot again are dealt as single windows by
   content instead, collapsed as in step 1.
6. ``applied``: removed spans meet their documents.

Rows between steps are NumPy records packed per bucket; there are
BUCKETS_A_PARTITION buckets for each shuffle partition, so a bucket's size is
set by ``spark.sql.shuffle.partitions`` as that of any shuffle task. Nothing
is broadcast, and one number collected: whether there are hot anchors.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import BYTE_VALUE, U, chunks, mix, power_grams, utf8, window_min, word_values, words
from .tables import bounded_batches, shuffles_removed, texts, written

BUCKETS_A_PARTITION = 2
SPLIT = 2048
PARTS = 4
PIECE = 1 << 20
NO_ID = np.iinfo(np.int64).max  # a null doc_id: after all others
LAST = U(0xFFFFFFFF)
RUN = np.dtype([("h", "<u8"), ("r", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("lo", "<u4"), ("a", "u1"), ("n", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("lo", "<u4"), ("hi", "<u4")])
OPEN = np.dtype([("doc", "<i8"), ("lo", "<u4"), ("a", "u1"), ("n", "u1"), ("hot", "u1"), ("h", "<u8")])
SAME = ("h", "r", "s")  # equal runs: the anchor's hash and both hashes of the content
SECOND = U(0xA24BAED4963EE407)
ROWS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("rows", pa.binary()), ("body", pa.binary())])
ROWS_SQL = "bucket int, kind int, rows binary, body binary"
RUNS, SPANS, OPENS, HOTS = 0, 1, 2, 3


@dataclass(frozen=True)
class Windows:
    """What a window is: ``size`` tokens (words or bytes), anchored by ``k``-grams.
    ``same_doc``: an earlier start in the same document counts, too."""

    size: int
    k: int
    by_word: bool
    same_doc: bool

    def tokens(self, column) -> tuple:
        """(word hashes or None, document offsets, bytes)"""
        data, offsets = utf8(column)
        if not self.by_word:
            return None, offsets, data  # hashed chunk by chunk
        start, end, at = words(data, offsets)
        return word_values(data, start, end), at, data

    def later(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Does each row come after ``first``, its group's first row?"""
        after = rows["doc"] > first["doc"]
        if self.same_doc:
            after |= (rows["doc"] == first["doc"]) & (rows["lo"] > first["lo"])
        return after


def ids_of(column) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    """As ``dealt`` computes it in SQL; ``buckets`` is odd, so ids in steps spread, too."""
    return doc % buckets


def dealt(docs: DataFrame, buckets: int) -> DataFrame:
    return docs.withColumn("bucket", F.pmod(F.coalesce("doc_id", F.lit(NO_ID)), F.lit(buckets)).cast("int"))


def packed(kind: int, rows: np.ndarray, bucket: np.ndarray, body=None) -> pa.RecordBatch:
    """One Arrow row per bucket. ``body``: (offsets, bytes) of each row's tokens."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(rows) else np.zeros(0, int)
    ends = np.append(first[1:], len(rows))
    parts = [rows[a:b].tobytes() for a, b in zip(first, ends)]
    if body is None:
        bodies = [b""] * len(parts)
    else:
        bodies = [b"".join(map(body.__getitem__, order[a:b].tolist())) for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int32()), pa.array([kind] * len(parts), pa.int32()),
         pa.array(parts, pa.binary()), pa.array(bodies, pa.binary())], schema=ROWS)


def unpacked(table, kind: int, dtype: np.dtype) -> np.ndarray:
    kinds = table.column("kind").to_pylist()
    blobs = [b.as_py() for b, k in zip(table.column("rows"), kinds) if k == kind]
    return np.frombuffer(b"".join(blobs), dtype)


def content_of_runs(spec: Windows, wide: np.ndarray, half: int, lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run from its ``half``-grams, four of which cover it."""
    out = mix(wide[lo]) + wide[lo + spec.size - half] * U(3)
    out = mix(out) + wide[hi] * U(5) + mix(wide[hi + spec.size - half] * U(7))
    return mix(out + place)


def runs_of(spec: Windows, values: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The runs of documents whose token hashes lie end to end in ``values``."""
    start = np.arange(len(values), dtype=np.int64)
    doc = np.repeat(np.arange(len(docs)), np.diff(offsets))
    valid = start + spec.size <= offsets[doc + 1]
    if not valid.any():
        return np.zeros(0, RUN)
    half = 1 << (spec.size.bit_length() - 1)
    grams = power_grams(values, half)
    h = grams[spec.k]
    low = window_min((h & ~LAST) | start.astype(np.uint64), spec.size - spec.k + 1)
    start, anchor = start[valid], (low[valid] & LAST).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], len(anchor)) - 1
    lo, hi, anchor = start[first], start[last], anchor[first]
    place = ((hi - lo) * 256 + anchor - lo).astype(np.uint64)
    rows = np.zeros(len(lo), RUN)
    rows["h"], rows["r"] = h[anchor], content_of_runs(spec, grams[half], half, lo, hi, place)
    del grams, h
    rows["s"] = content_of_runs(spec, power_grams(mix(values ^ SECOND), half)[half], half, lo, hi, place)
    rows["doc"], rows["lo"] = docs[doc[lo]], lo - offsets[doc[lo]]
    rows["a"], rows["n"] = anchor - lo, hi - lo
    return rows


def pieces_of(spec: Windows, rows: np.ndarray, values: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Runs, whose token hashes start at ``base`` in ``values``, cut by the
    anchor's place in their windows; ``h`` is the hash of the tokens that all
    windows with the anchor at these places have, so equal windows meet again."""
    step = max(1, (spec.size - spec.k) // PARTS)
    a, n = rows["a"].astype(np.int64), rows["n"].astype(np.int64)
    part = (a - n) // step  # of the last window, where the anchor is leftmost
    times = a // step - part + 1
    which = np.repeat(np.arange(len(rows)), times)
    part = part[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    least, most = part * step, np.minimum(part * step + step - 1, spec.size - spec.k)
    lo, hi = np.maximum(a[which] - most, 0), np.minimum(a[which] - least, n[which])
    out = np.zeros(len(which), RUN)
    out["doc"], out["lo"] = rows["doc"][which], rows["lo"][which] + lo.astype(np.uint32)
    out["a"], out["n"] = a[which] - lo, hi - lo
    place = ((hi - lo) * 256 + a[which] - lo).astype(np.uint64)
    start, anchor = base[which], (base + a)[which]
    half = 1 << (spec.size.bit_length() - 1)
    core = 1 << ((spec.size - step + 1).bit_length() - 1)  # no more than the shared tokens
    grams = power_grams(values, half)
    out["h"] = mix(mix(grams[core][anchor - least] + part.astype(np.uint64)) + grams[core][anchor - most + spec.size - core] * U(3))
    out["r"] = content_of_runs(spec, grams[half], half, start + lo, start + hi, place)
    del grams
    out["s"] = content_of_runs(spec, power_grams(mix(values ^ SECOND), half)[half], half, start + lo, start + hi, place)
    return out


def settled(spec: Windows, rows: np.ndarray, keys: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by ``keys``, document and place; and which repeat their group's first."""
    rows = rows[np.lexsort((rows["lo"], rows["doc"], *(rows[k] for k in reversed(keys))))]
    if not len(rows):
        return rows, np.zeros(0, bool)
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in keys:
        new[1:] |= rows[k][1:] != rows[k][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
    return rows, spec.later(rows, rows[first])


def spans_of(spec: Windows, rows: np.ndarray) -> np.ndarray:
    spans = np.zeros(len(rows), SPAN)
    spans["doc"], spans["lo"] = rows["doc"], rows["lo"]
    spans["hi"] = rows["lo"] + rows["n"] + np.uint32(spec.size)
    return merged(spans)


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans of a document joined."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans["lo"], spans["doc"]))]
    doc = np.concatenate([[0], np.cumsum(spans["doc"][1:] != spans["doc"][:-1])])
    reach = np.maximum.accumulate(spans["hi"].astype(np.int64) + doc * (1 << 33)) - doc * (1 << 33)
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (spans["lo"][1:] > reach[:-1])])
    first = np.flatnonzero(new)
    out = spans[first]
    out["hi"] = reach[np.append(first[1:], len(spans)) - 1]
    return out


def _anchored(batches, spec: Windows, buckets: int):
    for turn, batch in enumerate(batches):
        docs = ids_of(batch.column(0))
        values, offsets, data = spec.tokens(batch.column(1))
        found = []
        for a, b in chunks(offsets, PIECE):
            lo, hi = int(offsets[a]), int(offsets[b])
            for p in range(lo, hi, PIECE):  # more than one for a very long document only
                end = min(hi, p + PIECE + spec.size - 1) if b == a + 1 else hi
                part = values[p:end] if spec.by_word else BYTE_VALUE[data[p:end]]
                at = np.array([0, end - p]) if b == a + 1 else offsets[a:b + 1] - lo
                rows = runs_of(spec, part, at, docs[a:b])
                rows["lo"] += np.uint32(p - lo)
                found.append(rows)
        rows, repeats = settled(spec, np.concatenate(found or [np.zeros(0, RUN)]), SAME)
        kept = rows[~repeats]
        yield packed(RUNS, kept, (kept["h"] % U(buckets)).astype(np.int64))
        spans = spans_of(spec, rows[repeats])
        yield packed(SPANS, spans, doc_bucket(spans["doc"], buckets))


def _sifted(table, spec: Windows, buckets: int):
    """Of one bucket: removed spans and open runs, dealt by document."""
    rows, repeats = settled(spec, unpacked(table, RUNS, RUN), SAME)
    spans = np.concatenate([unpacked(table, SPANS, SPAN), spans_of(spec, rows[repeats])])
    out = [packed(SPANS, spans, doc_bucket(spans["doc"], buckets))]
    rows = rows[~repeats]
    if len(rows):
        new = np.concatenate([[True], rows["h"][1:] != rows["h"][:-1]])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        other = (rows["r"][1:] != rows["r"][:-1]) | (rows["s"][1:] != rows["s"][:-1])
        varied = np.bincount(group[1:], weights=(~new[1:]) & other, minlength=len(size)) > 0
        keep = varied[group]
        open_runs = np.zeros(int(keep.sum()), OPEN)
        for f in ("doc", "lo", "a", "n", "h"):
            open_runs[f] = rows[f][keep]
        open_runs["hot"] = (size > SPLIT)[group][keep]
        for kind, some in ((OPENS, open_runs["hot"] == 0), (HOTS, open_runs["hot"] > 0)):
            out.append(packed(kind, open_runs[some], doc_bucket(open_runs["doc"][some], buckets)))
    return pa.Table.from_batches(out, ROWS)


def doc_slices(doc: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document the range of ``wanted`` (sorted by document) that has its id."""
    return np.searchsorted(wanted, doc, "left"), np.searchsorted(wanted, doc, "right")


def content(spec: Windows, body: list[bytes], step: int = 8192) -> np.ndarray:
    """A 64-bit hash of each window's tokens."""
    weight = mix(np.arange(1, spec.size + 1, dtype=np.uint64)) | U(1)
    out = np.zeros(len(body), np.uint64)
    for i in range(0, len(body), step):
        raw = b"".join(body[i:i + step])
        tokens = np.frombuffer(raw, "<u8") if spec.by_word else BYTE_VALUE[np.frombuffer(raw, np.uint8)]
        out[i:i + step] = mix((mix(tokens.reshape(-1, spec.size)) * weight).sum(axis=1, dtype=np.uint64))
    return out


def placed(docs, rows: np.ndarray, spec: Windows):
    """(open runs of a bucket of documents, where each starts, the documents' tokens)"""
    rows = rows[np.argsort(rows["doc"], kind="stable")]
    ids = ids_of(docs.column("doc_id"))
    values, offsets, data = spec.tokens(docs.column("text"))
    a, b = doc_slices(ids, rows["doc"])
    n = b - a
    which = np.repeat(np.arange(len(ids)), n)
    pick = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
    rows, at = rows[pick], offsets[which] + rows["lo"][pick]
    fits = at + rows["n"] + spec.size <= offsets[which + 1]  # not so in another row of this doc_id
    return rows[fits], at[fits], values if spec.by_word else data


def _parted(docs, table, spec: Windows, buckets: int):
    """Pieces of the hot runs of a bucket of documents, dealt by the tokens they share."""
    rows = unpacked(table, HOTS, OPEN)
    if not len(rows) or not docs.num_rows:
        return ROWS.empty_table()
    rows, at, tokens = placed(docs, rows, spec)
    size = rows["n"].astype(np.int64) + spec.size
    base, found = np.concatenate([[0], np.cumsum(size)]), [np.zeros(0, RUN)]
    for i, j in chunks(base, PIECE):
        first = base[i:j] - base[i]
        part = tokens[np.repeat(at[i:j] - first, size[i:j]) + np.arange(base[j] - base[i])]
        found.append(pieces_of(spec, rows[i:j], part if spec.by_word else BYTE_VALUE[part], first))
    rows, repeats = settled(spec, np.concatenate(found), SAME)
    kept, spans = rows[~repeats], spans_of(spec, rows[repeats])
    return pa.Table.from_batches([packed(RUNS, kept, (kept["h"] % U(buckets)).astype(np.int64)),
                                  packed(SPANS, spans, doc_bucket(spans["doc"], buckets))], ROWS)


def _gathered(docs, table, spec: Windows, buckets: int):
    """Open runs of a bucket of documents with their tokens, dealt by anchor; spans go on."""
    spans = unpacked(table, SPANS, SPAN)
    out = [packed(SPANS, spans, doc_bucket(spans["doc"], buckets))]
    rows = np.concatenate([unpacked(table, OPENS, OPEN), unpacked(table, HOTS, OPEN)])
    if not len(rows) or not docs.num_rows:
        return pa.Table.from_batches(out, ROWS)
    rows, at, tokens = placed(docs, rows, spec)
    hot = rows["hot"] > 0
    if hot.any():  # each window alone
        times = np.where(hot, rows["n"].astype(np.int64) + 1, 1)
        step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        hot = np.repeat(hot, times)
        rows, at = np.repeat(rows, times), np.repeat(at, times) + step
        rows["lo"] += step.astype(np.uint32)
        rows["n"][hot] = 0
    width = 8 if spec.by_word else 1
    raw = tokens.tobytes()
    body = [raw[i * width:(i + n + spec.size) * width] for i, n in zip(at.tolist(), rows["n"].tolist())]
    if hot.any():
        place = np.flatnonzero(hot)
        rows["h"][place] = content(spec, [body[i] for i in place.tolist()])
        order = place[np.lexsort((rows["lo"][place], rows["doc"][place], rows["h"][place]))]
        repeats = settled(spec, rows[place], ("h",))[1]
        spans = spans_of(spec, rows[order[repeats]])
        out.append(packed(SPANS, spans, doc_bucket(spans["doc"], buckets)))
        keep = ~hot
        keep[order[~repeats]] = True
        keep = np.flatnonzero(keep)
        rows, body = rows[keep], [body[i] for i in keep.tolist()]
    out.append(packed(OPENS, rows, (rows["h"] % U(buckets)).astype(np.int64), body))
    return pa.Table.from_batches(out, ROWS)


def _resolved(table, spec: Windows, buckets: int, resolve: Callable):
    """Removed spans among the open runs of a bucket, by the operator's method."""
    spans = [unpacked(table, SPANS, SPAN)]
    rows = unpacked(table, OPENS, OPEN)
    if len(rows):
        body = b"".join(b.as_py() for b, k in zip(table.column("body"), table.column("kind").to_pylist()) if k == OPENS)
        spans.append(resolve(spec, rows, body))
    spans = merged(np.concatenate(spans))
    return pa.Table.from_batches([packed(SPANS, spans, doc_bucket(spans["doc"], buckets))], ROWS)


def removed_spans(docs: DataFrame, whole: DataFrame, spec: Windows, resolve: Callable, buckets: int, name: str) -> DataFrame:
    """Spans that repeat an earlier window, packed per bucket of documents. The
    documents are dealt by bucket here and once more by the caller, in the same
    way, so Spark shuffles their texts once."""
    def sift(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket").applyInArrow(lambda key, table: _sifted(table, spec, buckets), ROWS_SQL)

    with shuffles_removed(docs.sparkSession):
        sifted = written(sift(docs.mapInArrow(partial(_anchored, spec=spec, buckets=buckets), ROWS_SQL)), name)
    open_runs, spans = sifted.where(F.col("kind") == OPENS), sifted.where(F.col("kind") == SPANS)
    if sifted.agg(F.max("kind")).first()[0] == HOTS:
        open_runs = open_runs.unionByName(sift(
            dealt(whole, buckets).groupBy("bucket").cogroup(sifted.where(F.col("kind") == HOTS).groupBy("bucket"))
            .applyInArrow(lambda key, docs, table: _parted(docs, table, spec, buckets), ROWS_SQL)))
    resolved = (
        dealt(whole, buckets).groupBy("bucket").cogroup(open_runs.groupBy("bucket"))
        .applyInArrow(lambda key, docs, table: _gathered(docs, table, spec, buckets), ROWS_SQL)
        .groupBy("bucket").applyInArrow(lambda key, table: _resolved(table, spec, buckets, resolve), ROWS_SQL))
    return spans.unionByName(resolved)


def without_repeats(docs: DataFrame, spec: Windows, resolve: Callable, finish: Callable, schema: str,
                    keep: tuple[str, ...] = (), buckets: int | None = None) -> DataFrame:
    """``finish(documents, spans)`` on each bucket of documents (doc_id, text and
    the columns ``keep``), where a span's tokens are covered by repeated windows."""
    whole, docs = texts(docs, *keep), texts(docs)
    bounded_batches(docs.sparkSession)
    buckets = buckets or BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    spans = removed_spans(docs, whole, spec, resolve, buckets, "repeats")
    return (dealt(whole, buckets).groupBy("bucket").cogroup(spans.groupBy("bucket"))
            .applyInArrow(lambda key, docs, table: finish(docs, unpacked(table, SPANS, SPAN)), schema))


def covered(spans: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(covered tokens, maximal runs of them in each document); documents with
    one id share its spans, cut at their own ends."""
    spans = merged(spans)
    a, b = doc_slices(ids, spans["doc"])
    n = b - a
    which = np.repeat(np.arange(len(ids)), n)
    pick = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
    size = np.diff(offsets)[which]
    lo = np.minimum(spans["lo"][pick].astype(np.int64), size)
    hi = np.minimum(spans["hi"][pick].astype(np.int64), size)
    edge = np.zeros(int(offsets[-1]) + 1, np.int8)
    np.add.at(edge, offsets[which] + lo, 1)
    np.add.at(edge, offsets[which] + hi, -1)
    return np.cumsum(edge[:-1], dtype=np.int8) > 0, np.bincount(which[hi > lo], minlength=len(ids))
