"""Substring dedup of words by relative Lempel-Ziv parsing.

A window is ``LENGTH`` words; a word is removed if a window that covers it
also starts in a document with a smaller doc_id, judged on the input. The
reference blocks are the buckets that ``repeats`` deals by content: each
holds every passage whose windows may repeat there, indexed by window. A
document's passages are factored greedily against the block: at the first
word whose window an earlier document has, the factor is that window extended
as far as both texts agree. Parsing goes on with the windows that straddle the
factor's end, so no boundary hides a match; a word without one is a literal.
Factors of LENGTH words or more are the duplicate spans.

A null text has no words. Rows with one doc_id are versions of one document:
a span removed in one is removed at its place in all. A null doc_id comes
after all others. Extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .repeats import SPAN, Windows, covered, ids_of, merged, without_repeats
from .sequences import gram, utf8, words

LENGTH = 13
ANCHOR = 4
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_WORD_AND_BLANKS = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def resolve(spec: Windows, rows: np.ndarray, body: bytes) -> np.ndarray:
    """Duplicate spans: the factors of each open run against the block."""
    tokens = np.frombuffer(body, "<u8")
    size = rows["n"].astype(np.int64) + spec.size
    base = np.concatenate([[0], np.cumsum(size)])[:-1]
    owner = np.repeat(np.arange(len(rows)), size)
    ends = (base + size)[owner]
    starts = np.flatnonzero(np.arange(len(tokens)) + spec.size <= ends)
    # index: window -> its place in the earliest document that has it
    grams, doc = gram(tokens, spec.size)[starts], rows["doc"][owner[starts]]
    order = np.lexsort((starts, doc, grams))
    new = np.concatenate([[True], grams[order][1:] != grams[order][:-1]])
    leader = starts[order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]]
    source = np.full(len(tokens), -1, np.int64)
    source[starts[order]] = leader
    earlier = np.zeros(len(tokens), bool)
    earlier[starts] = rows["doc"][owner[source[starts]]] < doc
    out = []
    ends_of, word = ends.tolist(), tokens.tolist()
    origin, match = source.tolist(), earlier.tolist()
    for run in np.unique(owner[np.flatnonzero(earlier)]).tolist():
        begin = p = int(base[run])
        end = ends_of[p]
        while p + spec.size <= end:
            if not match[p]:
                p += 1  # a literal
                continue
            q = origin[p]
            limit = min(end - p, ends_of[q] - q)
            n = spec.size
            while n < limit and word[p + n] == word[q + n]:
                n += 1
            out.append((int(rows["doc"][run]), int(rows["lo"][run]) + p - begin,
                        int(rows["lo"][run]) + p - begin + n))
            p += n - spec.size + 1  # windows across the factor's end come next
    return merged(np.array(out, SPAN))


def _masks(docs: pa.Table, spans: np.ndarray):
    """(bytes of the text, word mask or None where all are kept) of each document"""
    data, offsets = utf8(docs.column("text"))
    at = words(data, offsets)[2]
    gone, _ = covered(spans, ids_of(docs.column("doc_id")), at)
    n = np.diff(np.concatenate([[0], np.cumsum(gone)])[at]).tolist()
    raw = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        yield raw[a:b], (~gone[at[i]:at[i + 1]]).tolist() if n[i] else None, n[i]


def _digests(docs: pa.Table, spans: np.ndarray) -> pa.Table:
    n_words, n_removed, digest = [], [], []
    for text, mask, n in _masks(docs, spans):
        found = text.split()
        n_words.append(len(found))
        n_removed.append(n)
        digest.append(sha256(b" ".join(found if mask is None else compress(found, mask))).hexdigest())
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})


def _kept(docs: pa.Table, spans: np.ndarray) -> pa.Table:
    out = [(text if mask is None else b"".join(compress(_WORD_AND_BLANKS.findall(text), mask)), n)
           for text, mask, n in _masks(docs, spans)]
    return (docs.drop_columns(["text", "bucket"])
            .append_column("text", pa.array([t.decode() for t, _ in out], pa.string()))
            .append_column("n_removed", pa.array([n for _, n in out], pa.int64())))


def windows(length: int = LENGTH, anchor: int = ANCHOR) -> Windows:
    return Windows(size=length, k=anchor, by_word=True, same_doc=False)


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    return without_repeats(docs, windows(length), resolve, _digests, SCHEMA)


def dedup_texts(docs: DataFrame, *keep: str, length: int = LENGTH) -> DataFrame:
    """doc_id, the columns ``keep``, text without the removed words (and the blanks after each), n_removed."""
    fields = [docs.schema[c] for c in keep]
    schema = StructType([StructField("doc_id", LongType()), *fields,
                         StructField("text", StringType()), StructField("n_removed", LongType())])
    return without_repeats(docs, windows(length), resolve, _kept, schema, keep)
