"""Suffix-array dedup of bytes by deep-shallow sorting.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller doc_id, or earlier in the same document) is removed; strings are
judged on the input. ``repeats`` deals the suffixes that may repeat; a
bucket's suffixes are sorted here to ``LENGTH`` bytes: a multikey quicksort
with eight-byte characters orders them down to ``SHALLOW`` bytes, and a blind
trie orders each group that is still tied. Suffixes that end in one leaf are
equal; all but the first are removed.

A null text is empty; empty and short texts keep all their bytes. Rows with
one doc_id are versions of one document: a span removed in one is removed at
its place in all. A null doc_id comes after all others. Extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import SPAN, Windows, covered, ids_of, merged, without_repeats
from .sequences import U, shifted, utf8

LENGTH = 100
ANCHOR = 32
SHALLOW = 48
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def characters(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts as they do."""
    out = text.astype(np.uint64)
    for size in (1, 2, 4):
        out = (out << U(8 * size)) | shifted(out, size)
    return out


def multikey(text: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ``start`` sorted by their first ``depth`` bytes, and a number for
    each group of equal ones. Only groups still tied are sorted by the next character."""
    chars = characters(text)
    order = start[np.argsort(chars[start], kind="stable")]
    symbol = chars[order]
    new = np.concatenate([[True], symbol[1:] != symbol[:-1]])
    for at in range(8, depth, 8):
        tied = ~new | ~np.concatenate([new[1:], [True]])
        place = np.flatnonzero(tied)
        if not len(place):
            break
        group = np.cumsum(new)[place]
        symbol = chars[order[place] + at]
        rank = np.lexsort((symbol, group))
        order[place] = order[place[rank]]
        group, symbol = group[rank], symbol[rank]
        new[place[1:]] |= (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])
    return order, np.cumsum(new) - 1


class BlindTrie:
    """Strings of one length in a trie that stores branching depths and single
    bytes only: descend blindly, compare with the one string found, insert."""

    def __init__(self, depth: int, length: int):
        self.depth, self.length = depth, length
        self.root = None  # leaf: [string, members]; branch: (depth, {byte: node})

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = [string, [member]]
            return
        node = self.root
        while type(node) is tuple:
            at, below = node
            node = below.get(string[at]) or next(iter(below.values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        differ = int.from_bytes(string) ^ int.from_bytes(other)
        split = self.length - (differ.bit_length() + 7) // 8  # first byte that differs
        parent, node = None, self.root
        while type(node) is tuple and node[0] < split:
            parent, node = node, node[1][string[node[0]]]
        if type(node) is tuple and node[0] == split:
            node[1][string[split]] = [string, [member]]
            return
        branch = (split, {other[split]: node, string[split]: [string, [member]]})
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch

    def leaves(self) -> list[list[int]]:
        """Members of each leaf, in the strings' order."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            elif node is not None:
                out.append(node[1])
        return out


def deep_shallow(text: bytes, start: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW):
    """Suffixes sorted to ``length`` bytes, and group numbers of equal ones."""
    data = np.frombuffer(text, np.uint8)
    order, group = multikey(data, start, shallow)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    size = np.diff(np.append(first, len(order)))
    bounds = np.zeros(len(order), bool)
    bounds[first] = True
    for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
        trie = BlindTrie(shallow, length)
        for p in order[a:a + n].tolist():
            trie.insert(text[p:p + length], p)
        at = a
        for members in trie.leaves():
            bounds[at] = True
            order[at:at + len(members)] = members
            at += len(members)
    return order, np.cumsum(bounds) - 1


def resolve(spec: Windows, rows: np.ndarray, body: bytes) -> np.ndarray:
    """Removed spans among open runs: windows equal to an earlier one."""
    windows = rows["n"].astype(np.int64) + 1
    base = np.concatenate([[0], np.cumsum(windows + spec.size - 1)])[:-1]
    which = np.repeat(np.arange(len(rows)), windows)
    step = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    owner = np.zeros(len(body), np.int64)
    owner[base[which] + step] = which
    order, group = deep_shallow(body, base[which] + step, spec.size)
    found = np.zeros(len(order), np.dtype([("g", "<i8"), ("doc", "<i8"), ("lo", "<i8")]))
    run = owner[order]
    found["g"], found["doc"] = group, rows["doc"][run]
    found["lo"] = rows["lo"][run] + (order - base[run])
    found = found[np.lexsort((found["lo"], found["doc"], found["g"]))]
    new = np.concatenate([[True], found["g"][1:] != found["g"][:-1]])
    first = found[np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))]
    again = found[spec.later(found, first)]
    spans = np.zeros(len(again), SPAN)
    spans["doc"], spans["lo"], spans["hi"] = again["doc"], again["lo"], again["lo"] + spec.size
    return merged(spans)


def _digests(docs: pa.Table, spans: np.ndarray) -> pa.Table:
    data, offsets = utf8(docs.column("text"))
    gone, n_spans = covered(spans, ids_of(docs.column("doc_id")), offsets)
    kept = data[~gone].tobytes()
    left = np.concatenate([[0], np.cumsum(~gone)])[offsets]
    size = np.diff(offsets)
    return pa.table({
        "doc_id": docs.column("doc_id"), "n_bytes": pa.array(size, pa.int64()),
        "n_removed": pa.array(size - np.diff(left), pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
        "kept_sha256": [sha256(kept[a:b]).hexdigest() for a, b in zip(left[:-1].tolist(), left[1:].tolist())]})


def _kept(docs: pa.Table, spans: np.ndarray) -> pa.Table:
    data, offsets = utf8(docs.column("text"))
    gone, _ = covered(spans, ids_of(docs.column("doc_id")), offsets)
    kept = data[~gone].tobytes()
    left = np.concatenate([[0], np.cumsum(~gone)])[offsets].tolist()
    return pa.table({"doc_id": docs.column("doc_id"),
                     "kept": pa.array([kept[a:b] for a, b in zip(left, left[1:])], pa.binary())})


def windows(length: int = LENGTH, anchor: int = ANCHOR) -> Windows:
    return Windows(size=length, k=anchor, by_word=False, same_doc=True)


def dedup_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    return without_repeats(docs, windows(length), resolve, _digests, SCHEMA)


def dedup_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id and the bytes that are kept (they may cut a character)."""
    return without_repeats(docs, windows(length), resolve, _kept, "doc_id long, kept binary")
