"""Sum-of-squares online packing of token sequences.

Each task packs the documents it reads, one at a time. Whole windows are cut
off a long document first; its rest goes to the fill level that leaves the
sum of squared counts of partially filled windows smallest. ``counts[h]`` is
the level array: the number of open windows filled to ``h``. The windows
still open when the task ends are drained into one another by cutting, and
the last rest becomes windows of powers of two, which need no padding.

Open windows are all a task holds (their ids are needed for the last step).
When more than ``max_open`` are open they are drained early, so memory is
bounded whatever the lengths are; nothing is dropped.

Ids are those of the tokenizer file; the same vocabulary as ranks gives them
faster (``vocab.fast_ids``).

A null or empty text is a document of the end id alone. Repeated doc_ids are
packed as separate documents; extra columns are dropped. No rows, no pieces.
"""

from __future__ import annotations

from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tables import bounded_batches, texts
from .vocab import fast_ids, little_endian

WINDOW = 1024
MAX_OPEN = 4096
END = little_endian([0])
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])


class Packer:
    """Places documents (ids packed as 4-byte words) and collects finished pieces."""

    def __init__(self, first_sequence: int, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.next_sequence = first_sequence
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list] = [[] for _ in range(window)]  # by level; each window a list of pieces
        self.n_open = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        """Emit one window: pieces are (doc_id, start, ids, doc_tokens)."""
        at = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, crc32(ids), total, self.next_sequence, at))
            at += n
        self.next_sequence += 1

    def level(self, size: int) -> int:
        """Level (0: a new window) whose use leaves the smallest sum of squares."""
        w, n = self.window, self.counts
        after = n[size:w + 1]  # counts at h + size for h = 0..w - size
        change = 2 * (after - n[:w + 1 - size]) + 2
        change[-1] = 1 - 2 * n[w - size]  # a full window leaves the sum
        change[0] = 2 * n[size] + 1  # a new window leaves no level
        change[1:][n[1:w + 1 - size] == 0] = np.iinfo(np.int64).max
        best = int(len(change) - 1 - np.argmin(change[::-1]))  # ties: the fuller window
        return best

    def place(self, doc: int, ids: bytes) -> None:
        total, step = len(ids) // 4, self.window
        cut = total - total % step
        for start in range(0, cut, step):
            self.close([(doc, start, ids[4 * start:4 * (start + step)], total)])
        size = total - cut
        if not size:
            return
        h = self.level(size)
        if h:
            pieces = self.open[h].pop()
            self.counts[h] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append((doc, cut, ids[4 * cut:], total))
        if h + size == step:
            self.close(pieces)
            return
        self.open[h + size].append(pieces)
        self.counts[h + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.drain(last=False)

    def drain(self, last: bool = True) -> None:
        """Close every open window, cutting pieces so that windows are full."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) // 4 for p in pieces)
        goal, room, filled = 0, 0, []
        for doc, start, ids, total in pieces:
            while ids:
                if not room:
                    if left < self.window and not last:
                        n = len(ids) // 4
                        break
                    goal = room = min(self.window, 1 << (left.bit_length() - 1))
                take = min(room, len(ids) // 4)
                filled.append((doc, start, ids[:4 * take], total))
                ids, start = ids[4 * take:], start + take
                room -= take
                left -= take
                if not room:
                    self.close(filled)
                    filled = []
            if ids:  # an early drain: the rest stays open
                self.open[n].append([(doc, start, ids, total)])
                self.counts[n] += 1
                self.n_open += 1
                left -= n

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        cols = list(zip(*rows)) or [()] * len(_ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_ARROW)


def _pack(batches, files: tuple[str, str, str], window: int, max_open: int):
    encode = fast_ids(*files)
    packer = Packer(TaskContext.get().partitionId() << 40, window, max_open)
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            packer.place(doc, encode(text).astype("<u4", copy=False).tobytes() + END)
            if len(packer.rows) >= 20_000:
                yield packer.take()
    packer.drain()
    yield packer.take()


def pack(docs: DataFrame, path: str, ranks_path: str, pattern: str,
         window: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (unique over all tasks), offset. A map over the scan, no shuffle."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(partial(
        _pack, files=(path, ranks_path, pattern), window=window, max_open=max_open), SCHEMA)
