"""Token counts of whole texts by overlap resynchronisation.

A huge text is encoded in overlapping chunks. Two neighbouring chunks are
joined at a position where both begin a pre-tokenizer piece: a piece is
determined by the text from its start on, so from a start that both scans
share they agree for good. A start seen by the earlier chunk counts only
``GUARD`` characters before that chunk's end, beyond the reach of the piece
pattern's look-ahead and of a special string cut in two. Where the overlap
holds no common start, it is widened until it reaches the last joint, which
is a start already.

Nulls and empty texts have 0 tokens; a doc_id that repeats gives one row per
input row; extra columns are dropped.
"""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import bounded_batches, texts
from .vocab import part_cache, tokenizer

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
GUARD = 32
MAX_TOKENS = 1024
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def piece_starts(encoding, base: int) -> dict[int, int]:
    """Position in the text where each piece begins -> tokens before it."""
    starts, last = {}, None
    for k, (word, (a, b)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != last and b > a:
            starts[base + a] = k
        last = word
    return starts


def spliced(tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Ids of ``text``, encoded chunk by chunk; ``joint`` is the last proven
    piece start, ``out`` holds the ids before it."""
    encode = partial(tok.encode, add_special_tokens=False)
    out: list[int] = []
    joint = base = skip = 0
    end = min(chunk, len(text))
    current = encode(text[:end])
    while end < len(text):
        wide = overlap
        while True:
            begin = max(joint, end - wide)
            until = min(len(text), end + max(chunk, wide))
            following = encode(text[begin:until])
            if begin == joint:  # a proven start: this chunk replaces the other from there on
                skip = 0
                break
            here, there = piece_starts(current, base), piece_starts(following, begin)
            common = [p for p in here if p in there and joint <= p <= end - GUARD]
            if common:
                joint = min(common)
                out.extend(current.ids[skip:here[joint]])
                skip = there[joint]
                break
            wide *= 4
        current, base, end = following, begin, until
    out.extend(current.ids[skip:])
    return out


def _count(batches, path: str, chunk: int, overlap: int, limit: int):
    tok, cache = tokenizer(path), part_cache(path, len)
    for batch in batches:
        ids, size, n = batch.column(0), [], []
        for text in batch.column(1).to_pylist():
            size.append(len(text.encode()))
            n.append(len(spliced(tok, text, chunk, overlap)) if len(text) > chunk
                     else sum(cache.parts(text)))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(size, pa.int64()), pa.array(n, pa.int64()),
             pa.array([x > limit for x in n], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"])


def token_counts(docs: DataFrame, path: str, limit: int = MAX_TOKENS,
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; a map over the scan, no shuffle."""
    bounded_batches(docs.sparkSession)
    return texts(docs).mapInArrow(
        partial(_count, path=path, chunk=chunk, overlap=overlap, limit=limit), SCHEMA)
