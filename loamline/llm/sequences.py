"""Vectorised helpers over token sequences: bytes or words of many documents
laid end to end in one array, with hashes of every k-gram."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | U(1)
_ODD = _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) | U(1)
WORD_BLOCK = 1 << 16
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and shift, a bijection)."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x ^= x >> U(29)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at.astype(np.int64) - int(at[0])


def shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x[i + by], with the last value repeated beyond the end."""
    if by >= len(x):
        return np.full_like(x, x[-1] if len(x) else 0)
    return np.concatenate([x[by:], np.repeat(x[-1:], by)])


def power_grams(values: np.ndarray, top: int) -> dict[int, np.ndarray]:
    """Hashes of the 1-, 2-, 4-, ... top-grams that start at each place, by doubling."""
    out, size, level = {1: values}, 1, 0
    while size < top:
        x = out[size]
        out[size * 2] = mix(x * _ODD[level] + shifted(x, size) + U(size))
        size, level = size * 2, level + 1
    return out


def gram(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram at each place: two overlapping power-of-two grams cover it."""
    half = 1 << (n.bit_length() - 1)
    x = power_grams(values, half)[half]
    return x if half == n else mix(x * _ODD[60] + shifted(x, n - half) * _ODD[61])


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of x[i : i + width], by doubling."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x, shifted(x, size))
        size *= 2
    return np.minimum(x, shifted(x, width - size)) if width > size else x


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK):
    """(start, end, document offsets): words between the bytes in ``blank`` (the
    six ASCII blanks), of all texts in order; a word never crosses a text's end."""
    word = ~blank[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.concatenate([[False], word[:-1]]) & ~cut[:-1]
    after = np.concatenate([word[1:], [False]]) & ~cut[1:] if len(data) else word
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def letter_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False):
    """(hash of each byte of each word and its place in it, first byte of each
    word, word sizes); ``lower``: with A-Z lower-cased."""
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    byte = data[place + np.repeat(start, size)]
    if lower:
        byte = np.where((byte >= 65) & (byte <= 90), byte + np.uint8(32), byte)
    letters = BYTE_VALUE[byte] + place.astype(np.uint64) * U(0xA0761D6478BD642F)
    letters ^= letters >> U(32)
    letters *= U(0xE7037ED1A0B428DB)
    letters ^= letters >> U(29)
    letters *= U(0x8EBC6AF09C88C6E3)
    return letters, first, size


def word_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, block by block so that little is held per letter."""
    out = np.zeros(len(start), np.uint64)
    for i in range(0, len(start), WORD_BLOCK):
        letters, first, size = letter_values(data, start[i:i + WORD_BLOCK], end[i:i + WORD_BLOCK], lower)
        out[i:i + WORD_BLOCK] = mix(np.add.reduceat(letters, first) + size.astype(np.uint64))
    return out


def chunks(offsets: np.ndarray, limit: int = 1 << 20):
    """(first, last) document ranges of about ``limit`` tokens; a longer document stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last
