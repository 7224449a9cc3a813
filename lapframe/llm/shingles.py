"""Hashed words and five-word shingles of whole texts, computed on UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# Bytes hashed at once; a longer word is hashed in one go.
BLOCK = 1 << 20
WIDTH = 5

_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 64)
        for i, base in enumerate((BASE, INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of data[start:end] for ascending, disjoint spans."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same in blocks of about ``BLOCK``, whatever the length of the data."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = starts[i], ends[j - 1]
        out[i:j] = hash_spans(data[a:b], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of consecutive texts, and the number of words in each.

    ``data`` are their UTF-8 bytes with A-Z lower-cased, ``bounds`` the byte limits of the texts.
    Words are the runs without space, tab, line feed, vertical tab, form feed or carriage return.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    limits = bounds[:-1][np.diff(bounds) > 0]
    first[limits] = inside[limits]
    last[limits[1:] - 1] = inside[limits[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, bounds))
    return span_hashes(data, starts, ends), counts


def lowered_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column with A-Z lower-cased, and the limits of its texts."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]].copy() if raw is not None else np.zeros(0, np.uint8)
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    return data, offsets - offsets[0]


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    A text with fewer words than ``width`` has its whole sequence as one shingle; without words, none.
    """
    words, counts = word_hashes(*lowered_bytes(column))
    salts = mix(np.arange(1, width + 1, dtype=np.uint64))
    at = 0
    for n in counts.tolist():
        own = words[at : at + n]
        at += n
        if n == 0:
            yield np.zeros(0, np.uint64)
            continue
        size = min(n, width)
        x = own[: n - size + 1] * (salts[0] | np.uint64(1))
        for k in range(1, size):
            x = mix(x + salts[k]) + own[k : n - size + 1 + k] * (salts[k] | np.uint64(1))
        yield np.unique(mix(x ^ np.uint64(size)))


def limited(batch: pa.RecordBatch, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose ``text`` column holds about ``limit`` bytes."""
    column = batch.column(batch.schema.get_field_index("text"))
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else []
    start, used = 0, 0
    for i, size in enumerate(sizes):
        if used and used + size > limit:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += int(size)
    if start < len(sizes):
        yield batch.slice(start)
