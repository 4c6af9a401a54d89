"""Vectorised text helpers for Arrow batches (numpy only; Spark partitions the work).

Words are runs of bytes other than space and tab..carriage return. A chunk of
texts is held as one byte buffer in which words are joined by single spaces, so
any run of consecutive words of a text is one slice of the buffer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Constants of the XXH64 algorithm (fixed values).
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with at most ``limit`` bytes of text (or one row); null texts are empty."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start), [t or b"" for t in column.slice(start, stop - start).to_pylist()]
        start = stop
    del column
    pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """Words of several texts: ``buf[starts[i]:ends[i]]`` is word i, of text ``doc[i]``."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(texts: list[bytes], lower: bool = False) -> Words:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = _LOWER[raw]
    space = _SPACE[raw]
    after_word = np.empty_like(space)
    after_word[0], after_word[1:] = False, ~space[:-1]
    keep = ~space | after_word  # words, and one separator after each
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    buf = raw[keep].copy()
    gap = space[keep]
    buf[gap] = 32
    ends = np.flatnonzero(gap)
    starts = np.empty_like(ends)
    if len(ends):
        starts[0], starts[1:] = 0, ends[:-1] + 1
    # words end where a separator follows: count those before each text's end
    word_ends = np.flatnonzero(space & after_word)
    first = np.searchsorted(word_ends, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(buf, starts, ends, doc, first)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each ``buf[start:end]``; spans of 32 bytes and more go through the xxhash library."""
    n = len(starts)
    if n == 0:
        return np.zeros(0, np.uint64)
    pad = np.concatenate([buf, np.zeros(16, np.uint8)])
    word8 = np.empty(len(buf) + 8, "<u8")  # the eight bytes from each position on
    for i in range(8):
        part = word8[i::8]
        part[:] = pad[i : i + 8 * len(part)].view("<u8")
    length = ends - starts
    with np.errstate(over="ignore"):
        h = np.uint64(seed) + _P5 + length.astype(np.uint64)
        pos = starts.copy()
        left = np.where(length < 32, length, 0)
        for _ in range(3):
            at = np.flatnonzero(left >= 8)
            if not len(at):
                break
            lane = word8[pos[at]] * _P2
            h[at] = _rotl(h[at] ^ (_rotl(lane, 31) * _P1), 27) * _P1 + _P4
            pos[at] += 8
            left[at] -= 8
        at = np.flatnonzero(left >= 4)
        if len(at):
            lane = (word8[pos[at]] & np.uint64(0xFFFFFFFF)) * _P1
            h[at] = _rotl(h[at] ^ lane, 23) * _P2 + _P3
            pos[at] += 4
            left[at] -= 4
        for _ in range(3):
            at = np.flatnonzero(left >= 1)
            if not len(at):
                break
            h[at] = _rotl(h[at] ^ (pad[pos[at]].astype(np.uint64) * _P5), 11) * _P1
            pos[at] += 1
            left[at] -= 1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
    long = np.flatnonzero(length >= 32)
    if len(long):
        view = memoryview(np.ascontiguousarray(buf))
        h[long] = [xxhash.xxh64_intdigest(view[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    return h


def unique_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs (by sorting, which is faster here than np.unique's table)."""
    values = np.sort(values)
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[begin], np.diff(np.append(begin, len(values)))
