"""Repeated passages by seed and extend over winnowed anchors.

Seeds: of every window of ``window`` words the word k-gram with the smallest hash
is the anchor (the leftmost of equals), so equal windows choose the same anchor.
Consecutive windows with one anchor form a segment: the anchor extended to the
left and right as far as windows choose it.

Join: segments meet by the digest of their whole word sequence. Every copy of a
segment in a later document is a repeat of all its windows. An anchor that has
more than one distinct segment is extended window by window: one segment of each
kind (the one in the smallest document) lists its windows, and these meet by
their digests. Together the two steps decide every window: equal windows lie in
equal segments, or in distinct segments of one anchor.

Adjacent removed windows merge into maximal repeats. Digests have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import materialize, python_ready

WINDOW = 50
ANCHOR_WORDS = 10


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window of ``width`` values."""
    at = np.arange(len(values))
    step = 1
    while step < width:
        jump = min(step, width - step)
        left, right = at[:-jump], at[jump:]
        at = np.where(values[right] < values[left], right, left)
        step += jump
    return at


def text_segments(hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window of each segment of one text, from its word hashes."""
    n = len(hashes)
    if n < window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    grams = np.zeros(n - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - k + 1 + i]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
    anchor = _sliding_argmin(grams, window - k + 1)
    cut = np.flatnonzero(anchor[1:] != anchor[:-1])
    first = np.concatenate([[0], cut + 1])
    last = np.concatenate([cut, [len(anchor) - 1]])
    return grams[anchor[first]].view(np.int64), first, last


def _digests(view: memoryview, starts: list[int], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join(xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(starts, ends))
    both = np.frombuffer(raw, "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _segment_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                w = textops.split_words(texts)
                hashes = textops.hash_spans(w.buf, w.starts, w.ends)
                view = memoryview(w.buf)
                cols: list[list] = [[], [], [], []]
                for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
                    anchor, first, last = text_segments(hashes[a:b], window, k)
                    cols[0].append(np.full(len(anchor), i))
                    cols[1].append(anchor)
                    cols[2].append(first)
                    cols[3].append(last)
                row, anchor, first, last = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
                begin = w.starts[w.first[row] + first] if len(row) else []
                end = w.ends[w.first[row] + last + window - 1] if len(row) else []
                hi, lo = _digests(view, list(begin), list(end))
                ids, keys = (part.column(i).take(pa.array(row)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array(anchor), pa.array(hi), pa.array(lo), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    ["doc_id", "text_key", "anchor", "hi", "lo", "first", "last"],
                )

    return run


def _window_rows(window: int):
    """Digest of every window of the listed segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                w = textops.split_words(texts)
                view = memoryview(w.buf)
                ids, keys, spans = (part.column(i).to_pylist() for i in (0, 1, 3))
                for i, listed in enumerate(spans):
                    base = int(w.first[i])
                    at = np.concatenate([np.arange(s["first"], s["last"] + 1) for s in listed])
                    hi, lo = _digests(view, w.starts[base + at].tolist(), w.ends[base + at + window - 1].tolist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), ids[i])), pa.array(np.full(len(at), keys[i])), pa.array(hi), pa.array(lo), pa.array(at.astype(np.int32))],
                        ["doc_id", "text_key", "hi", "lo", "first"],
                    )

    return run


def _removal(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                w = textops.split_words(texts)
                counts, spans = w.counts(), part.column(2).to_pylist()
                removed, digest, repeats = [], [], []
                for i, listed in enumerate(spans):
                    a, n = int(w.first[i]), int(counts[i])
                    edge = np.zeros(n + 1, np.int64)
                    for s in listed or ():
                        edge[s["first"]] += 1
                        edge[s["last"] + window] -= 1
                    gone = np.cumsum(edge[:n]) > 0
                    flips = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    repeats.append([{"start": int(x), "words": int(y - x)} for x, y in zip(flips[::2], flips[1::2])])
                    # kept stretches are slices of the buffer
                    edges = [0, *flips.tolist(), n]
                    view = w.buf
                    kept = [view[w.starts[a + x] : w.ends[a + y - 1]].tobytes() for x, y in zip(edges[::2], edges[1::2]) if y > x]
                    removed.append(int(gone.sum()))
                    digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                     pa.array(repeats, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())])))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "repeats"],
                )

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, text_key, first, last): runs of windows that also start in a document with a smaller id.

    ``docs``: (doc_id long, text_key long, text string) with non-null ids; ``text_key`` tells texts with one id apart.
    """
    rows = materialize(
        python_ready(docs).mapInArrow(_segment_rows(window, k), "doc_id long, text_key long, anchor long, hi long, lo long, first int, last int"), "segments"
    )
    kinds = materialize(rows.groupBy("anchor", "hi", "lo").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "segment-kinds")
    copied = kinds.filter("most > least").select("hi", "lo", "least")
    mixed = kinds.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("mixed")).filter("mixed").select("anchor")
    whole = rows.join(copied, ["hi", "lo"]).filter("doc_id > least").select("doc_id", "text_key", "first", "last")

    # one segment of each kind, those in its smallest document, goes on to single windows
    front = kinds.join(mixed, "anchor", "left_semi").select("hi", "lo", "least")
    listed = (
        rows.join(front, ["hi", "lo"]).filter("doc_id = least").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    windows = materialize(
        docs.join(listed, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "spans")
        .mapInArrow(_window_rows(window), "doc_id long, text_key long, hi long, lo long, first int"),
        "windows",
    )
    earliest = windows.groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("most > least")
    single = windows.join(earliest.select("hi", "lo", "least"), ["hi", "lo"]).filter("doc_id > least")
    return whole.union(single.select("doc_id", "text_key", "first", F.col("first").alias("last")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, repeats) for every row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller id; windows are judged on the input. ``repeats`` lists
    the maximal repeats (start word, number of words). Null and empty texts have no
    words. Rows repeated with the same id do not count against each other, and each is
    judged by its own text; rows with a null id keep all their words and are never a smaller document. An empty
    table gives an empty result; extra columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = repeated_windows(rows.filter("doc_id is not null"), window, k)
    spans = materialize(found.distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans")), "repeats")
    joined = rows.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
    return python_ready(joined).mapInArrow(
        _removal(window),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, repeats array<struct<start:long,words:long>>",
    )
