"""SimHash near-duplicates by meeting in the middle.

Two fingerprints at distance d <= 3 meet in a value at distance <= 2 of one and
<= 1 of the other (the halves of the radius, rounded up and down). So every
distinct fingerprint emits its variants, the variants are shuffled, and those
that collide are verified. Two facts keep the emission small without losing a
pair:

* Fingerprints at distance 3 (or 1) differ in the parity of their bits. It is
  enough that those of even parity emit variants of two flipped bits; all emit
  themselves and their variants of one flipped bit.
* Of any three flipped bits two lie in the same 32-bit half, and the third is a
  single flip of the other fingerprint. So two-bit variants flip bits of one
  half only: 992 instead of 2016.

A value is met by at most 1,057 distinct fingerprints however large a group of
near copies is. Those that reach it with one flip or none are within 2 of each
other; one of them is the centre, and every other member is verified against the
centre and linked to it. So a group needs no list of all its pairs, and linked
fingerprints still end up in one component.

Variants travel packed (ten bytes each) in one row per bucket and input chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import fresh_names, materialize, python_ready
from faregrid.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
_RECORD = np.dtype([("value", "<u8"), ("mask", "<u2")])
_EMIT_CHUNK = 2048
_TASK_RECORDS = 3_000_000  # variants that one task sorts


def _masks(max_bits: int) -> np.ndarray:
    """Flips a fingerprint of even parity emits: none, single bits, pairs within a half; odd parity has no pairs."""
    one = [1 << i for i in range(64)]
    two = [one[i] | one[j] for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
    return np.array([0, *(one if max_bits >= 1 else []), *(two if max_bits >= 3 else [])], np.uint64)


def _bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def text_fingerprints(words: textops.Words, shingle: int) -> np.ndarray:
    """One fingerprint per text: the bits set in over half of its shingle hashes."""
    counts = words.counts()
    n_sh = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    out = np.zeros(len(counts), np.uint64)
    total = int(n_sh.sum())
    if not total:
        return out
    text = np.repeat(np.arange(len(counts)), n_sh)
    begin = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n_sh, out=begin[1:])
    first = words.first[text] + np.arange(total) - begin[text]
    last = np.minimum(first + shingle, words.first[text + 1]) - 1
    hashes = textops.hash_spans(words.buf, words.starts[first], words.ends[last], 42)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(n_sh)
    ones = np.add.reduceat(bits, begin[full], axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > n_sh[full][:, None], axis=1, bitorder="little")
    out[full] = np.ascontiguousarray(packed).view("<u8").ravel()
    return out


def _text_key(text_col: str) -> Column:
    """Tells texts with one id apart; null and empty texts are the same."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): a 64-bit fingerprint as a signed long; null and empty texts have 0."""
    rows = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                fp = text_fingerprints(textops.split_words(texts, lower=True), shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _emitter(max_bits: int, buckets: int):
    masks = _masks(max_bits)
    # distances 1 and 3 are between parities: there one side flips one bit less
    for_even, for_odd = masks[:1] if max_bits == 1 else masks, masks[:65]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), _EMIT_CHUNK):
                part = fps[at : at + _EMIT_CHUNK]
                even = _bit_count(part) % 2 == 0
                sets = [(part[even], for_even), (part[~even], for_odd)]
                values = np.concatenate([np.bitwise_xor.outer(f, m).ravel() for f, m in sets])
                which = np.concatenate([np.tile(np.arange(len(m), dtype=np.uint16), len(f)) for f, m in sets])
                with np.errstate(over="ignore"):
                    bucket = ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                records = np.empty(len(values), _RECORD)
                records["value"], records["mask"] = values[order], which[order]
                used, begin = np.unique(bucket[order], return_index=True)
                ends = np.append(begin[1:], len(order))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used.astype(np.int64)), pa.array([records[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary())],
                    ["bucket", "variants"],
                )

    return run


def _meeter(max_bits: int):
    masks = _masks(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for batch in batches for b in batch.column(1).to_pylist()]
        if not blobs:
            return
        records = np.frombuffer(b"".join(blobs), _RECORD)
        del blobs
        order = np.argsort(records["value"], kind="stable")
        value = records["value"][order]
        same = value[1:] == value[:-1]
        met = np.zeros(len(value), bool)
        met[1:] |= same
        met[:-1] |= same
        value, mask = value[met], records["mask"][order][met].astype(np.int64)
        if not len(value):
            return
        fp = value ^ masks[mask]
        flips = (mask > 0).astype(np.int8) + (mask > 64)
        order = np.lexsort((fp, flips, value))  # of each value the centre comes first: fewest flips, then smallest
        value, mask, fp = value[order], mask[order], fp[order]
        begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        size = np.diff(np.append(begin, len(value)))
        centre = np.repeat(fp[begin], size)
        usable = np.repeat(mask[begin] <= 64, size) & (fp != centre) & (_bit_count(fp ^ centre) <= max_bits)
        pairs = np.unique(np.stack([fp[usable], centre[usable]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"]
        )

    return run


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): verified links between distinct fingerprints, enough to connect every group.

    Input: one column of distinct non-null longs, on disk (it is counted first).
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0, 1, 2 or 3")
    records = distinct_fps.count() * (len(_masks(max_bits)) + 65) // 2
    # by volume alone: each chunk emits a row per bucket, so more tasks than that would only make more and smaller rows
    tasks = max(1, -(-records // _TASK_RECORDS))
    # a table of few files would leave the emission of all variants to as few tasks
    dealt = python_ready(distinct_fps).repartition(tasks)
    emitted = dealt.mapInArrow(_emitter(max_bits, 8 * tasks), "bucket long, variants binary")
    return emitted.repartition(tasks, "bucket").mapInArrow(_meeter(max_bits), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) for every row; ``component`` is never null."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    members = connected_components(links(distinct.select("fp"), max_bits))
    labelled = distinct.join(members, distinct.fp == members.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least"
    )
    groups = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(labelled.join(groups, "component").select("fp", "component", "component_id"), "components")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Texts are lower-cased (A-Z) whole; a text shorter than a shingle is one
    shingle; null, empty and blank texts have fingerprint zero and are linked like
    others. ``component_id`` is the smallest id among the documents reachable over
    links of at most ``max_bits`` bits; null ids take no part in that minimum (null
    if a component has only null ids). Rows repeated are judged each. An empty
    table gives an empty result; extra columns are ignored.
    """
    return _grouped(docs, shingle, max_bits, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component (the one with its smallest id), all columns as they were.

    A document without an id stays only if its whole component has none. Of a
    component's texts with the same id one stays: the one with the smallest hash;
    of rows equal in id and text any one. An empty table gives an empty result. Other
    columns may have any names.
    """
    own_id, own_text = fresh_names(docs.columns, 2)
    found = _grouped(docs, shingle, max_bits, id_col, text_col).groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "rows")).alias("k")
    kept = materialize(
        found.groupBy("component").agg(least).select(F.col("k.doc_id").alias(own_id), F.col("k.text_key").alias(own_text), F.col("k.rows").alias("_rows")),
        "kept",
    )
    same = docs[id_col].cast("long").eqNullSafe(F.col(own_id)) & (_text_key(text_col) == F.col(own_text))
    out = docs.join(kept.filter("_rows = 1").drop("_rows"), same, "left_semi")
    repeated = kept.filter("_rows > 1")
    if repeated.isEmpty():
        return out
    keyed = docs.join(repeated.drop("_rows"), same).dropDuplicates([own_id, own_text])
    return out.union(keyed.select(*[docs[c] for c in docs.columns]))
