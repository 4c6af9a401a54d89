"""Language-model scores by deleted interpolation of word n-grams.

Probability of a word after another: a mixture of the bigram and unigram
maximum-likelihood estimates and a uniform floor. The mixture weights depend on
the frequency bucket of the context, and are learned by expectation-maximisation
on held-out counts: a held-out part of the training texts is scored with its own
counts deleted, so that its words are as new as those of other texts.

Corpus counts never leave the cluster. Every task turns its texts into distinct
n-grams with local counts; these meet by n-gram, are summed, and the sums go back
to the blocks of texts that asked. What is sent is packed: a row holds a block's
n-grams of one range of keys. The text sets the number of ranges and the size of
a block, so a task's memory doesn't grow with the input. N-grams are 64-bit
hashes of their words; a text's first word follows a start mark, and every text
ends with an end token.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import materialize, python_ready, shuffle_partitions

BUCKETS = 16  # context frequencies by powers of two; the last holds all above
START, END = np.uint64(0x51ED270B9F0C9A3D), np.uint64(0xA24BAED4963EE407)
_BIN = 0.05  # width of the bins of log10 probabilities in the held-out statistics
_ROUNDS = 100


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a word after another: a 64-bit mix of their hashes."""
    with np.errstate(over="ignore"):
        h = (a ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + b
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every token, hash of the one before it, and where each text begins (texts end with the end token)."""
    w = textops.split_words(texts, lower=True)
    words = textops.hash_spans(w.buf, w.starts, w.ends)
    n = w.counts()
    begin = w.first + np.arange(len(n) + 1)
    out = np.empty(len(words) + len(n), np.uint64)
    end_at = begin[1:] - 1
    is_word = np.ones(len(out), bool)
    is_word[end_at] = False
    out[is_word], out[end_at] = words, END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[begin[:-1]] = START
    return out, before, begin


# Counts travel as chunks: the n-grams of a block whose keys lie in one range, as compressed columns in one row.
# ``kind``: 0 tokens, 1 bigrams, 2 the block's check; from 3 on totals of the corpus (all, of these held out) in ``a`` and ``b``.
_CHUNK = "block long, kind int, n int, keys binary, train binary, fold binary, a long, b long"
_CHECK, _TEXTS, _VOCABULARY, _TOKENS = 2, 3, 4, 5
BLOCK_BYTES = 40 << 20  # text of a block; a scan partition of more is several
RANGE_BYTES = 16 << 20  # text to each range of keys


def _pack(values: np.ndarray) -> bytes:
    """64-bit integers by byte, lowest first, so that the zeros of small ones come together."""
    return pa.compress(np.ascontiguousarray(values.astype("<i8", copy=False).view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _pack_keys(key: np.ndarray) -> bytes:
    """Ascending keys as their differences."""
    return _pack(np.diff(key, prepend=np.uint64(0)).view(np.int64))


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, n).view(np.uint64), dtype=np.uint64)


def _check(ids: list) -> int:
    return len(ids) << 32 | zlib.crc32("\n".join(sorted(map(str, ids))).encode())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """The batches of each block; a block's rows come one after the other."""
    pieces = (
        (int(blocks[lo]), batch.slice(lo, hi - lo))
        for batch in batches
        if batch.num_rows
        for blocks in [batch.column(3).to_numpy(zero_copy_only=False)]
        for cut in [np.flatnonzero(np.diff(blocks)) + 1]
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(blocks)])
    )
    for block, group in itertools.groupby(pieces, lambda x: x[0]):
        yield block, (piece for _, piece in group)


def _local_counts(ranges: int):
    """Of each block: its distinct tokens and bigrams with their counts in training texts, and in held-out ones of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, own in _blocks(batches):
            yield from _block_counts(block, own, ranges)

    return run


def _block_counts(block: int, batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    keys: list[list[list[np.ndarray]]] = [[[], [], []], [[], [], []]]  # kind, part (0 held out, 1 other training, 2 rest)
    ids, texts_of = [], [0, 0, 0]
    for batch in batches:
        for part, texts in textops.chunks(batch):
            role = part.column(2).to_numpy(zero_copy_only=False)
            ids += part.column(0).to_pylist()
            token, before, begin = tokens(texts)
            role_of = np.repeat(role, np.diff(begin))
            for r in range(3):
                mine = role_of == r
                texts_of[r] += int((role == r).sum())
                keys[0][r].append(token[mine])
                keys[1][r].append(_mix(before[mine], token[mine]))
        del batch
    yield _rows([(block % ranges, block, _CHECK, 0, None, None, None, _check(ids), 0)], _LOCAL)
    yield _rows([(block % ranges, block, _TEXTS, 0, None, None, None, texts_of[0] + texts_of[1], texts_of[0])], _LOCAL)
    del ids
    for kind in (0, 1):
        mine = []
        for r in range(3):
            mine.append(np.concatenate(keys[kind][r]))
            keys[kind][r] = []
        for lot in range(_LOTS):
            found = [textops.unique_counts(k[_lot(k) == lot]) for k in mine]
            key = textops.unique_counts(np.concatenate([f[0] for f in found]))[0]
            count = np.zeros((2, len(key)), np.int64)
            for r in (0, 1):
                count[r][np.searchsorted(key, found[r][0])] = found[r][1]
            del found
            of = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)  # ascending, as the keys are
            cut = np.flatnonzero(np.diff(of)) + 1
            if len(key):
                yield _rows(
                    (
                        (int(of[lo]), block, kind, hi - lo, _pack_keys(key[lo:hi]), _pack(count[0, lo:hi] + count[1, lo:hi]), _pack(count[0, lo:hi]), 0, 0)
                        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(key)])
                    ),
                    _LOCAL,
                )


_LOTS = 8  # keys of a block are sorted in lots, which takes memory for one of them


def _lot(key: np.ndarray) -> np.ndarray:
    return key.astype("<u8", copy=False).view(np.uint8)[7::8] >> 5  # the first three bits


_FIELDS = [("block", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("train", pa.binary()), ("fold", pa.binary()), ("a", pa.int64()), ("b", pa.int64())]
_LOCAL = pa.schema([("part", pa.int32()), *_FIELDS])
_CORPUS = pa.schema([("asked", pa.bool_()), *_FIELDS])


def _rows(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by key, for every block that has it (except where the block's own counts are all there is), and totals."""
    chunks: list[list[tuple]] = [[], []]
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns[1:])):
            if row[1] < _CHECK:
                chunks[row[1]].append(row)
            else:
                yield _rows([(False, *row)], _CORPUS)
    for kind in (0, 1):
        if not chunks[kind]:
            continue
        block, _, n, keys, trains, folds, _, _ = zip(*chunks[kind])
        chunks[kind] = []
        key = np.concatenate([*map(_unpack_keys, keys, n)])
        order = np.argsort(key, kind="stable")
        key = key[order]
        # the count of one block fits 32 bits, sums may not
        train, fold_n = (np.concatenate([_unpack(x, m).astype(np.int32) for x, m in zip(packed, n)])[order] for packed in (trains, folds))
        of = np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
        del order, keys, trains, folds
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        sums, held = (np.add.reduceat(x, begin, dtype=np.int64) for x in (train, fold_n))
        if kind == 0:
            for name, a, b in ((_VOCABULARY, (sums > 0).sum(), (sums > held).sum()), (_TOKENS, sums.sum(), held.sum())):
                yield _rows([(False, 0, name, 0, None, None, None, int(a), int(b))], _CORPUS)
        use = np.flatnonzero((np.repeat(sums, size) != train) | (fold_n > 0))
        slot = (of[use] << 1) | (fold_n[use] > 0)
        del train, fold_n, of
        group = np.repeat(np.arange(len(begin), dtype=np.int32), size)[use]
        del size, use
        order = np.argsort(slot, kind="stable")
        slot, group = slot[order], group[order]
        del order
        key = key[begin]
        cut = np.flatnonzero(np.diff(slot)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(slot)]):
            if lo < hi:
                mine, asked = group[lo:hi], bool(slot[lo] & 1)
                yield _rows([(asked, block[slot[lo] >> 1], kind, hi - lo, _pack_keys(key[mine]), _pack(sums[mine]), _pack(held[mine]) if asked else None, 0, 0)], _CORPUS)
        del key, sums, held, group, slot


@dataclass
class Mixture:
    """Corpus totals and the weights (bigram, unigram, floor) of every context bucket."""

    tokens: int
    vocabulary: int
    texts: int
    weights: np.ndarray


def _bucket(context: np.ndarray) -> np.ndarray:
    """0: never seen; then by powers of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def learn_weights(bucket: np.ndarray, parts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mixture weights per bucket by expectation-maximisation: ``parts`` are the three estimates of ``n`` held-out tokens each.

    Contexts never seen have no bigram estimate. Buckets without held-out tokens take the weights of the next lower one.
    """
    weights = np.zeros((BUCKETS, 3))
    for b in range(BUCKETS):
        mine = bucket == b
        w = np.array([0.0, 0.9, 0.1]) if b == 0 else weights[b - 1] if not mine.any() else np.array([0.4, 0.5, 0.1])
        if mine.any():
            p, times = parts[mine], n[mine]
            for _ in range(_ROUNDS):
                share = p * w
                share /= share.sum(1, keepdims=True)
                w = (share * times[:, None]).sum(0) / times.sum()
            # some room for new words however few the held-out tokens are
            w = w * (1 - 1e-4) + 1e-4 * np.array([0.0, 0.0, 1.0])
        weights[b] = w
    return weights


class _Counts:
    """Lookup of corpus counts by key; keys that ascend are taken as they are."""

    def __init__(self, key: np.ndarray, *columns: np.ndarray) -> None:
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, columns = key[order], [c[order] for c in columns]
        self.key, self.columns = key, columns

    def __call__(self, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether each key is there, and its counts (0 if not)."""
        if not len(self.key):
            return np.zeros(len(key), bool), *(np.zeros(len(key), np.int64) for _ in self.columns)
        order = np.argsort(key)  # in order, the search walks through memory instead of jumping
        at = np.empty(len(key), np.int64)
        at[order] = np.minimum(np.searchsorted(self.key, key[order]), len(self.key) - 1)
        hit = self.key[at] == key
        return hit, *(np.where(hit, c[at], 0) for c in self.columns)


class _Block:
    """Texts of a block and what the corpus says of its n-grams, from rows in any order."""

    def __init__(self) -> None:
        self.docs: list[pa.RecordBatch] = []
        self.checks: list[int] = []
        self.chunks: list[list[tuple]] = [[], []]

    def counts(self, kind: int, *columns: str) -> _Counts:
        mine, self.chunks[kind] = self.chunks[kind], []
        key = np.concatenate([np.zeros(0, np.uint64), *(_unpack_keys(c["keys"], c["n"]) for c in mine)])
        return _Counts(key, *(np.concatenate([np.zeros(0, np.int64), *(_unpack(c[x], c["n"]) for c in mine)]) for x in columns))

    def texts(self) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        for batch in self.docs:
            yield from textops.chunks(batch)


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, _Block]:
    """By block; a task gets one, unless the partitions changed."""
    blocks: dict[int, _Block] = defaultdict(_Block)
    for batch in batches:
        at = batch.column(0).to_numpy(zero_copy_only=False)
        is_doc = pc.is_null(batch.column(4))
        doc = is_doc.to_numpy(zero_copy_only=False)
        docs = batch.select(["doc_id", "text", "role"])
        for b in np.unique(at[doc]).tolist():
            mine = doc & (at == b)
            blocks[b].docs.append(docs if mine.all() else docs.filter(pa.array(mine)))
        if not doc.all():
            for row in batch.select(["to", "kind", "n", "keys", "train", "fold", "a"]).filter(pc.invert(is_doc)).to_pylist():
                if row["kind"] == _CHECK:
                    blocks[row["to"]].checks.append(row["a"])
                else:
                    blocks[row["to"]].chunks[row["kind"]].append(row)
        del batch, docs
    return blocks


def _held_out(held: Mixture):
    """Held-out tokens of a block by bucket and binned estimates, the held-out counts deleted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _gathered(batches).values():
            lookup, out = [block.counts(kind, "train", "fold") for kind in (0, 1)], [np.zeros(0, np.int64)]
            for _, texts in block.texts():
                token, before, _ = tokens(texts)
                c_pair, c_token, c_context = (x[1] - x[2] for x in (lookup[1](_mix(before, token)), lookup[0](token), lookup[0](before)))
                c_context = np.where(before == START, held.texts, c_context)
                with np.errstate(divide="ignore"):
                    p2 = np.where(c_pair > 0, np.floor(np.log10(c_pair / np.maximum(c_context, 1)) / _BIN), 1)
                    p1 = np.where(c_token > 0, np.floor(np.log10(c_token / max(1, held.tokens)) / _BIN), 1)
                out.append((_bucket(c_context) << 40) | ((p2.astype(np.int64) + 2048) << 20) | (p1.astype(np.int64) + 2048))
            packed, n = textops.unique_counts(np.concatenate(out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (packed >> 40, ((packed >> 20) & 0xFFFFF) - 2048, (packed & 0xFFFFF) - 2048, n.astype(np.int64))], ["bucket", "p2", "p1", "n"]
            )

    return run


def _scores(mix: Mixture):
    """Scores of a block's texts from the corpus counts, its own where it alone has an n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _gathered(batches)
        while blocks:
            yield from _block_scores(blocks.popitem()[1], mix)

    return run


def _block_scores(block: _Block, mix: Mixture) -> Iterator[pa.RecordBatch]:
    pa.default_memory_pool().release_unused()
    ids = [i for batch in block.docs for i in batch.column(0).to_pylist()]
    if block.checks != ([_check(ids)] if ids else []):
        raise RuntimeError("the input's partitions changed between two reads; write it to a table first")
    del ids
    corpus = [block.counts(kind, "train") for kind in (0, 1)]
    own: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]]
    for part, texts in block.texts():
        token, before, begin = tokens(texts)
        training = np.repeat(part.column(2).to_numpy(zero_copy_only=False) < 2, np.diff(begin))
        for kind, keys in enumerate((token[training], _mix(before, token)[training])):
            own[kind].append(keys[~corpus[kind](keys)[0]])
    local = [_Counts(*textops.unique_counts(np.concatenate(x))) for x in own]
    del own

    def count(key: np.ndarray, kind: int) -> np.ndarray:
        hit, total = corpus[kind](key)
        rest = np.flatnonzero(~hit)
        total[rest] = local[kind](key[rest])[1]
        return total

    for part, texts in block.texts():
        token, before, begin = tokens(texts)
        c_pair, c_token = count(_mix(before, token), 1), count(token, 0)
        c_context = np.empty_like(c_token)
        c_context[1:] = c_token[:-1]
        c_context[begin[:-1]] = mix.texts
        w = mix.weights[_bucket(c_context)]
        p = w[:, 0] * c_pair / np.maximum(c_context, 1) + w[:, 1] * c_token / max(1, mix.tokens) + w[:, 2] / (mix.vocabulary + 1)
        base = np.log10((c_token + 0.1) / (mix.tokens + 0.1 * (mix.vocabulary + 1)))
        # every text has a token
        sums = [np.add.reduceat(x, begin[:-1]) for x in ((c_token > 0).astype(np.int64), base, np.log10(p))]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(begin)), *map(pa.array, sums)], _SCORED)


_SCORED = ["doc_id", "n_tokens", "n_known", "base_score", "score"]


def score(docs: DataFrame, train: Column, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``train`` (a condition over the columns of ``docs``) says which rows counts are
    learned from, ``held_out`` which of these the mixture weights are learned on.
    Null texts are empty: one end token. Rows repeated count and are scored each; a
    null condition is false. Without training rows every token has the floor
    probability. An empty table gives an empty result; extra columns are ignored.

    A partition of ``docs`` is a block of the count exchange (one of much text is
    several), so ``docs`` must have the same partitions each time it is read, as a
    table on disk has (checked: a difference is an error).
    """
    spark = docs.sparkSession
    role = F.when(F.coalesce(train, F.lit(False)), F.when(F.coalesce(held_out, F.lit(False)), 0).otherwise(1)).otherwise(2)
    rows = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), role.cast("int").alias("role"))
    volume = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()  # a row for each partition
    # rows of a block, where a partition holds more text than one should
    most = max((r[2] / r[1] for r in volume if r[2] > BLOCK_BYTES), default=0)
    block_rows = max(1, int(BLOCK_BYTES / most)) if most else 1 << 32
    ranges = max(shuffle_partitions(spark), sum(r[2] for r in volume) // RANGE_BYTES)
    # below 33 bits of it stands the place in the partition
    block = F.shiftleft(F.spark_partition_id().cast("long"), 33) + F.floor(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) / block_rows)
    rows = rows.withColumn("block", block.cast("long"))
    counts = materialize(
        rows.mapInArrow(_local_counts(ranges), "part int, " + _CHUNK).repartitionById(ranges, "part").mapInArrow(_corpus_counts, "asked boolean, " + _CHUNK),
        "ngram-counts", compression="none",
    )
    totals = {r["kind"]: (r["a"], r["b"]) for r in counts.filter(F.col("kind") > _CHECK).groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()}
    of = lambda name, i: int(totals.get(name, (0, 0))[i])
    mix = Mixture(of(_TOKENS, 0), of(_VOCABULARY, 0), of(_TEXTS, 0), np.zeros((BUCKETS, 3)))
    held = Mixture(mix.tokens - of(_TOKENS, 1), of(_VOCABULARY, 1), mix.texts - of(_TEXTS, 1), mix.weights)
    # blocks numbered one after the other, each a task: the number of the first block of every partition
    found = sorted(r[0] for r in counts.filter(F.col("kind") == _CHECK).select("block").collect())
    first = np.searchsorted(found, np.arange((found[-1] >> 33) + 1 if found else 1) << 33).tolist()
    to = F.coalesce(F.get(F.lit(first), F.shiftright("block", 33).cast("int")) + F.col("block").bitwiseAND((1 << 33) - 1).cast("int"), F.lit(0)).alias("to")

    def exchange(texts: DataFrame, chunks: DataFrame) -> DataFrame:
        """Texts and what the corpus says of their n-grams, a block in each task."""
        none = [F.lit(None).cast(t).alias(c) for c, t in (("kind", "int"), ("n", "int"), ("keys", "binary"), ("train", "binary"), ("fold", "binary"), ("a", "long"))]
        texts = texts.select(to, "doc_id", "text", "role", *none)
        chunks = chunks.select(to, F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("int").alias("role"),
                               "kind", "n", "keys", "train", "fold", "a")
        return texts.union(chunks).repartitionById(max(1, len(found)), "to")

    binned = materialize(
        exchange(rows.filter("role = 0"), counts.filter(F.col("asked") & (F.col("kind") < _CHECK)))
        .mapInArrow(_held_out(held), "bucket long, p2 long, p1 long, n long").groupBy("bucket", "p2", "p1").agg(F.sum("n").alias("n")),
        "held-out",
    ).orderBy("bucket", "p2", "p1").collect()  # bounded by the bins
    stats = np.array([tuple(r) for r in binned], np.float64).reshape(-1, 4)
    value = lambda x: np.where(x > 0, 0.0, 10.0 ** ((x + 0.5) * _BIN))  # noqa: E731  bin 1: no count
    parts = np.stack([value(stats[:, 1]), value(stats[:, 2]), np.full(len(stats), 1 / (held.vocabulary + 1))], 1)
    mix.weights = learn_weights(stats[:, 0].astype(np.int64), parts, stats[:, 3])
    scored = exchange(rows, counts.filter(F.col("kind") <= _CHECK).withColumn("fold", F.lit(None).cast("binary"))).mapInArrow(
        _scores(mix), "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(mix.tokens).cast("long"))
