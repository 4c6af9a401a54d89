"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A is a byte-level BPE (``tokenizers``), B a piece model with byte fallback
(``sentencepiece``), which puts a space before the text; A reads the text with that space.

1. Coarse cuts: A's character offsets and B's character spans give the places where a token ends
   between two characters.
2. Refining: where several tokens share a character (A splits a character's bytes, B falls back
   to bytes), the decoded bytes of the tokens place the ends within the run.
3. The decoded bytes of all tokens of a side have to be the text's bytes; a text that fails
   this on either side has no tokens.
4. Ends common to both sides cut the tokens into groups. Every stretch between two
   neighbouring ends of either side lies in one A and one B token: these pairs are the links.

Neither side has a token that reaches over a single space between two other characters: A's pattern
starts anew there, and B's pieces hold spaces at their beginning only (checked when the model
is read). So texts are cut there into units, and a unit is encoded once while a bounded cache of
recent units holds it; units that are new are encoded together, as one text.

Links are counted over the corpus by Spark. Each text then looks up its pairs: those that hold at
least 1/``HOT_PAIRS`` of all links, so at most ``HOT_PAIRS`` of them, are broadcast; all
others meet their counts in a shuffled join, in which no key has more than that share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import materialize, python_ready
from faregrid.llm.recent import Recent

HOT_PAIRS = 1 << 16
UNITS = 300_000  # units in one generation of a worker's cache
UNIT_BYTES = 64  # longer units are not kept
CHUNK_BYTES = 2 << 20
GROUP_BYTES = 1 << 12  # new units are encoded in texts of about this size: longer ones take more time a byte
_PAIR = 32  # a pair is (A id << 32) | B id


def _byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Side:
    """One tokenizer: encodes texts into ids with character spans, and knows the bytes of every id."""

    token_bytes: list[bytes]
    sizes: np.ndarray  # bytes of each token
    may_cut: bool

    def spans(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids, and first character and end of each token in space+text (in turn)."""
        raise NotImplementedError


class ByteSide(Side):
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        alphabet = _byte_alphabet()
        entries = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size(True))]
        self.token_bytes = [bytes(alphabet[c] for c in e) if all(c in alphabet for c in e) else e.encode() for e in (e or "" for e in entries)]
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.may_cut = True  # the pattern never matches over a space between letters

    def spans(self, text):
        found = self.tokenizer.encode(" " + text, add_special_tokens=False)
        ids = found.ids
        return ids, np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids))


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.may_cut = not any(re.search("[^▁]▁", p) for p in pieces)  # spaces only begin a piece

    def spans(self, text):
        found = self.model.encode(text, return_type="offset_mapping")
        ids = found["ids"]
        flat = np.fromiter(chain.from_iterable(found["offsets"]), np.int64, 2 * len(ids)) + 1
        flat[:1] = 0  # the first token begins with the space
        return ids, flat


def token_ends(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, size: np.ndarray, char_bytes: np.ndarray) -> np.ndarray:
    """Byte offset at which each token ends.

    ``begin`` and ``end`` are the tokens' character spans, ``size`` their numbers of bytes, ``char_bytes``
    the byte offset of every character and of the end.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    clean = np.ones(n, bool)  # whether the token ends between two characters
    clean[:-1] = (end[:-1] == begin[1:]) & (end[:-1] > begin[:-1])
    ends = char_bytes[np.minimum(end, len(char_bytes) - 1)].copy()
    if not clean.all():
        last = np.flatnonzero(clean)
        run = np.searchsorted(last, np.arange(n))  # run of tokens that share characters
        first = np.concatenate([[0], last[:-1] + 1])
        done = np.cumsum(size)
        start = np.where(first > 0, ends[first - 1], 0)
        ends = np.where(clean, ends, start[run] + done - (done - size)[first][run])
    return ends


def _joined(side: Side, ids: list[int]) -> bytes:
    return b"".join(map(side.token_bytes.__getitem__, ids))


def _encode(side: Side, text: str, char_bytes: np.ndarray, size_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ids, ends and joined bytes of a text's tokens."""
    ids, flat = side.spans(text)
    codes = np.array(ids, np.int64)
    return codes, token_ends(codes, flat[::2], flat[1::2], size_of[codes], char_bytes), b"".join(map(side.token_bytes.__getitem__, ids))


def align_text(text: str, a: Side, b: Side):
    """(A ids, A ends, B ids, B ends) of a text, or None if a side's bytes are not those of space+text."""
    raw = b" " + text.encode()
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    char_bytes = np.append(np.flatnonzero(lead), len(raw))
    a_ids, a_ends, a_bytes = _encode(a, text, char_bytes, a.sizes)
    b_ids, b_ends, b_bytes = _encode(b, text, char_bytes, b.sizes)
    return (a_ids, a_ends, b_ids, b_ends) if a_bytes == raw and b_bytes == raw else None


def unit_starts(raw: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where units begin in texts with a space before each: at the texts, and at single spaces between two other characters.

    Beyond ASCII, a character that shares its first bytes with a white-space character counts as one: the unit goes on.
    """
    at = np.flatnonzero(raw[1:-1] == 32) + 1
    padded = np.concatenate([np.full(3, 32, np.uint8), raw, np.full(3, 32, np.uint8)])
    p3, p2, p1, n1, n2 = (padded[at + 3 + d] for d in (-3, -2, -1, 1, 2))
    wide = lambda x, y: ((x >= 0xE1) & (x <= 0xE3)) & ((y == 0x80) | (y == 0x81) | (y == 0x9A))
    before = (p1 > 32) & ~((p1 >= 0x80) & ((p2 == 0xC2) | wide(p3, p2)))
    after = (n1 > 32) & (n1 != 0xC2) & ~wide(n1, n2)
    begins = np.zeros(len(raw), bool)
    begins[at[before & after]] = True
    begins[text_starts] = True
    return np.flatnonzero(begins)


class Aligner:
    """Both sides, and the recent units with their tokens.

    A unit's tokens are packed in one string of bytes: the number of its A tokens, then the (id, end) pairs of A and those of B,
    eight bytes each; the number alone if its bytes do not come back.
    """

    NONE = bytes(8)

    def __init__(self, a: Side, b: Side, units: int = UNITS):
        self.a, self.b = a, b
        self.cut = a.may_cut and b.may_cut
        self.recent = Recent(units)
        wide = max(len(a.token_bytes), len(b.token_bytes))
        self.names = [f"{i}{sep}" for sep in ",|;" for i in range(wide)]

    def _alone(self, unit: bytes) -> bytes:
        found = align_text(unit[1:].decode(), self.a, self.b)
        if found is None:
            return self.NONE
        pairs = [np.stack(found[i : i + 2], 1).astype("<i4").tobytes() for i in (0, 2)]
        return b"".join([len(found[0]).to_bytes(8, "little"), *pairs])

    def _together(self, units: list[bytes]) -> list[bytes]:
        """Tokens of units encoded as one text; one by one where the bytes do not come back."""
        found = align_text(b"".join(units)[1:].decode(), self.a, self.b) if len(units) > 1 else None
        if found is None:
            return [self._alone(u) for u in units]
        stops = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        upto, own, pairs = [], [], []
        for ids, ends in (found[:2], found[2:]):
            last = np.searchsorted(ends, stops, "right")
            if not np.array_equal(ends[last - 1], stops):
                raise ValueError("a token reaches over a space between two characters")
            upto.append(last)
            own.append(np.searchsorted(stops, ends))  # unit of each token
            pairs.append(ids | (ends - np.append(0, stops)[own[-1]]) << 32)
        # a unit's number stands behind all tokens of earlier units, its B tokens behind its A tokens
        n_a = np.diff(upto[0], prepend=0)
        edge = np.append(0, upto[0] + upto[1] + np.arange(1, len(units) + 1))
        flat = np.empty(edge[-1], "<i8")
        flat[edge[:-1]] = n_a
        flat[np.arange(len(pairs[0])) + np.append(0, upto[1])[own[0]] + own[0] + 1] = pairs[0]
        flat[np.arange(len(pairs[1])) + upto[0][own[1]] + own[1] + 1] = pairs[1]
        packed, edge = flat.tobytes(), (edge * 8).tolist()
        return [packed[x:y] for x, y in zip(edge, edge[1:])]

    def tokens_of(self, units: list[bytes]) -> list[bytes]:
        """The packed tokens of each unit."""
        out = list(map(self.recent.young.get, units))
        old = self.recent.old.get
        new = []
        for i in [i for i, v in enumerate(out) if v is None]:
            unit = units[i]
            found = out[i] = old(unit)
            if found is not None:
                self.recent.put(unit, found)
                old = self.recent.old.get
            elif 32 < unit[-1] < 128 and 32 < unit[min(1, len(unit) - 1)] < 128 or len(unit[1:].decode().strip()) == len(unit[1:].decode()) > 0:
                new.append(i)
            else:  # white space at its ends would run into its neighbours'
                out[i] = self._keep(unit, self._alone(unit))
                old = self.recent.old.get
        at = 0
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (stop == at or size + len(units[new[stop]]) <= GROUP_BYTES):
                size += len(units[new[stop]])
                stop += 1
            for i, v in zip(new[at:stop], self._together([units[i] for i in new[at:stop]])):
                out[i] = self._keep(units[i], v)
            at = stop
        return out

    def _keep(self, unit: bytes, tokens: bytes) -> bytes:
        if len(unit) <= UNIT_BYTES:
            self.recent.put(unit, tokens)
        return tokens

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """A ids, A ends, B ids, B ends and text ends, for texts laid one after the other with a space before each.

        Empty texts, and those whose bytes do not come back, have no tokens.
        """
        raw = np.frombuffer(b"".join(b" " + t for t in texts), np.uint8)
        size = np.array([len(t) + 1 for t in texts])
        stops = np.cumsum(size)
        starts = unit_starts(raw, stops - size) if self.cut else stops - size
        text_of = np.searchsorted(stops, starts, "right")
        offsets = np.append(starts, len(raw))
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
        coded = column.dictionary_encode()
        found = self.tokens_of(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        flat = np.frombuffer(b"".join(found), "<i8")
        size_of = np.fromiter(map(len, found), np.int64, len(found)) // 8
        head = np.cumsum(size_of) - size_of
        n_a = flat[head]
        bad = n_a == 0
        gone = np.bincount(text_of, bad[codes], len(texts)) > 0
        gone |= size == 1
        out = []
        for count, begin in ((n_a, head + 1), (size_of - 1 - n_a, head + 1 + n_a)):
            n = np.where(gone[text_of], 0, count[codes])
            done = np.cumsum(n)
            pairs = flat[np.repeat(begin[codes] - (done - n), n) + np.arange(int(n.sum()))]
            out += [pairs & 0xFFFFFFFF, (pairs >> 32) + np.repeat(starts, n)]
        return *out, stops


def group_codes(a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, groups: int, size: int) -> np.ndarray:
    """Ids of both sides, group by group: plus ``size`` for the last A id of a group, twice that for the last B id."""
    upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=groups)) for g in (a_group, b_group))  # tokens up to each group
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    place_a, place_b = np.arange(len(a_ids)), np.arange(len(b_ids))
    last_a, last_b = place_a + 1 == upto_a[a_group], place_b + 1 == upto_b[b_group]
    before_b = np.append(0, upto_b)
    # A tokens stand behind the B tokens of earlier groups, B tokens behind the A tokens up to their own group
    code[place_a + before_b[a_group]] = a_ids + size * last_a
    code[place_b + upto_a[b_group]] = b_ids + 2 * size * last_b
    return code


_LOADED: dict[tuple[str, str], Aligner] = {}  # one per Python worker and pair of models


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(ByteSide(a_path), PieceSide(b_path))
    return _LOADED[a_path, b_path]


def _ragged(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(first.astype(np.int64), values).cast(pa.list_(pa.int64()))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row, id, n_a, n_b, n_groups, n_links, groups, group_ends, pairs and times.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3``; ``group_ends`` the byte offsets in space+text where both sides end;
    ``pairs`` the distinct linked pairs (A id << 32 | B id) and ``times`` how many links each has. Null and empty texts,
    and those whose bytes a side does not give back (such as texts with U+2581), have zeros, an empty text and empty
    lists. ``row`` numbers the rows as they are read, so repeated and null ids stay apart once the table is written. An
    empty table gives an empty result; extra columns are ignored, whatever their names.
    """
    rows = python_ready(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        size, n_b = len(both.names) // 3, len(both.b.token_bytes)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts in textops.chunks(batch, limit=CHUNK_BYTES):
                n = len(texts)
                a_ids, a_ends, b_ids, b_ends, stops = both.encode(texts)
                # which bytes end a token, and how many tokens end up to each byte
                is_a, is_b = np.zeros(stops[-1] + 1, bool), np.zeros(stops[-1] + 1, bool)
                is_a[a_ends], is_b[b_ends] = True, True
                common, cuts = np.flatnonzero(is_a & is_b), np.flatnonzero(is_a | is_b)
                upto_a, upto_b, upto_common = (np.cumsum(x, dtype=np.int32) for x in (is_a, is_b, is_a & is_b))
                first_a, first_b, first_group = (np.append(0, x[stops]) for x in (upto_a, upto_b, upto_common))
                first_cut = np.append(0, np.searchsorted(cuts, stops, "right"))
                # distinct pairs of each text, by one sort over the texts
                text_of = np.repeat(np.arange(n), np.diff(first_cut))
                key = (text_of * size + a_ids[upto_a[cuts - 1]]) * n_b + b_ids[upto_b[cuts - 1]]
                key, times = textops.unique_counts(key)
                first_pair = np.searchsorted(key, np.arange(n + 1) * size * n_b)
                pairs = (key // n_b % size << _PAIR) | key % n_b
                code = group_codes(a_ids, b_ids, upto_common[a_ends - 1], upto_common[b_ends - 1], first_group[-1], size)
                spelled = list(map(both.names.__getitem__, code.tolist()))
                first = (first_a + first_b).tolist()
                groups = ["".join(spelled[x:y])[:-1] for x, y in zip(first, first[1:])]
                base = np.repeat(np.concatenate([[0], stops[:-1]]), np.diff(first_group))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column(0), *[pa.array(np.diff(f), pa.int64()) for f in (first_a, first_b, first_group, first_cut)],
                     pa.array(groups, pa.string()), _ragged(common - base, first_group), _ragged(pairs, first_pair), _ragged(times, first_pair)],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "group_ends", "pairs", "times"],
                )
                row += n

    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, group_ends array<long>, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): the links of each pair in the corpus, and whether no pair of its B id has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    # a B id has at most as many pairs as A's vocabulary has entries
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << _PAIR) - 1))))
    return materialize(counts.withColumn("best", F.col("count") == most), "pair-counts")


def score(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) for the rows of ``aligned`` with links: links that are their B id's best, and the sum of all counts."""
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).collect()[0]["n"]
    frequent = F.col("count") * hot_pairs >= F.lit(total)  # at most hot_pairs pairs can have so many
    hot, cold = counts.filter(frequent), counts.filter(~frequent)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    ]
    near = links.join(F.broadcast(hot), "pair", "left")
    by_row = near.filter("count is not null").groupBy("row").agg(*sums)
    rest = near.filter("count is null").select("row", "pair", "times").join(cold, "pair").groupBy("row").agg(*sums)
    return by_row.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_and_score(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row; see ``align`` and ``score``.

    Rows without tokens have zeros and an empty digest. Digests and pairs are written once, so texts are encoded once.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    found = align(docs, a_path, b_path, id_col, text_col).select("row", "id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"), "pairs", "times")
    aligned = materialize(found, "aligned", compression="zstd")
    scored = score(aligned, pair_counts(aligned)).withColumnRenamed("row", "_row")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.drop("pairs", "times").join(scored, F.col("row") == F.col("_row"), "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
