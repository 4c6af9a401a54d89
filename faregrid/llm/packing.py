"""Packing documents into sequences by the linear grouping scheme.

Pieces are tokenised and measured where they lie; only the histogram of lengths
(at most ``capacity`` rows) reaches the driver, where the scheme runs on it:

1. Large lengths, sorted, are dealt into groups of equal cardinality and rounded up
   to the largest of their group.
2. Configurations of these few sizes are optimised: the linear programme over all
   configurations (fewest sequences that hold all counts) is solved by column generation, a
   knapsack over the sizes finding the configuration worth adding. Each is used as often as
   the whole part of its number says.
3. Actual lengths take the places of the rounded ones; what rounding gave away is free.
4. What is left, the lengths that the fractions stood for and the small ones, goes by its
   actual length, largest first, to the fullest sequence that has room (best fit).

Equal sequences are held as one class with a count, so the work depends on the
number of distinct lengths, not of documents. The plan lists for each length which
ranks go where; pieces look up their rank within their length.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import materialize, python_ready
from faregrid.llm.recent import Recent

CAPACITY = 4096
END_ID = 1
# (groups, small): lengths of at most capacity / small are small. Tried in turn until the lower bound is met.
SCHEMES = ((24, 3), (24, 4), (48, 8), (24, 2))
_CACHE_WORDS = 150_000  # in each of two generations
_CHUNK_BYTES = 2 << 20
_TAIL = re.compile(r"[.,]$")


class WordIds:
    """Ids of white-space-delimited words, with a bounded cache of them packed in four bytes each.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words in turn. A word of letters that normalisation leaves
    as it is is one pre-token and goes to the model directly; a final full stop
    or comma after letters is a pre-token of its own.
    """

    def __init__(self, path: str):
        import unicodedata

        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.nfc = lambda w: unicodedata.is_normalized("NFC", w)
        self.cache = Recent(_CACHE_WORDS)

    def _plain(self, word: str) -> bool:
        return word.isalpha() and word == word.lower() and self.nfc(word)

    def _encode(self, word: str) -> bytes:
        if self._plain(word):
            spelled = word if word.isascii() else self.bytes.pre_tokenize_str(word)[0][0]
            return struct.pack(f"<{len(found := self.model.tokenize(spelled))}I", *(t.id for t in found))
        if _TAIL.search(word) and self._plain(word[:-1]):
            return self.packed(word[:-1]) + self.packed(word[-1])
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __getitem__(self, word: str) -> tuple[int, ...]:
        return tuple(np.frombuffer(self.packed(word), "<u4").tolist())

    def packed(self, word: str) -> bytes:
        found = self.cache.get(word)
        if found is None:
            found = self._encode(word)
            self.cache.put(word, found)
        return found


_LOADED: dict[str, WordIds] = {}  # one per Python worker and vocabulary


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def text_ids(column: pa.Array, lookup: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and where each text begins (and the end).

    A last full stop or comma after a letter is a pre-token of its own, so a word and the same word at the end of a
    sentence are looked up as one.
    """
    words = pc.ascii_split_whitespace(column)
    coded = pc.ascii_lower(words.flatten()).dictionary_encode()
    offsets = words.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    spelled, codes = coded.dictionary, coded.indices.to_numpy()
    stems = pc.replace_substring_regex(spelled, r"([a-z])[.,]$", r"\1").dictionary_encode()
    known = [*map(lookup.packed, stems.dictionary.to_pylist()), lookup.packed("."), lookup.packed(",")]
    size = np.fromiter(map(len, known), np.int64, len(known)) // 4
    flat = np.frombuffer(b"".join(known), "<u4")
    begin = np.cumsum(size) - size
    # every word is one part, or two: its stem and the stop (the last two of ``known``)
    stem = stems.indices.to_numpy().astype(np.int64)
    cut = pc.not_equal(pc.binary_length(spelled), pc.binary_length(stems.dictionary.take(stems.indices))).to_numpy(zero_copy_only=False)
    stop = np.where(pc.ends_with(spelled, ".").to_numpy(zero_copy_only=False), len(known) - 2, len(known) - 1)
    at = np.concatenate([[0], np.cumsum(1 + cut[codes])])
    part = np.empty(int(at[-1]), np.int64)
    part[at[:-1]] = stem[codes]
    two = np.flatnonzero(cut[codes])
    part[at[two] + 1] = stop[codes[two]]
    n = size[part]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(begin[part] - (ends - n), n) + np.arange(total)]
    return ids, np.concatenate([[0], ends])[at[offsets]]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth): the pieces of every row.

    Ids end with ``END_ID``; null text is empty. ``nth`` numbers the pieces of one
    length within the task that made them.
    """
    rows = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        lookup = word_ids(tokenizer_path)
        for batch in batches:
            for part, _ in textops.chunks(batch, limit=_CHUNK_BYTES):
                ids, begin = text_ids(part.column(1), lookup)
                row, piece, start, length, crc, nth = [], [], [], [], [], []
                for i in range(part.num_rows):
                    own = np.append(ids[begin[i] : begin[i + 1]], np.uint32(END_ID)).astype("<u4")
                    for j, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at : at + capacity]
                        row.append(i), piece.append(j), start.append(at), length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        nth.append(seen[len(cut)])
                        seen[len(cut)] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int64()), pa.array(nth, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long")


Runs = list[tuple[int, int]]  # (length, count)


def group_sizes(large: Runs, groups: int) -> list[Runs]:
    """Lengths, largest first, dealt into at most ``groups`` groups of equal cardinality (the last may have fewer)."""
    each = max(1, -(-sum(c for _, c in large) // groups))
    out: list[Runs] = []
    room = 0
    for length, count in sorted(large, reverse=True):
        while count:
            if not room:
                out.append([])
                room = each
            n = min(count, room)
            out[-1].append((length, n))
            count, room = count - n, room - n
    return out


def _worthiest(sizes: Sequence[int], worth: np.ndarray, capacity: int) -> tuple[float, list[int]]:
    """The configuration of greatest worth within the capacity: a knapsack, item by item."""
    best, made = np.zeros(capacity + 1), []
    while True:  # each turn allows one more item; the smallest size bounds the turns
        more, which = best.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            better = best[: capacity + 1 - size] + worth[i] > more[size:] + 1e-12
            more[size:][better] = (best[: capacity + 1 - size] + worth[i])[better]
            which[size:][better] = i
        if (which < 0).all():
            break
        best = more
        made.append(which)
    at, used = capacity, [0] * len(sizes)
    for which in reversed(made):
        if which[at] >= 0:
            used[which[at]] += 1
            at -= sizes[which[at]]
    return float(best[capacity]), used


def configurations(sizes: Sequence[int], counts: Sequence[int], capacity: int, rounds: int = 2000) -> list[tuple[float, list[int]]]:
    """[(times, number of each size)]: the fewest configurations, as real numbers, that hold all counts.

    Revised simplex with column generation; every basis on the way holds all counts, so
    stopping after ``rounds`` gives more configurations at worst.
    """
    n = len(sizes)
    patterns = [[capacity // size if i == j else 0 for j in range(n)] for i, size in enumerate(sizes)]
    need = np.array(counts, float)
    basis = np.array(patterns, float).T
    for _ in range(rounds if n else 0):
        inverse = np.linalg.inv(basis)
        worth, entering = _worthiest(sizes, np.maximum(inverse.sum(0), 0), capacity)
        if worth <= 1 + 1e-9:
            break
        step, times = inverse @ np.array(entering, float), inverse @ need
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(times, 0) / step, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        patterns[out] = entering
        basis[:, out] = entering
    times = np.linalg.solve(basis, need) if n else np.zeros(0)
    return [(float(t), p) for t, p in zip(times, patterns) if t > 1e-9]


def _take(runs: Runs, n: int) -> Runs:
    """Removes ``n`` items from the end of ``runs`` (fewer if it holds no more)."""
    out: Runs = []
    while n and runs:
        length, count = runs.pop()
        got = min(count, n)
        out.append((length, got))
        n -= got
        if count > got:
            runs.append((length, count - got))
    return out


def pack_scheme(histogram: dict[int, int], capacity: int, groups: int, small: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Classes of equal sequences: [(number of sequences, [(length, times)])] that hold every piece once."""
    limit = capacity // small
    classes: list[tuple[int, dict[int, int]]] = [(histogram[capacity], {capacity: 1})] if histogram.get(capacity) else []
    large = [(n, c) for n, c in histogram.items() if limit < n < capacity and c]
    grouped = group_sizes(large, groups)
    sizes = [g[0][0] for g in grouped]  # rounded up to the largest of the group
    stock = [list(reversed(g)) for g in grouped]
    for real, use in configurations(sizes, [sum(c for _, c in g) for g in grouped], capacity):
        times = int(real + 1e-6)
        slots = [got for i, n in enumerate(use) for _ in range(n) if (got := _take(stock[i], times))]
        while any(slots):
            slots = [s for s in slots if s]
            n = min(s[-1][1] for s in slots)
            held: dict[int, int] = defaultdict(int)
            for s in slots:
                length, count = s.pop()
                held[length] += 1
                if count > n:
                    s.append((length, count - n))
            classes.append((n, dict(held)))
    rest: dict[int, int] = {n: c for n, c in histogram.items() if n <= limit and c}
    for runs in stock:
        for length, count in runs:
            rest[length] = rest.get(length, 0) + count
    # best fit of what is left, for all sequences with the same room at once
    by_room: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)
    for n, held in classes:
        by_room[capacity - sum(k * v for k, v in held.items())].append((n, held))
    rooms = sorted(by_room)
    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                n, held = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, held = capacity, {}
                n = -(-left // (capacity // length))
            fit = room // length
            full = min(n, left // fit)
            parts = [(full, fit), (1 if full < n and left % fit and full * fit < left else 0, left - full * fit)]
            parts.append((n - full - parts[1][0], 0))
            for number, times in parts:
                if number:
                    more = {**held, length: held.get(length, 0) + times} if times else held
                    room_left = room - times * length
                    if room_left not in by_room:
                        bisect.insort(rooms, room_left)
                    by_room[room_left].append((number, more))
                    left -= number * times
    return [(n, sorted(held.items(), reverse=True)) for room in sorted(by_room) for n, held in by_room[room]]


def pack_lengths(histogram: dict[int, int], capacity: int = CAPACITY, schemes: Sequence[tuple[int, int]] = SCHEMES) -> list[tuple[int, list[tuple[int, int]]]]:
    """``pack_scheme`` with the scheme of the fewest sequences; none can have fewer than all tokens fill."""
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    found: list[tuple[int, list[tuple[int, list[tuple[int, int]]]]]] = []
    for groups, small in schemes:
        classes = pack_scheme(histogram, capacity, groups, small)
        found.append((sum(n for n, _ in classes), classes))
        if found[-1][0] <= least:
            break
    return min(found, key=lambda f: f[0])[1]


def _places(classes: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, sequences' first number, times, offset), sorted by length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for n, held in classes:
        offset = 0
        for length, times in held:
            rows.append((length, used[length], sequence, times, offset))
            used[length] += n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, schemes: Sequence[tuple[int, int]] = SCHEMES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of every row of ``docs``.

    Documents over ``capacity`` tokens are cut into pieces of it. Null, empty and
    blank texts have one piece, the end id. Rows repeated are packed each, also
    those with a null id. An empty table gives an empty result; extra columns are
    ignored. Equal lengths are interchangeable; which of them goes where follows
    the order in which they were read.
    """
    made = materialize(pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # at most capacity rows
    places = _places(pack_lengths(histogram, capacity, schemes))
    # rank within the length: pieces of earlier tasks, then the number within the task
    by_task = made.groupBy("length", "task").agg((F.max("nth") + 1).alias("n"))
    earlier = by_task.select(
        "length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before")
    )
    ranked = made.join(earlier, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    shared = docs.sparkSession.sparkContext.broadcast(places)  # grows with the capacity, not with the documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        key = (table[:, 0] << 48) | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(key, (length << 48) | rank, "right") - 1
            _, first, sequence, times, offset = table[at].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence + nth // times), pa.array(offset + nth % times * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
