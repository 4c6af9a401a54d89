"""Near-duplicate vectors over an inverted multi-index.

Unit vectors are cut in two halves, each with a codebook of its own; a vector's
cell is the pair of its nearest codewords. A linked pair may lie in different
cells, so every vector also visits neighbouring cells, nearest first: codewords
of each half are ordered by how far the vector would have to move to fall to
them, and pairs are visited in the order of the squared sum of both, until the
target recall. The distance at which to stop is learned from sample vectors moved
to exactly the threshold: it is the one that finds ``recall`` of them. What meets
in a cell is verified by cosine in double precision.

Equal vectors of a label are one class with a count. A class is sent once to each
row of cells (those of one codeword of the first half) that it visits, with the
list of its cells, so the vectors sent don't grow with the number of cells. Rows
with many classes are dealt into blocks, and blocks meet in pairs; from each pair
come link counts and the edges of a spanning forest, never the list of its pairs.
The rows go through the exchange in rounds, so that disk holds a few copies of the
vectors at a time.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.llm.common import materialize, python_ready, shuffle_partitions
from faregrid.llm.components import connected_components

MIN_COSINE = 0.98
RECALL = 0.995
FIT_ROWS = 8192
CELL_ROWS = 16  # classes per cell that the codebook size aims at
MAX_CODEWORDS = 256
BLOCK_ROWS = 256  # or twice the mean of a row of cells, if that is more
ROUND_COPIES = 2  # of the classes, in the exchange at once
TASK_ROWS = 32_768
_TILE = 256
_SEED = 5


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    reach: float  # squared distance up to which cells are visited

    @property
    def half(self) -> int:
        return self.books[0].shape[1]

    @functools.cached_property
    def between(self) -> list[np.ndarray]:
        """Distances of the codewords of each half."""
        return [np.sqrt(((book[:, None, :] - book[None]) ** 2).sum(-1)) for book in self.books]

    def far(self, unit: np.ndarray) -> list[np.ndarray]:
        """Squared distance of each vector's halves from the codewords, less the square of the half."""
        return [(book**2).sum(1) - 2 * part @ book.T for part, book in zip((unit[:, : self.half], unit[:, self.half :]), self.books)]

    def moves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance that each vector must move, in each half, to fall to each codeword."""
        out = []
        for far, between in zip(self.far(unit), self.between):
            near = far.argmin(1)
            gap = far - far[np.arange(len(far)), near][:, None]
            apart = between[near]
            out.append(np.divide(gap, 2 * apart, out=np.zeros_like(gap), where=apart > 0) ** 2)
        return out[0], out[1]

    def homes(self, unit: np.ndarray) -> np.ndarray:
        a, b = (far.argmin(1) for far in self.far(unit))
        return a * len(self.books[1]) + b

    def within(self, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector the moves up to ``reach`` in order, with their codewords; infinite behind the last."""
        row, word = np.nonzero(moves <= self.reach)
        far = moves[row, word]
        order = np.lexsort((far, row))
        count = np.bincount(row, minlength=len(moves))
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        sorted_moves = np.full((len(moves), count.max(initial=0) + 1), np.inf)
        words = np.zeros(sorted_moves.shape, np.int64)
        sorted_moves[row, place], words[row, place] = far[order], word[order]
        return sorted_moves, words

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, cell) for every cell that a vector visits, by a multi-sequence traversal.

        Each vector goes from its nearest pair of codewords to the next nearest one on the
        front of the sorted grid, and stops at the first beyond ``reach``; all vectors step at once.
        """
        (a, word_1), (b, word_2) = map(self.within, self.moves(unit))
        depth = np.zeros(a.shape, np.int64)  # of each row of the sorted grid: the first column not yet visited
        live, rows, cells = np.arange(len(unit)), [], []
        while len(live):
            ahead = a[live] + b[live[:, None], depth[live]]
            i = ahead.argmin(1)  # of equal ones the first: a row never gets ahead of the one before it
            near = ahead[np.arange(len(live)), i] <= self.reach
            live, i = live[near], i[near]
            rows.append(live)
            cells.append(word_1[live, i] * len(self.books[1]) + word_2[live, depth[live, i]])
            depth[live, i] += 1
        return np.concatenate(rows), np.concatenate(cells)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    book = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        far = (book**2).sum(1)[None] - 2 * x @ book.T
        near = far.argmin(1)
        count = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, x)
        book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
    return np.unique(book, axis=0)


def fit_index(sample: np.ndarray, n_classes: int, min_cosine: float, recall: float) -> Index:
    """Codebooks and reach from unit vectors; both depend on the sample only and the number of classes."""
    rng = np.random.default_rng(_SEED)
    half = sample.shape[1] // 2
    k = int(np.clip(round(np.sqrt(n_classes / CELL_ROWS)), 1, MAX_CODEWORDS))
    index = Index((_kmeans(sample[:, :half], k, rng), _kmeans(sample[:, half:], k, rng)), 0.0)
    # copies moved to exactly the threshold, in a random direction
    some = sample[rng.choice(len(sample), min(2048, len(sample)), replace=False)]
    noise = rng.standard_normal(some.shape)
    noise -= (noise * some).sum(1)[:, None] * some
    norm = np.linalg.norm(noise, axis=1)[:, None]
    moved = np.where(norm > 0, min_cosine * some + np.sqrt(1 - min_cosine**2) * noise / np.where(norm > 0, norm, 1), some)
    cells = index.homes(moved)
    first, second = index.moves(some)
    at = np.arange(len(some))
    need = first[at, cells // len(index.books[1])] + second[at, cells % len(index.books[1])]
    index.reach = float(np.quantile(need, recall)) + 1e-12
    return index


def _units(vectors) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of equal length without null components, one a row."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _routes(index: Index, bare: bool):
    """A row for each row of cells that a class visits; ``bare`` ones have what it takes to count them."""
    width = len(index.books[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                unit = _units(_matrix(part.column(2)))
                row, cell = index.visits(unit)
                order = np.lexsort((cell, row))
                row, cell = row[order], cell[order].astype(np.int32)
                home = index.homes(unit).astype(np.int32)
                at = np.flatnonzero(np.diff(row * len(index.books[0]) + cell // width, prepend=-1))
                of, to = row[at], cell[at] // width
                is_home = pa.array(home[of] // width == to)
                if bare:
                    yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(of)), pa.array(to), is_home], ["tag", "to", "home"])
                    continue
                ends = np.searchsorted(row, np.arange(len(unit) + 1)).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell))
                columns = [*part.columns, pa.array(home), cells]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(of)) for c in columns), pa.array(to), is_home], _ROUTED)

    return run


_ROUTED = ["class", "tag", "vec", "n", "at", "cells", "to", "home"]


def _least(linked: np.ndarray) -> np.ndarray:
    """Component number of each column and row of a bipartite link matrix (rows first), -1 without links."""
    rows, cols = linked.shape
    label = np.arange(rows + cols)
    while True:
        to_rows = np.where(linked, label[None, rows:], rows + cols).min(1, initial=rows + cols)
        new_rows = np.minimum(label[:rows], to_rows)
        to_cols = np.where(linked, new_rows[:, None], rows + cols).min(0, initial=rows + cols)
        new = np.concatenate([new_rows, np.minimum(label[rows:], to_cols)])
        if (new == label).all():
            break
        label = new
    has = np.concatenate([linked.any(1), linked.any(0)])
    return np.where(has, label, -1)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each pair of blocks, which come one after the other."""

    def pieces() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in _KEY]
            new = np.zeros(batch.num_rows - 1, bool)
            for key in keys:
                new |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            cut = (np.flatnonzero(new) + 1).tolist()
            for lo, hi in zip([0, *cut], [*cut, batch.num_rows]):
                yield tuple(key[lo].as_py() for key in keys), batch.slice(lo, hi - lo)

    for _, group in itertools.groupby(pieces(), lambda x: x[0]):
        yield pa.Table.from_batches([piece for _, piece in group])


_KEY = ["tag", "to", "home_block", "probe_block"]
_HOME, _PROBE = 1, 2  # the roles of a class in a pair of blocks, or both


def _verify(index: Index, min_cosine: float):
    """Links of a pair of blocks: probes, and vectors at home in the cells that these visit."""
    width = len(index.books[1])
    grid = width * len(index.books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            table = table.combine_chunks()
            name, n, at, role = (table.column(c).to_numpy() for c in ("class", "n", "at", "role"))
            homes = np.flatnonzero(role & _HOME)
            probes = np.flatnonzero(role & _PROBE)
            if not len(homes) or len(probes) < 1 + (len(homes) == 1 and name[probes[0]] == name[homes[0]]):
                continue
            unit = _units(_matrix(table.column("vec").chunk(0)))
            cells = table.column("cells").chunk(0)
            cell, row = cells.flatten().to_numpy(), np.repeat(np.arange(len(name)), cells.value_lengths().to_numpy())
            visited = row * grid + cell  # ascending
            here = cell // width == table.column("to")[0].as_py()
            seen = np.zeros((len(name), width), bool)
            seen[row[here], cell[here] % width] = True
            homes = homes[np.argsort(at[homes], kind="stable")]
            links = np.zeros(len(name), np.int64)
            edges = []
            for lo in range(0, len(homes), _TILE):
                y = homes[lo : lo + _TILE]
                x = probes[seen[probes][:, np.unique(at[y] % width)].any(1)]
                i, j = np.nonzero(unit[x] @ unit[y].T >= min_cosine)
                i, j = x[i], y[j]
                use = (name[i] != name[j]) & seen[i, at[j] % width]
                i, j = i[use], j[use]
                if not len(i):
                    continue
                # a pair met from both sides counts for the probe here, else for both
                wanted = j * grid + at[i]
                once = visited[np.minimum(np.searchsorted(visited, wanted), len(visited) - 1)] != wanted
                np.add.at(links, i, n[j])
                np.add.at(links, j[once], n[i[once]])
                (xs, i), (ys, j) = (np.unique(k, return_inverse=True) for k in (i, j))
                linked = np.zeros((len(xs), len(ys)), bool)
                linked[i, j] = True
                nodes = np.concatenate([xs, ys])
                edges.append(np.stack([name[nodes], name[nodes[_least(linked)]]]))
            if edges:
                own, to = np.unique(np.concatenate(edges, 1), axis=1)
                has = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in ((own, name[has]), (to, name[has]), (np.zeros(len(own), np.int64), links[has]))], ["class", "to", "links"]
                )

    return run


def _digest(vec: str) -> Column:
    return F.xxhash64(vec)


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL, fit_rows: int = FIT_ROWS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors of equal, non-null label and equal length are compared. Null, empty and
    zero vectors, and those with null or non-finite components, link with nothing.
    ``n_links`` counts the other rows linked directly (copies too); ``component_id``
    is the smallest vec_id reachable, of a row without links its own; ``kept`` marks
    the rows whose id is that. Null ids take no part in the minimum. Rows repeated
    are rows of their own. An empty table gives an empty result; extra columns are
    ignored. Codebooks are fitted on at most ``fit_rows`` classes (smallest seeded
    hash) and every class is indexed.
    """
    floats = isinstance(vectors.schema["embedding"].dataType, T.ArrayType) and isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    vec = F.col("embedding").cast("array<float>" if floats else "array<double>")
    fine = F.col("label").isNotNull() & F.coalesce(
        (F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0),
        F.lit(False),
    )
    rows = python_ready(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), vec.alias("vec")).withColumn("fine", fine)
    # adding zero makes -0.0 equal to 0.0
    zero = F.lit(0.0).cast("float" if floats else "double")
    good = rows.filter("fine").select("vec_id", "label", F.transform("vec", lambda v: v + zero).alias("vec")).withColumn("h", _digest("vec"))
    classes = materialize(
        good.groupBy("label", "h", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id()), "vector-classes",
    )
    sizes = [r[0] for r in classes.select(F.size("vec")).distinct().limit(1001).collect()]
    if len(sizes) > 1000:
        raise ValueError("vectors of more than 1000 different lengths")
    found = None
    for size in sorted(sizes):  # usually one
        part = classes.filter(F.size("vec") == size).select("class", F.col("label").cast("string").alias("tag"), "vec", "n")
        sample = part.orderBy(F.xxhash64(F.col("vec").cast("array<double>"), F.lit(_SEED)), "class").limit(fit_rows).select("vec").collect()  # at most fit_rows
        n_classes = part.count()
        index = fit_index(_units([r["vec"] for r in sample]), n_classes, min_cosine, recall)
        met = _links(part, n_classes, index, min_cosine, block_rows)
        found = met if found is None else found.union(met)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    members = connected_components(found.select("class", "to"))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    # the hash tells the classes of a label apart, but for vectors that differ and share it
    clash = classes.groupBy("label", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() > 0
    key = ["label", "h", "vec"] if clash else ["label", "h"]
    named = classes.join(members, classes["class"] == members.node, "left").select(
        classes["class"], *key, "n", "least", F.coalesce("component", classes["class"]).alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    told = materialize(
        named.join(least, "component").join(links, "class", "left")
        .select(*key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "vector-components",
    )
    linked = good.join(told, key).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, n_classes: int, index: Index, min_cosine: float, block_rows: int) -> DataFrame:
    """(class, to, links): link counts and spanning edges of all pairs of blocks that meet.

    A row of cells with more probes or homes than a block holds is dealt into blocks; every
    pair of blocks has a key of its own, so no task gets a whole row of many. The pairs go
    through the exchange in rounds of about ``ROUND_COPIES`` times the classes.
    """
    counts = materialize(
        classes.mapInArrow(_routes(index, True), "tag string, to int, home boolean").groupBy("tag", "to")
        .agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("probes")), "cell-rows",
    )
    block = F.greatest(F.lit(block_rows), F.floor(2 * F.sum("probes") / F.count(F.lit(1)))).cast("long")
    block_rows = counts.agg(block).first()[0]
    dealt = counts.withColumns({f"{side}_blocks": F.greatest(F.ceil(F.col(side) / block_rows), F.lit(1)) for side in ("homes", "probes")})
    many = F.greatest("homes_blocks", "probes_blocks") > 1
    sent = int(dealt.agg(F.sum(F.when(many, F.col("homes") * F.col("probes_blocks") + F.col("probes") * F.col("homes_blocks")).otherwise(F.col("probes")))).first()[0])
    # few, as a block holds twice the rows of the mean
    split = F.broadcast(materialize(dealt.filter(many).select("tag", "to", "homes_blocks", "probes_blocks"), "blocks"))
    rounds = max(1, math.ceil(sent / (ROUND_COPIES * n_classes)))
    vec = classes.schema["vec"].dataType.simpleString()
    routed = classes.mapInArrow(_routes(index, False), f"class long, tag string, vec {vec}, n long, at int, cells array<int>, to int, home boolean")
    place = lambda side: F.pmod(F.xxhash64("class"), F.col(side)).cast("int")
    slot = lambda home, probe, role: F.struct(home.cast("int").alias("home_block"), probe.cast("int").alias("probe_block"), role.alias("role"))
    every = lambda side: F.sequence(F.lit(0), F.col(side).cast("int") - 1)
    slots = (
        F.when(F.col("homes_blocks").isNull(), F.array(slot(F.lit(0), F.lit(0), F.when(F.col("home"), _HOME | _PROBE).otherwise(_PROBE))))
        .otherwise(F.concat(
            F.transform(every("homes_blocks"), lambda b: slot(b, place("probes_blocks"), F.lit(_PROBE))),
            F.when(F.col("home"), F.transform(every("probes_blocks"), lambda b: slot(place("homes_blocks"), b, F.lit(_HOME))))
            .otherwise(F.array().cast("array<struct<home_block:int,probe_block:int,role:int>>")),
        ))
    )
    pairs = routed.join(split, ["tag", "to"], "left").select(*_ROUTED, F.inline(slots))
    found = None
    for i in range(rounds):
        own = pairs.filter(F.pmod(F.xxhash64(*_KEY), F.lit(rounds)) == i).select("class", "vec", "n", "at", "cells", "role", *_KEY)
        tasks = max(shuffle_partitions(classes.sparkSession), sent // rounds // TASK_ROWS)
        met = materialize(
            own.repartition(tasks, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(_verify(index, min_cosine), "class long, to long, links long"), "vector-links",
        )
        found = met if found is None else found.union(met)
    return found
