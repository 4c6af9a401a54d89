"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that a
document belongs to), so the flow network has one node per pattern and source and
not per document. A pattern supplies its words once at cost 0, a second time at
cost 1 and so on (convex), up to ``max_repeats``; sources demand their targets.
The flow says how many words each pattern gives; sources without overlap need none.
Within a pattern every document is taken the same whole number of times, and the rest
goes to documents in a seeded order. The last documents are chosen by their sizes, so that
their words add up to what is left (a subset sum over the histogram of sizes), and within
a size by seed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import fresh_names, materialize, python_ready

MAX_PATTERNS = 10_000  # overlapping patterns of the flow network on the driver; also the rows of a broadcast table
SEED = 7
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2
LAST = 32  # about so many documents of a pattern are chosen by size
LAST_WORDS = 1 << 18  # words that they have at most


def source_targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words each source should give: ``share`` of all words by weight, at most ``cap`` times the source.

    Sources sorted by code point, null last, weigh ``weights`` in turn. What is over
    a cap is shared again by weight among the others until none is above.
    """
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    target: dict[str | None, float] = {}
    left, open_ = share * sum(sizes.values()), list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


def min_cost_flow(supply: Sequence[int], members: Sequence[Sequence[int]], demand: Sequence[int],
                  max_repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Words that pattern p gives to source s, as [{s: words}], meeting as much demand as can be, at least cost.

    The n-th use of a pattern's words costs n-1 a word. Successive shortest paths
    with potentials; capacities move whole words, so paths saturate an arc each and
    their number depends on patterns and sources only.
    """
    n_p, n_s = len(supply), len(demand)
    start, sink = 0, 1 + n_p + n_s
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, cap, cost = [], [], []

    def arc(a: int, b: int, c: int, w: int) -> None:
        for x, y, k, v in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y), cap.append(k), cost.append(v)

    for p in range(n_p):
        for r in range(max_repeats):
            arc(start, 1 + p, supply[p], r)
        for s in members[p]:
            arc(1 + p, 1 + n_p + s, supply[p] * max_repeats, 0)
    for s in range(n_s):
        arc(1 + n_p + s, sink, demand[s], 0)
    potential = [0] * (sink + 1)
    while True:
        far, via = {start: 0}, {}
        heap, done = [(0, start)], set()
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            for e in graph[x]:
                if cap[e] and (nd := d + cost[e] + potential[x] - potential[to[e]]) < far.get(to[e], 1 << 60):
                    far[to[e]], via[to[e]] = nd, e
                    heapq.heappush(heap, (nd, to[e]))
        if sink not in far:
            break
        for x in range(sink + 1):
            potential[x] += min(far.get(x, far[sink]), far[sink])
        path, x = [], sink
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(cap[e] for e in path)
        for e in path:
            cap[e] -= push
            cap[e ^ 1] += push
    return [
        {to[e] - 1 - n_p: cap[e ^ 1] for e in graph[1 + p] if to[e] > n_p and to[e] != sink and cap[e ^ 1] > 0} for p in range(n_p)
    ]


def pattern_supply(words: Sequence[int], members: Sequence[Sequence[int]], demand: Sequence[int], max_repeats: int = MAX_REPEATS) -> list[int]:
    """Words that each pattern gives. Patterns of one source that is in no other pattern give what it asks for, up to
    ``max_repeats`` times their words; the others share a flow network of at most ``MAX_PATTERNS`` patterns."""
    shared = {s for m in members if len(m) > 1 for s in m}
    alone = [len(m) == 1 and m[0] not in shared for m in members]
    given = [min(demand[m[0]], max_repeats * w) if own else 0 for w, m, own in zip(words, members, alone)]
    rest = [i for i, own in enumerate(alone) if not own]
    if len(rest) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of overlapping sources")
    used = sorted({s for i in rest for s in members[i]})
    place = {s: k for k, s in enumerate(used)}
    flow = min_cost_flow([words[i] for i in rest], [[place[s] for s in members[i]] for i in rest], [demand[s] for s in used], max_repeats)
    for i, f in zip(rest, flow):
        given[i] = sum(f.values())
    return given


def fill(sizes: Sequence[int], counts: Sequence[int], gap: int) -> list[int]:
    """How many of each size to take so that their sum is as near to ``gap`` as can be (of two, the lesser sum).

    Sizes are tried in order until ``gap`` is reached; counts go in as powers of two, each used once.
    """
    top = max(0, 2 * gap - 1)  # a larger sum is no better than none
    reached, made = np.zeros(top + 1, bool), np.full(top + 1, -1, np.int64)
    reached[0], lots = True, []
    for i, (size, count) in enumerate(zip(sizes, counts)):
        lot = 1
        while count and lot * size <= top and not reached[gap]:
            lot = min(lot, count)
            step = lot * size
            if step > top:
                break
            new = np.flatnonzero(reached[: top + 1 - step] & ~reached[step:]) + step
            reached[new], made[new] = True, len(lots)
            lots.append((i, lot))
            count, lot = count - lot, lot * 2
    at = np.flatnonzero(reached)
    best, taken = int(at[np.argmin(np.abs(at - gap))]), [0] * len(sizes)
    while best:
        i, lot = lots[made[best]]
        taken[i] += lot
        best -= lot * sizes[i]
    return taken


def word_sizes(docs: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``size``: the number of words of the text (null: 0)."""
    rows = python_ready(docs).select(*keep, F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch, "_text"):
                size = textops.split_words(texts).counts().astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(size)], [*part.schema.names[:-1], "size"])

    schema = rows.drop("_text").withColumn("size", F.lit(0).cast("long")).schema
    return rows.mapInArrow(run, schema)


def _order(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(seed))


def mix(sized: DataFrame, sources_col: str = "sources", id_col: str = "doc_id", size_col: str = "size",
        targets: dict[str | None, float] | None = None, max_repeats: int = MAX_REPEATS, seed: int = SEED,
        weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> tuple[DataFrame, dict, dict]:
    """``sized`` with ``taken`` (words the mix takes of the row, repeats counted), the source sizes and the targets.

    ``sources_col`` holds the array of sources of each row (null or empty: the null
    source). Rows are taken a whole number of times, at most ``max_repeats``. Of
    equal seeds the smaller id comes first; rows repeated with the same id are taken
    alike. Null and negative sizes count as 0; such rows take nothing. An
    empty table gives an empty result. At most ``MAX_PATTERNS`` patterns of sources that
    overlap (more is an error); sources without overlap have no such limit, and one
    row for each reaches the driver.
    """
    spark = sized.sparkSession
    names = F.when(F.size(F.coalesce(F.col(sources_col), F.array())) > 0, F.array_sort(F.array_distinct(F.col(sources_col)))).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    size = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0).cast("long"))
    rows = sized.withColumns({"_pattern": names, "_size": size, "_seed": _order(id_col, seed)})
    patterns = rows.groupBy("_pattern").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    patterns.sort(key=lambda r: [(s is None, s or "") for s in r["_pattern"]])
    sources: dict[str | None, int] = {}
    for r in patterns:
        for s in r["_pattern"]:
            sources[s] = sources.get(s, 0) + r["words"]
    if targets is None:
        targets = source_targets(sources, weights, share, max_repeats)
    listed = list(targets)
    number = {s: i for i, s in enumerate(listed)}
    supply = pattern_supply(
        [r["words"] for r in patterns], [[number[s] for s in r["_pattern"] if s in number] for r in patterns], [round(targets[s]) for s in listed], max_repeats
    )
    plan = []
    for i, (r, given) in enumerate(zip(patterns, supply)):
        times = min(given // r["words"], max_repeats) if r["words"] else 0
        rest = given - times * r["words"]
        last = min(rest, LAST_WORDS, -(-LAST * r["words"] // r["rows"]))
        plan.append((list(r["_pattern"]), i, times, rest, last, max(1, math.isqrt(r["rows"]))))
    schema = "_pattern array<string>, _no int, _times long, _rest long, _last long, _buckets long"
    few = F.broadcast if len(plan) <= MAX_PATTERNS else (lambda d: d)  # tables with a row for each pattern
    todo = few(spark.createDataFrame(plan, schema))
    # patterns are compared with their nulls: as text
    text = lambda c: F.to_json(F.struct(F.col(c).alias("p")), {"ignoreNullFields": "false"})
    dealt = rows.withColumn("_key", text("_pattern")).join(todo.withColumn("_key", text("_pattern")).drop("_pattern"), "_key", "left")
    dealt = dealt.withColumn("_bucket", F.expr("cast(floor((_seed / 18446744073709551616D + 0.5D) * _buckets) as long)")).drop("_key", "_pattern")
    # rows repeated with the same id are taken alike, so their words count together
    again = dealt.groupBy("_no", F.col(id_col).alias("_same")).agg(F.sum("_size").alias("_all"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = materialize(again.select(F.col("_no").alias("_in"), "_same", "_all"), "mix-repeated-ids")
    dealt = dealt.join(again, (F.col("_no") == F.col("_in")) & F.col(id_col).eqNullSafe(F.col("_same")), "left")
    dealt = dealt.withColumns({"_unit": F.coalesce("_all", "_size"), "_many": F.col("_all").isNotNull()})
    dealt = materialize(dealt.drop("_in", "_same", "_all"), "mix-dealt")
    taken = F.col("_size") * (F.col("_times") + F.when(_rest_of(id_col), 1).otherwise(0))
    out = dealt.join(few(_cuts(dealt, id_col, few)), "_no", "left").withColumn("taken", taken)
    return out.select(*sized.columns, "taken"), sources, targets


def _upto(seed: Column, row_id: Column, id_col: str) -> Column:
    """Whether the row is at most (seed, row_id) in the seeded order, in which null ids come first."""
    same = F.col(id_col).isNull() | (F.col(id_col) <= row_id)
    return F.coalesce((F.col("_seed") < seed) | ((F.col("_seed") == seed) & same), F.lit(False))


def _within(id_col: str) -> Column:
    """Whether the row is taken by the cuts: the first cut that is not before it is of the round that met it."""
    met = F.filter("_cuts", lambda c: _upto(c["seed"], c["id"], id_col))
    return F.coalesce(F.get(met, F.lit(0))["cap"] >= F.col("_unit"), F.lit(False))


def _rest_of(id_col: str) -> Column:
    """Whether the row is among those that get one more repeat (uses the columns of ``_cuts``)."""
    mine = F.get(F.filter("_picks", lambda c: c["unit"] == F.col("_unit")), F.lit(0))
    return (F.col("_rest") > 0) & (_within(id_col) | _upto(mine["seed"], mine["id"], id_col))


def _running(rows: DataFrame, keys: list[str], words: Column, goal: str, id_col: str) -> DataFrame:
    """Per ``keys``: the last (seed, id) in the seeded order up to which ``words`` of the units sum to at most ``goal``, and the sum.

    The running sum goes over buckets of the order first, then over the units of the one bucket in which the goal
    lies. A pattern of n rows has about sqrt(n) buckets, so neither sum has more than about sqrt(n) rows in a group.
    Where no unit of that bucket fits, the end lies before the bucket's first seed.
    """
    order = Window.partitionBy(*keys).orderBy("_bucket")
    buckets = rows.groupBy(*keys, "_bucket", goal).agg(F.sum(words).alias("_words"))
    edge = (
        buckets.withColumn("_before", F.sum("_words").over(order) - F.col("_words")).filter(F.col("_before") <= F.col(goal))
        .groupBy(*keys).agg(F.max(F.struct("_bucket", "_before")).alias("_e"))
        .select(*keys, F.col("_e._bucket").alias("_bucket"), F.col("_e._before").alias("_before"))
    )
    units = rows.join(edge, [*keys, "_bucket"]).groupBy(*keys, goal, "_before", "_seed", F.col(id_col).alias("_id")).agg(F.sum(words).alias("_words"))
    running = Window.partitionBy(*keys).orderBy("_seed", "_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        units.withColumn("_sum", F.col("_before") + F.sum("_words").over(running)).groupBy(*keys, "_before")
        .agg(F.max(F.when(F.col("_sum") <= F.col(goal), F.struct("_sum", "_seed", "_id"))).alias("_l"), F.min("_seed").alias("_first"))
        .select(*keys, F.coalesce("_l._sum", "_before").alias("_sum"), F.coalesce(F.col("_l._seed"), F.col("_first") - 1).alias("_seed"), F.col("_l._id").alias("_id"))
    )


def _fill_sizes(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["_seed", "_unit"])  # sizes in the order of their first unit
    taken = fill(group["_unit"].tolist(), group["_units"].tolist(), int(group["_gap"].iloc[0]))
    out = pd.DataFrame({"_no": group["_no"], "_unit": group["_unit"], "_more": np.array(taken, np.int64)})
    return out[out["_more"] > 0]


def _cuts(dealt: DataFrame, id_col: str, few: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Per pattern with a rest: the cuts of its seeded prefix, and for each size of the last documents where they end.

    The prefix takes units in the seeded order while they leave at least ``_last`` words. Where a very long unit ends
    it early, it goes on once behind that unit with those of at most ``LAST_WORDS``. The gap, at most about
    ``2 * LAST_WORDS``, is filled by a subset sum over the histogram of sizes not taken yet, which has at most twice as
    many sizes as the gap has words; of a size the first units by seed are taken.
    """
    spark = dealt.sparkSession
    asked = dealt.filter("_rest > 0 and _size > 0")
    id_type = dealt.schema[id_col].dataType.simpleString()
    cut = f"struct<cap:long,seed:long,id:{id_type}>"
    found = asked.select("_no", "_rest", "_last").distinct().collect()  # a row for each pattern
    gaps, cuts = {r["_no"]: r["_rest"] for r in found}, {r["_no"]: [] for r in found}
    open_ = {r["_no"]: (r["_last"], (1 << 62, None, None)) for r in found if r["_rest"] > r["_last"]}
    for _ in range(2):
        if open_:
            state = few(spark.createDataFrame([(no, gaps[no] - last, at) for no, (last, at) in open_.items()], f"_no int, _goal long, _at {cut}"))
            left = asked.join(state, "_no").filter(~_upto(F.col("_at.seed"), F.col("_at.id"), id_col) & (F.col("_unit") <= F.col("_at.cap")))
            ends, before, open_ = _running(left, ["_no"], F.col("_size"), "_goal", id_col).collect(), open_, {}
            for r in ends:
                last, at = before[r["_no"]]
                gaps[r["_no"]] -= r["_sum"]
                cuts[r["_no"]].append((at[0], r["_seed"], r["_id"]))
                if gaps[r["_no"]] > 2 * LAST_WORDS:
                    open_[r["_no"]] = (last, (LAST_WORDS, r["_seed"], r["_id"]))
    ends = spark.createDataFrame([(no, gaps[no], cuts[no]) for no in gaps], f"_no int, _gap long, _cuts array<{cut}>")
    left = asked.join(few(ends), "_no").filter(~_within(id_col) & (F.col("_unit") < 2 * F.col("_gap")))
    sizes = ["_no", "_gap", "_unit"]
    single = left.filter("not _many").groupBy(*sizes).agg(F.count(F.lit(1)).alias("_units"), F.min("_seed").alias("_seed"))
    many = left.filter("_many").select(*sizes, "_seed", id_col).distinct().groupBy(*sizes).agg(F.count(F.lit(1)).alias("_units"), F.min("_seed").alias("_seed"))
    histogram = single.unionByName(many).groupBy(*sizes).agg(F.sum("_units").alias("_units"), F.min("_seed").alias("_seed"))
    more = materialize(python_ready(histogram).groupBy("_no").applyInPandas(_fill_sizes, "_no int, _unit long, _more long"), "mix-fill")
    # every unit counts as one: a repeated id by its first row
    head = F.row_number().over(Window.partitionBy("_no", "_unit", id_col).orderBy("_seed")) == 1
    picked = left.join(more, ["_no", "_unit"])
    alone = picked.filter("not _many").withColumn("_head", F.lit(True))
    again = picked.filter("_many").withColumn("_head", head).filter("_head")
    picks = _running(alone.unionByName(again), ["_no", "_unit"], F.lit(1), "_more", id_col)
    listed = picks.groupBy("_no").agg(F.collect_list(F.struct(F.col("_unit").alias("unit"), F.col("_seed").alias("seed"), F.col("_id").alias("id"))).alias("_picks"))
    return ends.join(listed, "_no", "left").select("_no", "_cuts", "_picks")


def mix_by_source(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row; each document has one source (null is one of its own)."""
    sized = materialize(word_sizes(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col)),
                                   ["doc_id", "source"], text_col), "sizes")
    mixed, sources, targets = mix(sized.withColumn("sources", F.array("source")), **options)
    spark = docs.sparkSession
    rows = [(s, sources[s], float(targets[s])) for s in sources]
    known = spark.createDataFrame(rows, "source string, source_size long, target double")
    known = F.broadcast(known) if len(rows) <= MAX_PATTERNS else known
    joined = mixed.join(known, mixed.source.eqNullSafe(known.source), "left")
    return joined.select("doc_id", "size", "source_size", "target", "taken")


def repeat_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (0 times: it goes), all columns as they were.

    Rows repeated with the same id are taken alike; rows without an id are matched
    by their source. An empty table gives an empty result. Other columns may have any
    names, also those of this module.
    """
    sized = word_sizes(docs.select(F.col(id_col), F.col(source_col).cast("string").alias("source"), F.col(text_col)), [id_col, "source"], text_col)
    sized = materialize(sized, "sizes")
    mixed, _, _ = mix(sized.withColumn("sources", F.array("source")), id_col=id_col, **options)
    key, owner, times = fresh_names(docs.columns, 3)
    taken = (
        mixed.filter("size > 0").select(F.col(id_col).alias(key), F.col("source").alias(owner), (F.col("taken") / F.col("size")).cast("int").alias(times))
        .groupBy(key, owner).agg(F.max(times).alias(times)).filter(F.col(times) > 0)
    )
    found = docs.join(taken, docs[id_col].eqNullSafe(F.col(key)) & docs[source_col].cast("string").eqNullSafe(F.col(owner)))
    again = found.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return again.select(*[docs[c] for c in docs.columns])
