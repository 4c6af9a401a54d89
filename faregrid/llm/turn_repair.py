"""Repair of conversation structure by aligning turns to the alternating grammar.

A conversation is well formed if its role initials read ``(s?(ua)+)?``: nothing, or an
optional system turn and then user and assistant in turn. Faulty turns are found with
Spark windows; the edits come from an alignment of the turns, one letter each, to every
feasible length of the grammar string:

- Wagner-Fischer: the cheapest way to turn the turns i.. into the last r letters of the
  target, by Delete, Insert, Keep and Rerole. The last r letters are the same for every
  target length (an opening system turn apart), so one table holds the alignments to all of them.
- Ukkonen band: a cheap repair found first is the incumbent; cells whose least possible
  cost is above it are never computed.
- Backtraced audits (the edits' initials) of all lengths are compared: the cheapest, and of
  equal costs the ASCII-least, is taken. D < I < K < R at the first edit that differs decides,
  so the backtrace takes the least letter that keeps the cost.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.common import python_ready

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_INF = 1 << 60
_SPACES = " \t\n\x0b\x0c\r"
_SEEN = 20_000  # alignments that a Python worker remembers

# A turn as one letter: its role initial (s, u, a, or o for any other), upper case if it is
# truncated, and x if it has to go (blank or duplicate).
GONE = "x"


def _incumbent(turns: str) -> int:
    """Cost of a cheap repair: keep what alternates, delete the rest and a last turn without answer."""
    cost = deleted = sum(DELETE for t in turns if t == GONE)
    live = [t for t in turns if t != GONE]
    kept: list[int] = []
    opening = 0
    for t in live:
        paid = TRUNCATED if t.isupper() else 0
        kind = t.lower()
        if kind == "s" and not kept and not opening:
            opening = 1 + paid
        elif kind == "ua"[len(kept) % 2]:
            kept.append(paid)
        else:
            cost += DELETE
    if len(kept) % 2:
        kept.pop()
        cost += DELETE
    if opening:
        cost += opening - 1 if kept else DELETE
    return min(cost + sum(kept), deleted + DELETE * len(live))


def _table(turns: str, limit: int) -> list[dict[int, int]]:
    """cost[i][r]: least cost of turning the turns i.. into the last r letters of (ua)*, in the band of ``limit``."""
    n = len(turns)
    forced = sum(DELETE for t in turns if t == GONE)
    cost: list[dict[int, int]] = [{} for _ in range(n + 1)]
    live = gone = 0  # of the turns i..
    for i in range(n, -1, -1):
        if i < n:
            if turns[i] == GONE:
                gone += 1
            else:
                live += 1
        room = limit - forced  # what may be spent beside the turns that have to go
        low, high = max(0, live - room // DELETE), live + room // INSERT
        row, below = cost[i], cost[i + 1] if i < n else {}
        t = turns[i] if i < n else ""
        kind, paid = t.lower(), TRUNCATED if t.isupper() else 0
        for r in range(low, high + 1):
            best = 0 if i == n and r == 0 else _INF
            if i < n:
                best = below.get(r, _INF) + DELETE
            if r:
                best = min(best, row.get(r - 1, _INF) + INSERT)
                if i < n and t != GONE:
                    same = kind == "au"[r % 2 == 0]
                    best = min(best, below.get(r - 1, _INF) + paid + (0 if same else REROLE))
            if best + forced - DELETE * gone <= limit:  # the turns before that have to go are paid too
                row[r] = best
    return cost


def _backtrace(turns: str, cost: list[dict[int, int]], i: int, r: int) -> str:
    """The ASCII-least edits of cost ``cost[i][r]``."""
    out = []
    n = len(turns)
    while i < n or r:
        now = cost[i][r]
        if i < n and cost[i + 1].get(r, _INF) + DELETE == now:
            out.append("D")
            i += 1
            continue
        if r and cost[i].get(r - 1, _INF) + INSERT == now:
            out.append("I")
            r -= 1
            continue
        out.append("K" if turns[i].lower() == "au"[r % 2 == 0] else "R")
        i, r = i + 1, r - 1
    return "".join(out)


def align(turns: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; of equal costs the ASCII-least audit."""
    limit = _incumbent(turns)
    cost = _table(turns, limit)
    found: list[tuple[int, str]] = []
    # targets (ua)^m: every even length that the band holds
    even = {r: c for r, c in cost[0].items() if r % 2 == 0}
    least = min(even.values(), default=_INF)
    # targets s(ua)^m: turns before the system turn go, and it is kept
    openings = []
    for i, t in enumerate(turns):
        if t.lower() == "s":
            paid = DELETE * i + (TRUNCATED if t.isupper() else 0)
            openings += [(paid + c, i, r) for r, c in cost[i + 1].items() if r and r % 2 == 0]
    least = min([least, *(c for c, _, _ in openings)])
    found += [(least, _backtrace(turns, cost, 0, r)) for r, c in even.items() if c == least]
    found += [(least, "D" * i + "K" + _backtrace(turns, cost, i + 1, r)) for c, i, r in openings if c == least]
    return min(found)


@lru_cache(_SEEN)
def edits(turns: str) -> tuple[int, str, tuple[tuple[str, int, str | None], ...]]:
    """Cost, audit, and the edits in order: (initial, turn (-1: inserted), new role (null: as it is))."""
    cost, audit = align(turns)
    places = sum(a != "D" for a in audit)
    out, i, left = [], 0, places
    for a in audit:
        # the role at a place follows from the number of places from here to the end
        role = ("user" if left % 2 == 0 else "assistant") if a in "IR" else None
        out.append((a, -1 if a == "I" else i, role))
        i += a != "I"
        left -= a != "D"
    return cost, audit, tuple(out)


_EDITS = "struct<cost:long,audit:string,edits:array<struct<edit:string,turn:int,role:string>>>"


def _edits_of(codes: pd.Series) -> pd.DataFrame:
    rows = []
    for turns in codes:
        cost, audit, listed = edits(turns or "")
        rows.append((cost, audit, [{"edit": e, "turn": t, "role": r} for e, t, r in listed]))
    return pd.DataFrame(rows, columns=["cost", "audit", "edits"])


def _last_character(text: Column) -> Column:
    """The last character that is no white space (empty if there is none)."""
    kept = F.rtrim(text, F.lit(_SPACES))
    return F.when(kept == "", F.lit("")).otherwise(F.substring(kept, -1, 1))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: gaps, counts of faults, cost, audit, edits and the repaired turns.

    Turns are taken by number (nulls first), those of one number by role and text. Null roles and texts count as one
    space. A role has the initial of its first letter; an empty role has none, so it is rerolled or deleted. The first fault of a turn counts: blank (no
    character but white space), duplicate (role and text seen earlier in the conversation), truncated (the last such
    character is no full stop, exclamation or question mark). ``gaps``: numbers missing between the smallest and the
    largest turn (0 if all are null). ``illegal``: adjacent role initials other than su, ua and au. Rows without a
    conversation id are one conversation. Equal rows are duplicates. An empty table gives an empty result; extra
    columns are ignored, whatever their names.

    One conversation is one row of the result, so its turns have to fit in a task, as a document's text has to; only
    one letter for each turn goes to Python.
    """
    rows = python_ready(turns).select(
        F.col(conv_col).alias("c"), F.col(turn_col).cast("long").alias("n"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    order = Window.partitionBy("c").orderBy(F.asc_nulls_first("n"), "role", "text")
    same = Window.partitionBy("c", "role", "text").orderBy("at")  # clustered by "c" already: no second shuffle
    last = _last_character(F.col("text"))
    fault = (
        F.when(last == "", F.lit("blank")).when(F.col("copy") > 1, F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit(""))
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE)).when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    pair, before = F.concat(F.lag(initial).over(order), initial), F.lag("n").over(order)
    numbered = (
        rows.withColumns({
            "at": F.row_number().over(order), "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)),
            "new": F.col("n").isNotNull() & ~before.eqNullSafe(F.col("n")),  # the first row of its number
        })
        .withColumn("copy", F.row_number().over(same)).withColumn("fault", fault).withColumn("code", code)
    )
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    whole = numbered.groupBy("c").agg(
        F.coalesce(F.max("n") - F.min("n") + 1 - count(F.col("new")), F.lit(0)).cast("long").alias("gaps"),
        *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("illegal")).alias("illegal"),
        F.sort_array(F.collect_list(F.struct("at", "role", "text", "code"))).alias("turns"),
    )
    letters = F.array_join(F.transform("turns", lambda t: t["code"]), "")
    aligned = whole.withColumn("found", F.pandas_udf(_edits_of, _EDITS)(letters))
    kept = F.filter("found.edits", lambda e: e["edit"] != "D")
    repaired = F.transform(kept, lambda e: F.struct(
        F.coalesce(e["role"], F.get(F.col("turns"), e["turn"])["role"]).alias("role"),
        F.when(e["turn"] < 0, F.lit("")).otherwise(F.get(F.col("turns"), e["turn"])["text"]).alias("text"),
    ))
    return aligned.select(
        F.col("c").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", F.col("found.cost").alias("cost"),
        F.col("found.audit").alias("audit"), F.col("found.edits").alias("edits"), repaired.alias("repaired"),
    )


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with a fault put in by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats the row, 4
    makes it the user's; all others stay. Nulls count as one space in the key, in roles and in texts.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    kept = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    twice = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return kept.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(twice).alias("copy")
    ).drop("copy")


def repair_all(turns: DataFrame, damaged: DataFrame) -> DataFrame:
    """``repair`` of ``damaged`` for every conversation of ``turns``, with the digest of the repaired turns.

    Conversations without a row left have zeros, an empty audit and the digest of nothing.
    """
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    fixed = repair(damaged).select("conv_id", *names, "audit", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"))
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    joined = every.join(fixed, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
