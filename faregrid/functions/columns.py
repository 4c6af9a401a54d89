"""Built-in column expressions for trips."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from faregrid.schemas import TRIP_ID_PARTS, TRIP_ID_SEPARATOR


def tolerant_double(c: str | Column) -> Column:
    """String or number to double; malformed text becomes NULL instead of failing.

    ANSI mode makes a plain cast raise on ``'abc'``; ``try_cast`` keeps the
    lenient behaviour the pipeline relies on (bad rows are quarantined later).
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def tolerant_int(c: str | Column) -> Column:
    """String or number to int, going through double.

    A direct ``try_cast('2.0' as int)`` is NULL, while the lenient cast accepts
    it as 2; the double step restores that and truncates toward zero.
    """
    return tolerant_double(c).try_cast("int")


def any_null(columns: Iterable[str]) -> Column:
    """True when any of ``columns`` is NULL (one flag, reused by both sides of a split)."""
    return reduce(lambda acc, c: acc | F.col(c).isNull(), columns, F.lit(False))


def trip_duration_minutes(pickup: str, dropoff: str) -> Column:
    """Whole-second difference of the two timestamps in minutes (double)."""
    return (F.unix_timestamp(F.col(dropoff)) - F.unix_timestamp(F.col(pickup))) / 60


def trip_id(parts: Sequence[str] = TRIP_ID_PARTS) -> Column:
    """sha-256 hex of the natural key, each part rendered as text and '|'-joined.

    ``concat_ws`` skips NULL parts. Timestamp text follows the session time zone
    (sessions pin UTC); fractions are printed only when non-zero.
    """
    return F.sha2(F.concat_ws(TRIP_ID_SEPARATOR, *[F.col(p).cast("string") for p in parts]), 256)


def _month_start(year: int, month: int) -> dt.datetime:
    return dt.datetime(year, month, 1)


def _next_month(year: int, month: int) -> tuple[int, int]:
    return (year + 1, 1) if month == 12 else (year, month + 1)


def month_ranges(months: Iterable[tuple[int, int]], bound: str = "half_open") -> list[tuple[dt.datetime, dt.datetime, bool]]:
    """Turn (year, month) pairs into pickup-time ranges ``(lo, hi, hi_inclusive)``.

    ``half_open``: ``[first of month, first of next month)``; adjacent months merge
    into one range so a full year is a single predicate.
    ``reference``: ``[first of month 00:00, last day of month 00:00]`` inclusive,
    which keeps only midnight of the last day (the original bound).
    """
    ordered = sorted(set(months))
    if bound == "half_open":
        merged: list[list[dt.datetime]] = []
        for y, m in ordered:
            lo, hi = _month_start(y, m), _month_start(*_next_month(y, m))
            if merged and merged[-1][1] == lo:
                merged[-1][1] = hi
            else:
                merged.append([lo, hi])
        return [(lo, hi, False) for lo, hi in merged]
    if bound == "reference":
        out = []
        for y, m in ordered:
            last_day = _month_start(*_next_month(y, m)) - dt.timedelta(days=1)
            out.append((_month_start(y, m), last_day, True))
        return out
    raise ValueError(f"unknown period bound {bound!r}")


def in_months(ts: str, months: Iterable[tuple[int, int]], bound: str = "half_open", ts_type: str = "timestamp") -> Column:
    """Pickup-period predicate over literal timestamps, so Parquet can push it down.

    Literals take the column's own type (``timestamp`` or ``timestamp_ntz``), so
    the comparison needs no cast on the column side and stays pushable.
    """
    col = F.col(ts)

    def lit(v: dt.datetime) -> Column:
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S")).cast(ts_type)

    preds = []
    for lo, hi, inclusive in month_ranges(months, bound):
        upper = col <= lit(hi) if inclusive else col < lit(hi)
        preds.append((col >= lit(lo)) & upper)
    if not preds:
        return F.lit(False)
    return reduce(lambda a, b: a | b, preds)
