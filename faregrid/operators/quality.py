"""Data-quality checks compiled into one pass over the table.

A check list (the code gate or the declarative expectation suite) becomes a
single aggregate; the foreign-key check rides along as a broadcast left join
whose misses are counted in the same aggregate. The result is a DataFrame
with one row per check (and per group, e.g. per month), which ``enforce``
turns into the blocking behaviour: the first failing check, in list order,
raises; referential integrity only warns.

NULL semantics: ``not_null`` counts NULLs; ``unique`` counts NULL as one
value (two NULLs are one duplicate); ``between`` ignores NULLs; a NULL
foreign key is an orphan.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.functions.joins import checked_broadcast
from faregrid.schemas import DISTANCE_MAX, FARE_MAX, FARE_MIN, MIN_ROWS_PER_MONTH

log = logging.getLogger(__name__)


class DataQualityFailure(Exception):
    """A blocking check failed."""


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | between | row_count | foreign_key
    column: str | None = None
    low: float | None = None
    high: float | None = None
    dim: DataFrame | None = None
    dim_column: str | None = None
    blocking: bool = True

    @property
    def name(self) -> str:
        return self.kind if self.column is None else f"{self.kind}:{self.column}"

    def threshold(self) -> str:
        if self.kind == "between":
            return f"[{self.low}, {self.high}]"
        if self.kind == "row_count":
            return f"[{int(self.low)}, {'inf' if self.high is None else int(self.high)}]"
        return "0"


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def between(column: str, low: float, high: float) -> Check:
    return Check("between", column, float(low), float(high))


def row_count(low: int, high: int | None = None) -> Check:
    return Check("row_count", None, low, high)


def foreign_key(column: str, dim: DataFrame, dim_column: str) -> Check:
    return Check("foreign_key", column, dim=dim, dim_column=dim_column, blocking=False)


def fact_gate(dim_location: DataFrame, min_rows: int = MIN_ROWS_PER_MONTH) -> list[Check]:
    """The gate run on each month of ``fact_trips``, in its fixed order."""
    return [
        not_null("trip_id"),
        not_null("tpep_pickup_datetime"),
        unique("trip_id"),
        between("fare_amount", FARE_MIN, FARE_MAX),
        between("trip_distance", 0.0, DISTANCE_MAX),
        foreign_key("pickup_location_sk", dim_location, "location_sk"),
        row_count(min_rows),
    ]


# --- fixed values: the declarative expectation suite for fact_trips --------
EXPECTATION_SUITE = {
    "expectation_suite_name": "fact_trips_suite",
    "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "trip_id"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "trip_id"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "fare_amount", "min_value": 0, "max_value": 5000}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "trip_distance", "min_value": 0, "max_value": 200}},
        {"expectation_type": "expect_table_row_count_to_be_between",
         "kwargs": {"min_value": 100000, "max_value": 50000000}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "tpep_pickup_datetime"}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "passenger_count", "min_value": 1, "max_value": 9}},
    ],
}
# ---------------------------------------------------------------------------


def compile_suite(suite: dict) -> list[Check]:
    """Expectation list -> checks, keeping the suite's order."""
    out = []
    for e in suite["expectations"]:
        kind, kw = e["expectation_type"], e.get("kwargs", {})
        if kind == "expect_column_values_to_not_be_null":
            out.append(not_null(kw["column"]))
        elif kind == "expect_column_values_to_be_unique":
            out.append(unique(kw["column"]))
        elif kind == "expect_column_values_to_be_between":
            out.append(between(kw["column"], kw["min_value"], kw["max_value"]))
        elif kind == "expect_table_row_count_to_be_between":
            out.append(row_count(kw["min_value"], kw.get("max_value")))
        else:
            raise ValueError(f"unsupported expectation {kind!r}")
    return out


def _distinct_by(df: DataFrame, column: str) -> Column:
    """What tells the values of a column apart. A sha-256 in hex travels as its 32 bytes; any other text stays as it is."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.struct(F.col(column))
    hexed = F.coalesce(F.col(column).rlike("\\A[0-9a-f]{64}\\z"), F.lit(False))
    return F.struct(F.when(hexed, F.unhex(F.col(column))).otherwise(F.col(column).cast("binary")), hexed)


def _metric(df: DataFrame, check: Check, i: int, fk_flag: dict[int, str]) -> Column:
    if check.kind == "not_null":
        return F.count_if(F.col(check.column).isNull())
    if check.kind == "unique":
        # struct() makes NULL a value of its own: total - distinct counts two NULLs as one duplicate
        return F.count(F.lit(1)) - F.count_distinct(_distinct_by(df, check.column))
    if check.kind == "between":
        return F.count_if(~F.col(check.column).between(check.low, check.high))
    if check.kind == "row_count":
        return F.count(F.lit(1))
    if check.kind == "foreign_key":
        return F.count_if(F.col(fk_flag[i]).isNull())
    raise ValueError(check.kind)


def _status(check: Check, observed: Column) -> Column:
    if check.kind == "row_count":
        ok = observed >= F.lit(int(check.low))
        if check.high is not None:
            ok = ok & (observed <= F.lit(int(check.high)))
    else:
        ok = observed == 0
    return F.when(ok, "PASS").otherwise("FAIL" if check.blocking else "WARN")


def orphans(df: DataFrame, columns: Sequence[str], dim: DataFrame, dim_column: str) -> DataFrame:
    """(column, key, rows): values of the key columns that the dimension does not have, with their number of rows.

    NULL keys are orphans too. Keys are counted before the anti join, so a hot key is one row per map task and the
    join's sides are as small as the keys are few.
    """
    known = dim.select(F.col(dim_column).alias("_known")).distinct()
    found = []
    for c in columns:
        keys = df.groupBy(F.col(c).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        lost = keys.join(known, F.col("key") == F.col("_known"), "left_anti")
        found.append(lost.select(F.lit(c).alias("column"), "key", "rows"))
    return reduce(DataFrame.unionByName, found)


def run_checks(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """All checks in one scan; returns ``[*by, check_order, check, column, observed, threshold, status]``."""
    fk_flag: dict[int, str] = {}
    for i, c in enumerate(checks):
        if c.kind == "foreign_key":
            flag = f"_fk{i}"
            keys = c.dim.select(F.col(c.dim_column).alias(flag)).distinct()
            keys = checked_broadcast(keys, flag)
            df = df.join(keys, df[c.column] == keys[flag], "left")
            fk_flag[i] = flag
    metrics = [_metric(df, c, i, fk_flag).cast("long").alias(f"m{i}") for i, c in enumerate(checks)]
    agg = df.groupBy(*by).agg(*metrics) if by else df.agg(*metrics)
    rows = [
        F.struct(
            F.lit(i + 1).alias("check_order"),
            F.lit(c.kind).alias("check"),
            F.lit(c.column).cast("string").alias("column"),
            F.col(f"m{i}").alias("observed"),
            F.lit(c.threshold()).alias("threshold"),
            _status(c, F.col(f"m{i}")).alias("status"),
        )
        for i, c in enumerate(checks)
    ]
    return agg.select(*by, F.inline(F.array(*rows)))


RESULT_COLUMNS = ("check_order", "check", "column", "observed", "threshold", "status")


def enforce(results: DataFrame, table: str = "fact_trips") -> list[dict]:
    """Raise on the first failing blocking check (in check order, per group); log warnings.

    The results are one row per check and group, so collecting them is bounded.
    """
    return enforce_rows([r.asDict() for r in results.collect()], table)


def enforce_rows(rows: list[dict], table: str = "fact_trips") -> list[dict]:
    group_cols = [c for c in (rows[0] if rows else {}) if c not in RESULT_COLUMNS]
    rows = sorted(rows, key=lambda r: (tuple(r[c] for c in group_cols), r["check_order"]))

    def where(r: dict) -> str:
        return ", ".join(f"{c}={r[c]}" for c in group_cols)

    for r in rows:
        if r["status"] == "WARN":
            log.warning("[%s] %s on %s: %s (%s)", table, r["check"], r["column"], r["observed"], where(r))
    for r in rows:
        if r["status"] == "FAIL":
            raise DataQualityFailure(
                f"[{table}] {r['check']} on {r['column']} failed: observed {r['observed']}, "
                f"expected {r['threshold']} ({where(r)})"
            )
    return rows
