"""Hourly and daily trip statistics from one pass, and the rolling seven-day revenue.

Trips are reduced once to sums and counts per date, hour and borough
(``partials``: combined map-side, so a hot borough costs one row per task). Both
tables are finished from those few rows: sums add up, and a mean is a sum over
the number of non-NULL values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregrid.schemas import DAILY_MEASURES, HOURLY_MEASURES, ROLLING_DAYS

Measures = dict[str, tuple[str, str | None]]
SLOT = ("pickup_date", "pickup_hour", "pickup_borough")
DAY = ("pickup_date", "pickup_borough")


def partials(trips: DataFrame) -> DataFrame:
    """Trips, and sum and non-NULL count of every measured column, per date, hour and borough."""
    columns = sorted({c for m in (HOURLY_MEASURES, DAILY_MEASURES) for _, c in m.values() if c})
    totals = [agg(c).alias(f"{kind}:{c}") for c in columns for kind, agg in (("sum", F.sum), ("n", F.count))]
    return trips.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("trips"), *totals)


def _finished(function: str, column: str | None) -> Column:
    if column is None:
        return F.sum("trips")
    total = F.sum(f"`sum:{column}`")
    return total if function == "sum" else F.try_divide(total, F.sum(f"`n:{column}`"))


def finish(parts: DataFrame, by: tuple[str, ...], measures: Measures) -> DataFrame:
    return parts.groupBy(*by).agg(*[_finished(f, c).alias(name) for name, (f, c) in measures.items()])


def hourly_stats(trips: DataFrame) -> DataFrame:
    return finish(partials(trips), SLOT, HOURLY_MEASURES)


def daily_stats(trips: DataFrame) -> DataFrame:
    return finish(partials(trips), DAY, DAILY_MEASURES)


def rolling_revenue(daily: DataFrame, days: int = ROLLING_DAYS) -> DataFrame:
    """Sum of revenue over each day and the ``days - 1`` calendar days before it, per borough.

    Days without trips count as days (a RANGE frame over the day number); a NULL
    borough is a partition of its own.
    """
    week = Window.partitionBy("pickup_borough").orderBy(F.unix_date("pickup_date")).rangeBetween(1 - days, Window.currentRow)
    return daily.withColumn("rolling_7d_revenue", F.sum("revenue").over(week))
