"""Reporting questions over the gold tables.

1. How does daily revenue trend over time by borough?  (pivot date x borough)
2. Which hours have the most trips in a borough?       (sum per hour)
3. How does the average fare change with distance?     (10 equal-width bins)

Only the small answers ever reach the driver; the inputs stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions.joins import checked_broadcast
from faregrid.schemas import (
    REPORT_DEFAULT_BOROUGHS,
    REPORT_DISTANCE_BINS,
    REPORT_DISTANCE_HIGH,
    REPORT_DISTANCE_LOW,
)


def boroughs(df: DataFrame, column: str = "pickup_borough") -> DataFrame:
    """Distinct non-NULL boroughs, sorted (the picker list)."""
    return df.select(column).na.drop().distinct().orderBy(column)


def default_boroughs(df: DataFrame, n: int = REPORT_DEFAULT_BOROUGHS, column: str = "pickup_borough") -> list[str]:
    """The first ``n`` boroughs in sorted order: the default selection (at most ``n`` values collected)."""
    return [r[0] for r in boroughs(df, column).limit(n).collect()]


def revenue_by_borough(daily: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """Pivot ``pickup_date`` x selected boroughs, summing revenue; an empty cell is NULL.

    Dates appear only if a selected borough has revenue that day.
    """
    if selected is None:
        selected = default_boroughs(daily)
    selected = list(selected)
    if not selected:  # nothing to show: an empty frame with the date column
        return daily.select("pickup_date").filter(F.lit(False))
    return (
        daily.filter(F.col("pickup_borough").isin(selected))
        .groupBy("pickup_date")
        .pivot("pickup_borough", selected)
        .agg(F.sum("revenue"))
    )


def peak_hours(hourly: DataFrame, borough: str | None = None) -> DataFrame:
    """Trips per pickup hour in one borough (default: the first borough), sorted by hour."""
    if borough is None:
        first = default_boroughs(hourly, 1)
        borough = first[0] if first else None
    return (
        hourly.filter(F.col("pickup_borough") == F.lit(borough))
        .groupBy("pickup_hour")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("pickup_hour")
    )


def bin_edges(lo: Column, hi: Column, bins: int = REPORT_DISTANCE_BINS) -> Column:
    """The ``bins + 1`` edges of equal-width, right-closed bins over ``[lo, hi]``, as an array.

    The lowest edge lies 0.1 % of the range below ``lo``, so that ``lo`` itself is inside; where both
    extremes are equal, both are moved by 0.1 % of the value (0.001 for zero). NULL extremes give NULL.
    """
    same = lo == hi
    room = F.when(same, F.when(lo != 0, 0.001 * F.abs(lo)).otherwise(F.lit(0.001))).otherwise(F.lit(0.0))
    first, last = lo - room, hi + room
    inner = [F.lit(float(i)) * ((last - first) / bins) + first for i in range(1, bins)]
    lowest = F.when(same, first).otherwise(first - (last - first) * 0.001)
    return F.when(lo.isNotNull(), F.array(lowest, *inner, last))


def _rounded(edge: Column, digits: Column) -> Column:
    """``edge`` to ``digits`` decimals; below one in size, to as many digits behind its leading zeros."""
    small = (edge != 0) & (F.abs(edge) < 1)
    scale = F.pow(F.lit(10.0), digits + F.when(small, -F.floor(F.log10(F.abs(edge))) - 1).otherwise(F.lit(0)))
    return F.rint(edge * scale) / scale


def _number(x: Column) -> Column:
    """A number as it is usually printed: 0.0008 and 6e-05, where a cast gives 8.0E-4 and 6.0E-5."""
    text = x.cast("string")
    plain = F.regexp_replace(x.cast("decimal(38,20)").cast("string"), "0+$", "")
    short = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E-", "e-"), r"e-(\d)$", "e-0$1")
    return F.when((x == 0) | (F.abs(x) >= 1e-3), text).when(F.abs(x) >= 1e-4, plain).otherwise(short)


def bin_labels(edges: Column, bins: int = REPORT_DISTANCE_BINS) -> Column:
    """Interval texts such as ``(0.951, 5.9]``, in the fewest digits (three or more) that keep all edges apart."""

    def shown(digits: Column) -> Column:
        return F.transform(edges, lambda e: _rounded(e, digits))

    enough = F.filter(F.sequence(F.lit(3), F.lit(19)), lambda d: F.size(F.array_distinct(shown(d))) == bins + 1)
    ends = shown(F.coalesce(F.get(enough, F.lit(0)), F.lit(3)))
    labels = F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)),
        lambda i: F.concat(F.lit("("), _number(F.get(ends, i)), F.lit(", "), _number(F.get(ends, i + 1)), F.lit("]")),
    )
    return F.when(edges.isNotNull(), labels)


def distance_histogram(
    fact: DataFrame, locations: DataFrame, low: float = REPORT_DISTANCE_LOW, high: float = REPORT_DISTANCE_HIGH
) -> DataFrame:
    """Fares and trips per distance, over trips with ``low < distance < high``: the one pass over the fact.

    ``pickup_borough`` comes from the location dimension (the fact has only the
    surrogate key); rows with a NULL distance, fare or borough are dropped.
    Distances are metered in hundredths of a mile, so there are few.
    """
    loc = checked_broadcast(
        locations.select(F.col("location_sk").alias("pickup_location_sk"), F.col("borough").alias("pickup_borough")),
        "pickup_location_sk",
    )
    return (
        fact.select("trip_distance", "fare_amount", "pickup_location_sk")
        .filter((F.col("trip_distance") > low) & (F.col("trip_distance") < high))
        .join(loc, on="pickup_location_sk", how="left")
        .na.drop(subset=["trip_distance", "fare_amount", "pickup_borough"])
        .groupBy("trip_distance")
        .agg(F.sum("fare_amount").alias("fares"), F.count(F.lit(1)).alias("trips"))
    )


def fare_by_bin(histogram: DataFrame, bins: int = REPORT_DISTANCE_BINS) -> DataFrame:
    """Average fare per equal-width bin over the observed [min, max] distance; empty bins are omitted.

    One plan: the edges and labels come from a scalar subquery over the histogram, so nothing runs
    until the result is asked for. A value on an edge lies in the lower bin. No row for an empty histogram.
    """
    lo, hi = F.min("trip_distance"), F.max("trip_distance")
    edges = histogram.agg(lo.alias("lo"), hi.alias("hi")).select(bin_edges(F.col("lo"), F.col("hi"), bins).alias("edges"))
    grid = edges.select(F.struct("edges", bin_labels(F.col("edges"), bins).alias("labels"))).scalar()
    below = F.filter(F.slice(F.col("grid.edges"), 2, bins - 1), lambda e: e < F.col("trip_distance"))
    return (
        histogram.withColumn("grid", grid)
        .groupBy((F.size(below) + 1).alias("bucket"))
        .agg((F.sum("fares") / F.sum("trips")).alias("fare_amount"), F.first("grid.labels").alias("labels"))
        .select("bucket", F.element_at("labels", F.col("bucket")).alias("distance_bucket"), "fare_amount")
        .orderBy("bucket")
    )


def fare_by_distance(fact: DataFrame, locations: DataFrame, bins: int = REPORT_DISTANCE_BINS) -> DataFrame:
    """``fare_by_bin`` of the fact's ``distance_histogram``; callers that keep the histogram read the fact once."""
    return fare_by_bin(distance_histogram(fact, locations), bins)
