"""Registered queries over the test tables (one per operator or job).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame derived by
Spark from the given tables: ``raw_trips`` and ``zones`` (see
``faregrid.sources.fixture``) feed the same operators the lake jobs use.
The processing period is every month of the input's span (read from the data),
so each query covers the whole input.

Presentation: aggregated doubles are rounded at the very end (money sums to 2
decimals, averages to 4 after a 1e-9 nudge) so results compare exactly with
another engine whose floating-point summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators import aggregate, cleansing, enrich, model, quality, reports
from faregrid.plans import jobs, metrics
from faregrid.session import checkpoint_dir
from faregrid.functions.columns import any_null, in_months, trip_id
from faregrid.schemas import DEDUP_KEYS, REQUIRED_COLUMNS, ZONE_RENAMES
from faregrid.sources import fixture, lake

# The month that the queries on a single month take (fixed value).
ONE_MONTH = (1997, 3)
# Reference time for the freshness lag (deterministic instead of "now").
FRESHNESS_AS_OF = "2002-01-01 00:00:00"


def money(c: str) -> Column:
    return F.round(F.col(c), 2).alias(c)


def mean(c: str) -> Column:
    return F.round(F.col(c) + F.lit(1e-9), 4).alias(c)


def present(df: DataFrame, money_cols=(), mean_cols=()) -> DataFrame:
    out = []
    for c in df.columns:
        if c in money_cols:
            out.append(money(c))
        elif c in mean_cols:
            out.append(mean(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def gold(df: DataFrame) -> DataFrame:
    """Materialise a small gold frame that a report reads more than once.

    A reliable checkpoint in the session's checkpoint folder: the report's two
    passes (default selection, then the answer) read it instead of re-running
    the pipeline, and a lost executor does not send them back to the raw trips.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Fixture:
    """The trip pipeline over the test tables, built lazily stage by stage."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def months(self) -> list[tuple[int, int]]:
        return fixture.months(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> DataFrame:
        return fixture.zones(self.spark, self.sf_dir).withColumnsRenamed(ZONE_RENAMES)

    @cached_property
    def cleansed(self) -> cleansing.Cleansed:
        return cleansing.cleanse(self.raw, self.months)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.join_zones(self.cleansed.clean, self.zones)

    @cached_property
    def hourly(self) -> DataFrame:
        return aggregate.hourly_stats(self.enriched)

    @cached_property
    def daily(self) -> DataFrame:
        return aggregate.rolling_revenue(aggregate.daily_stats(self.enriched))

    @cached_property
    def dim_location(self) -> DataFrame:
        return model.dim_location(self.zones)

    @cached_property
    def years(self) -> list[int]:
        return sorted({y for y, _ in self.months})

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar of the years the cleansed trips touch (derived from the data)."""
        return model.dim_date_for(self.cleansed.clean)

    @cached_property
    def period_calendar(self) -> DataFrame:
        """Calendar of the processing period's years, as a run builds it for its fact (any year, if there are no trips)."""
        years = self.years or [1970]
        return model.dim_date(self.spark, f"{years[0]}-01-01", f"{years[-1]}-12-31")

    @cached_property
    def fact(self) -> DataFrame:
        # cleansed trips lie in the period, so its calendar covers every pickup date
        # and has a proven size (no second pass over the trips to bound it)
        return model.fact_trips(self.enriched, self.dim_location, self.period_calendar,
                                model.calendar_rows(len(self.years) or 1))


HOURLY_MONEY = ("total_fare", "total_tips")
HOURLY_MEANS = ("avg_fare", "avg_distance", "avg_duration_minutes")
DAILY_MONEY = ("revenue", "rolling_7d_revenue")
DAILY_MEANS = ("avg_distance",)


def q_scan_raw(spark, sf):
    return Fixture(spark, sf).raw


def q_landed_raw(spark, sf):
    """Raw trips with the (year, month) partition they are landed under."""
    raw = Fixture(spark, sf).raw
    return raw.withColumns({"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")})


def q_partition_scan(spark, sf):
    """One month of the raw table, landed as the jobs land it: a partitioned read that opens only that month's files."""
    fx = Fixture(spark, sf)
    layout = jobs.scratch_layout(spark)
    lake.land_raw(spark, fx.raw, layout, fx.months)
    return lake.read_raw(spark, layout, [ONE_MONTH])


def q_zones(spark, sf):
    return Fixture(spark, sf).zones


def q_dim_location(spark, sf):
    return Fixture(spark, sf).dim_location


def q_cast(spark, sf):
    return cleansing.cast_columns(Fixture(spark, sf).raw)


def q_quarantine_good(spark, sf):
    return cleansing.quarantine(cleansing.cast_columns(Fixture(spark, sf).raw)).good


def q_quarantine_bad(spark, sf):
    return Fixture(spark, sf).cleansed.quarantined


def q_period_filter(spark, sf):
    return Fixture(spark, sf).cleansed.in_period


def q_period_filter_month(spark, sf):
    """One month of the usable raw trips: a period that cuts."""
    return cleansing.period_filter(q_quarantine_good(spark, sf), [ONE_MONTH])


def q_period_filter_ref(spark, sf):
    good = q_quarantine_good(spark, sf)
    return cleansing.period_filter(good, fixture.months(spark, sf), bound="reference")


def q_dedup(spark, sf):
    return Fixture(spark, sf).cleansed.deduped


def q_dedup_stats(spark, sf):
    """Rows before deduplication, removed and remaining, in one pass (remaining = distinct keys)."""
    rows = Fixture(spark, sf).cleansed.in_period
    counts = rows.agg(
        F.count(F.lit(1)).alias("before"),
        F.count_distinct(F.struct(*[F.col(k) for k in DEDUP_KEYS])).alias("remaining"),
    )
    return counts.select("before", (F.col("before") - F.col("remaining")).alias("removed"), "remaining")


def q_business_rules(spark, sf):
    return cleansing.business_rules(Fixture(spark, sf).cleansed.deduped)


def q_derived(spark, sf):
    return cleansing.derive(q_quarantine_good(spark, sf))


def q_cleanse(spark, sf):
    return Fixture(spark, sf).cleansed.clean


def q_enrich(spark, sf):
    return Fixture(spark, sf).enriched


def q_hourly_stats(spark, sf):
    return present(Fixture(spark, sf).hourly, HOURLY_MONEY, HOURLY_MEANS)


def q_daily_stats(spark, sf):
    return present(aggregate.daily_stats(Fixture(spark, sf).enriched), DAILY_MONEY, DAILY_MEANS)


def q_rolling_7d(spark, sf):
    return present(Fixture(spark, sf).daily, DAILY_MONEY, DAILY_MEANS)


def q_dim_date(spark, sf):
    return Fixture(spark, sf).dim_date


def q_trip_id(spark, sf):
    clean = Fixture(spark, sf).cleansed.clean
    return clean.select("VendorID", "tpep_pickup_datetime", "PULocationID", trip_id().alias("trip_id"))


def q_fact_trips(spark, sf):
    return Fixture(spark, sf).fact


def q_dq_not_null(spark, sf):
    casted = cleansing.cast_columns(Fixture(spark, sf).raw)
    return quality.run_checks(casted, [quality.not_null(c) for c in REQUIRED_COLUMNS])


def q_dq_uniqueness(spark, sf):
    fx = Fixture(spark, sf)
    return quality.run_checks(fx.fact, [quality.unique("trip_id")], by=("year", "month"))


def q_dq_range(spark, sf):
    casted = cleansing.cast_columns(Fixture(spark, sf).raw)
    return quality.run_checks(
        casted,
        [quality.between("fare_amount", 0.0, 5000.0), quality.between("trip_distance", 0.0, 200.0),
         quality.between("passenger_count", 1, 9)],
    )


def q_dq_row_count(spark, sf):
    return quality.run_checks(Fixture(spark, sf).fact, [quality.row_count(100_000)], by=("year", "month"))


def q_orphan_rows(spark, sf):
    """Location keys of trips and facts that the location dimension lacks, with their number of rows."""
    fx = Fixture(spark, sf)
    trips = quality.orphans(fx.cleansed.clean, ["PULocationID", "DOLocationID"], fx.dim_location, "location_id")
    facts = quality.orphans(fx.fact, ["pickup_location_sk", "dropoff_location_sk"], fx.dim_location, "location_sk")
    return trips.unionByName(facts)


def q_whole_run(spark, sf):
    """Daily gold of the jobs over a lake: the later months first, then the earlier ones, then one month again.

    The trips are delivered as files once; every landing reads those files whole.
    """
    fx = Fixture(spark, sf)
    layout, months = jobs.scratch_layout(spark), fx.months
    zones = fixture.zones(spark, sf)
    half = len(months) // 2
    feed = jobs.deliver(spark, layout, fx.raw)
    for batch in (months[half:], months[:half], months[half : half + 1]):
        jobs.run_all(spark, layout, feed, zones, batch, enforce_gate=False)
    daily = lake.read_if_exists(spark, layout.daily_stats)
    daily = fx.daily.limit(0) if daily is None else daily.drop("year", "month")
    return present(daily, DAILY_MONEY, DAILY_MEANS)


def q_zones_csv(spark, sf):
    """The zone lookup landed as CSV and read back with its declared schema."""
    layout = jobs.scratch_layout(spark)
    lake.land_zones(spark, fixture.zones(spark, sf), layout)
    return lake.read_zones(spark, layout)


def q_schema_gate(spark, sf):
    """Raw trips without a required column: all are quarantined as they arrived, with the reason."""
    fx = Fixture(spark, sf)
    return cleansing.cleanse(fx.raw.drop("fare_amount"), fx.months).quarantined


def q_orphans(spark, sf):
    fx = Fixture(spark, sf)
    checks = [
        quality.foreign_key("pickup_location_sk", fx.dim_location, "location_sk"),
        quality.foreign_key("dropoff_location_sk", fx.dim_location, "location_sk"),
    ]
    return quality.run_checks(fx.fact, checks, by=("year", "month"))


def q_dq_results(spark, sf):
    fx = Fixture(spark, sf)
    return quality.run_checks(fx.fact, quality.fact_gate(fx.dim_location), by=("year", "month"))


def q_expectation_suite(spark, sf):
    fx = Fixture(spark, sf)
    return quality.run_checks(fx.fact, quality.compile_suite(quality.EXPECTATION_SUITE))


def q_boroughs(spark, sf):
    return reports.boroughs(Fixture(spark, sf).daily)


def q_report_revenue(spark, sf):
    pivot = reports.revenue_by_borough(gold(Fixture(spark, sf).daily))
    return present(pivot, [c for c in pivot.columns if c != "pickup_date"])


def q_report_peak_hours(spark, sf):
    return reports.peak_hours(gold(Fixture(spark, sf).hourly))


def q_report_fare_by_distance(spark, sf):
    fx = Fixture(spark, sf)
    histogram = gold(reports.distance_histogram(fx.fact, fx.dim_location))
    return present(reports.fare_by_bin(histogram), mean_cols=("fare_amount",))


def q_stage_counts(spark, sf):
    fx = Fixture(spark, sf)
    casted = cleansing.cast_columns(fx.raw)
    ts_type = casted.schema["tpep_pickup_datetime"].dataType.simpleString()
    return metrics.stage_counts(
        casted,
        bad=any_null(REQUIRED_COLUMNS),
        in_period=in_months("tpep_pickup_datetime", fx.months, ts_type=ts_type),
        dedup_keys=list(DEDUP_KEYS),
        clean=fx.cleansed.clean,
        enriched=fx.enriched,
        fact=fx.fact,
    )


def q_drop_rate(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.drop_rate(fx.raw, fx.cleansed.clean)


def q_freshness(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.freshness(fx.cleansed.clean, "silver_trips", FRESHNESS_AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
