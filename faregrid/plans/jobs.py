"""Composite jobs over the lake: land -> cleanse -> enrich -> {aggregate, dims} -> fact -> quality.

Each stage reads what the previous stage wrote, so lineage is cut at every
stage boundary by a committed table: a lost executor costs at most the
current stage, never a recomputation from the raw feed. Stage totals are
collected with ``DataFrame.observe`` on the write itself (no extra action),
always in a result stage so task retries cannot count twice; per-month
counts come from the footers of the stored files (``lake.month_counts``).
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faregrid import schemas as S
from faregrid.operators import aggregate, cleansing, enrich, model, quality, reports
from faregrid.plans.metrics import MetricsRecorder, drop_rate_value, observed
from faregrid.session import checkpoint_dir
from faregrid.sources import lake
from faregrid.sources.lake import Layout

log = logging.getLogger(__name__)

Months = Sequence[tuple[int, int]]


def scratch_layout(spark: SparkSession, name: str | None = None) -> Layout:
    """A lake root below the cluster's shared ``spark.checkpoint.dir`` (fresh per call)."""
    return Layout(f"{checkpoint_dir(spark).rstrip('/')}/{name or 'lake-' + uuid.uuid4().hex[:12]}")


def deliver(spark: SparkSession, layout: Layout, feed: DataFrame) -> DataFrame:
    """The feed written once as source files, each in order of pickup, for several landings to read.

    A feed that is derived (here by a join) would be derived again by every pass of every landing.
    """
    path = f"{layout.root}/delivered"
    feed.sortWithinPartitions(cleansing.PICKUP).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(feed.schema).parquet(path)


def partition_counts(spark: SparkSession, paths: dict[str, str], months: Months) -> dict[str, dict[tuple[int, int], int]]:
    """Rows per (year, month) partition of stored tables (missing = empty), from the footers of their files.

    A table that nothing is stored of starts no job; an answer has one row per month.
    """
    out: dict[str, dict[tuple[int, int], int]] = {}
    for name, path in paths.items():
        counted = lake.month_counts(spark, path, months)
        out[name] = {(r["year"], r["month"]): r["count"] for r in counted.collect()} if counted is not None else {}
    return out


def land(spark: SparkSession, layout: Layout, feed: DataFrame, zones: DataFrame, months: Months,
         rec: MetricsRecorder) -> list[tuple[int, int]]:
    """Land missing raw months and the zone lookup; record rows landed, rows of other months, and bytes per month."""
    with rec.timer("ingestion"):
        lake.land_zones(spark, zones, layout)
        landing = lake.land(spark, feed, layout, months)
        rec.record("ingestion_rows", landing.landed_rows)
        rec.record("ingestion_rows_outside", landing.outside_rows)
        if landing.written:
            # sizes from the file listing of the months written (binaryFile never reads contents when only
            # path and length are selected)
            dirs = [f"{layout.raw_trips}/{lake.month_name(m)}" for m in landing.written]
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(dirs).select("path", "length")
            parsed = files.select(
                F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int").alias("year"),
                F.regexp_extract("path", r"/month=(\d+)/", 1).cast("int").alias("month"),
                "length",
            )
            for r in parsed.groupBy("year", "month").agg(F.sum("length").alias("bytes")).collect():
                rec.record(S.METRIC_INGESTION_SIZE_MB, r["bytes"] / (1024 * 1024), year=r["year"], month=r["month"])
    return landing.written


def cleanse(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder,
            bound: str = "half_open", merge_schema: bool = False) -> None:
    """Cleanse the landed raw months into silver; quarantined rows go to their own table."""
    with rec.timer(S.JOB_CLEANSING):
        raw = lake.read_raw(spark, layout, months, merge_schema)
        c = cleansing.cleanse(raw, months, bound, count_copies=True)
        # the counters sit above the write's last shuffle: a map stage re-run after an executor loss would count twice
        obs, row = Observation("clean"), F.col(cleansing.KEPT)
        rows = lake.by_month(cleansing.judged(c.counted), months).observe(
            obs, F.count(F.lit(1)).alias("remaining"), F.sum(cleansing.COPIES).alias("in_period"),
            F.max(F.unix_timestamp(row["tpep_pickup_datetime"])).alias("last_pickup"),
        )
        lake.replace_months(cleansing.kept(rows), layout.silver_trips, months)
        # bad rows as they arrived, with the reason, in the layout of the raw months
        lake.replace_months(c.quarantined, layout.quarantine, months)

        remaining = obs.get["remaining"]
        rec.record("dedup_removed", (obs.get["in_period"] or 0) - remaining)
        rec.record("dedup_remaining", remaining)
        last = obs.get["last_pickup"]
        if last is not None:
            rec.record(S.METRIC_FRESHNESS_LAG, time.time() - last, table="silver_trips")
        # footers only: neither raw nor silver is scanned again for its numbers of rows
        counts = partition_counts(
            spark, {"raw": layout.raw_trips, "clean": layout.silver_trips, "bad": layout.quarantine}, months
        )
        raw_counts, out_counts, bad_counts = counts["raw"], counts["clean"], counts["bad"]
        for y, m in months:
            rin, rout = raw_counts.get((y, m), 0), out_counts.get((y, m), 0)
            rec.record(S.METRIC_CLEANSING_IN, rin, year=y, month=m)
            rec.record(S.METRIC_CLEANSING_OUT, rout, year=y, month=m)
            rec.record(S.METRIC_CLEANSING_DROP_RATE, drop_rate_value(rin, rout), year=y, month=m)
            rec.record("quarantined_records", bad_counts.get((y, m), 0), year=y, month=m)


def enrich_months(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder) -> None:
    """Silver trips of the months + zone lookup -> enriched trips (only those months are replaced)."""
    with rec.timer(S.JOB_JOIN):
        trips = lake.read_months(spark, layout.silver_trips, months)
        enriched = enrich.join_zones(trips, lake.read_zones(spark, layout))
        enriched, obs = observed(enriched, "enriched")
        lake.replace_months(enriched, layout.enriched, months)
        rec.record(S.METRIC_JOIN_OUT, obs.get["rows"])


def _years(months: Months) -> list[int]:
    return sorted({y for y, _ in months})


def _stored_rows(spark: SparkSession, path: str, months: list[tuple[int, int]], columns: list[str]) -> DataFrame | None:
    """Rows of the given months already in a gold table, checkpointed: the caller then
    overwrites partitions of that same table, so the rows must not be read lazily from it."""
    stored = lake.read_if_exists(spark, path) if months else None
    if stored is None:
        return None
    checkpoint_dir(spark)  # the cluster's shared folder; raises if none is configured
    return stored.filter(lake.months_filter(months)).select(*columns).checkpoint(eager=True)


def aggregate_months(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder) -> None:
    """Hourly and daily (+ rolling 7 days) statistics; trips are read for the run's months only.

    Gold tables hold one file per year (sorted by ``pickup_date``): a run
    aggregates its own months from the trips and rewrites each affected year
    from those rows plus the year's other months read back from gold (small:
    days x hours x boroughs). The rolling window is recomputed over the whole
    rewritten year with the previous December as lead-in; a run that contains a
    December also rewrites the next year, whose first days look back into it.
    Whatever order months are run in, the tables equal one run over all of them.
    """
    with rec.timer(S.JOB_WINDOWED_AGG):
        months = sorted(set(months))
        run_years = _years(months)
        trips = lake.read_months(spark, layout.enriched, months)
        part = {"year": F.year("pickup_date"), "month": F.month("pickup_date")}

        def year_months(ys):
            return [(y, m) for y in ys for m in range(1, 13) if (y, m) not in months]

        checkpoint_dir(spark)
        parts = aggregate.partials(trips).checkpoint(eager=True)  # dates x hours x boroughs: the only pass over the trips
        hourly = aggregate.finish(parts, aggregate.SLOT, S.HOURLY_MEASURES).withColumns(part)
        kept_h = _stored_rows(spark, layout.hourly_stats, year_months(run_years), hourly.columns)
        if kept_h is not None:
            hourly = hourly.unionByName(kept_h)
        # aggregated rows are few: AQE coalesces the aggregate's shuffle to a handful of
        # partitions, so a local sort (no second shuffle) gives few, well-ordered files;
        # counters go after the last exchange (result stage: counted once under retries)
        hourly, h_obs = observed(hourly.sortWithinPartitions("year", "pickup_date"), "hourly")
        lake.write_partitioned(hourly, layout.hourly_stats, ["year"])

        daily = aggregate.finish(parts, aggregate.DAY, S.DAILY_MEASURES).withColumns(part)
        rewrite = sorted(set(run_years) | {y + 1 for y, m in months if m == 12})
        lead_in = [(y - 1, 12) for y in rewrite if y - 1 not in rewrite]  # each gap's previous December
        kept_d = _stored_rows(spark, layout.daily_stats, year_months(rewrite) + lead_in, daily.columns)
        if kept_d is not None:
            daily = daily.unionByName(kept_d)
        rolled = aggregate.rolling_revenue(daily).filter(F.col("year").isin(rewrite))
        rolled, d_obs = observed(rolled.sortWithinPartitions("year", "pickup_date"), "daily")
        lake.write_partitioned(rolled, layout.daily_stats, ["year"])
        rec.record(S.METRIC_AGG_HOURLY_ROWS, h_obs.get["rows"])
        rec.record(S.METRIC_AGG_DAILY_ROWS, d_obs.get["rows"])


def build_dims(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder) -> None:
    """dim_location from the zone lookup; dim_date for each year of the run."""
    with rec.timer("dim_tables"):
        loc, l_obs = observed(model.dim_location(lake.read_zones(spark, layout)), "dim_location")
        loc.coalesce(1).write.mode("overwrite").parquet(layout.dim_location)
        rec.record("dim_location_rows", l_obs.get["rows"])
        years = _years(months)
        dates = model.dim_date(spark, f"{years[0]}-01-01", f"{years[-1]}-12-31").filter(F.col("year").isin(years))
        dates, d_obs = observed(lake.clustered(dates, ["year"], ["full_date"]), "dim_date")
        lake.write_partitioned(dates, layout.dim_date, ["year"])
        rec.record("dim_date_rows", d_obs.get["rows"])


def read_dim_date(spark: SparkSession, layout: Layout) -> DataFrame:
    return lake.read_partitioned(spark, layout.dim_date)


def build_fact(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder) -> None:
    with rec.timer("fact_tables"):
        enriched = lake.read_months(spark, layout.enriched, months)
        years = _years(months)
        dates = read_dim_date(spark, layout).filter(F.col("year").isin(years))  # one partition per year
        fact = model.fact_trips(enriched, spark.read.parquet(layout.dim_location), dates, model.calendar_rows(len(years)))
        fact, obs = observed(fact, "fact")
        lake.replace_months(fact, layout.fact_trips, months)
        rec.record(S.METRIC_FACT_ROWS, obs.get["rows"])


def quality_gate(spark: SparkSession, layout: Layout, months: Months, rec: MetricsRecorder,
                 min_rows: int = quality.MIN_ROWS_PER_MONTH, enforce: bool = True) -> list[dict]:
    """The per-month gate in one pass over the months' facts; results are stored, then enforced."""
    with rec.timer("data_quality"):
        fact = lake.read_months(spark, layout.fact_trips, months)
        dim = spark.read.parquet(layout.dim_location)
        checks = quality.fact_gate(dim, min_rows)
        results = quality.run_checks(fact, checks, by=("year", "month"))
        # one pass over the fact; the answer is checks x months rows, so it is
        # collected once and the stored table is written from those rows
        rows = [r.asDict() for r in results.collect()]
        # a month without fact rows has no group: check it as an empty table (row count 0)
        seen = {(r["year"], r["month"]) for r in rows}
        missing = [(y, m) for y, m in months if (y, m) not in seen]
        if missing:  # the same answer for every empty month: computed once
            empty = [r.asDict() for r in quality.run_checks(fact.filter(F.lit(False)), checks).collect()]
            rows.extend({"year": y, "month": m, **r} for y, m in missing for r in empty)
        stored = spark.createDataFrame(rows, schema=results.schema)
        others = [(y, m) for y in _years(months) for m in range(1, 13) if (y, m) not in months]
        kept = _stored_rows(spark, layout.quality_results, others, stored.columns)
        if kept is not None:
            stored = stored.unionByName(kept)
        lake.write_partitioned(stored.coalesce(1), layout.quality_results, ["year"])  # checks x months rows: a file a year
        for r in rows:
            rec.record(S.DQ_METRIC[r["check"]], r["observed"], table="fact_trips", column=r["column"],
                       year=r["year"], month=r["month"], status=r["status"])
        if enforce:
            quality.enforce_rows(rows)
        return rows


@dataclass
class RunReport:
    layout: Layout
    months: list[tuple[int, int]]
    metrics: MetricsRecorder
    dq: list[dict]


def run_all(
    spark: SparkSession,
    layout: Layout,
    feed: DataFrame,
    zones: DataFrame,
    months: Iterable[tuple[int, int]],
    bound: str = "half_open",
    min_rows: int = quality.MIN_ROWS_PER_MONTH,
    enforce_gate: bool = True,
    rec: MetricsRecorder | None = None,
) -> RunReport:
    """The whole chain for a set of months, in dependency order; metrics are appended to the lake."""
    months = sorted(set(months))
    rec = rec or MetricsRecorder()
    dq: list[dict] = []
    if not months:
        return RunReport(layout, months, rec, dq)
    try:
        land(spark, layout, feed, zones, months, rec)
        cleanse(spark, layout, months, rec, bound)
        enrich_months(spark, layout, months, rec)
        aggregate_months(spark, layout, months, rec)
        build_dims(spark, layout, months, rec)
        build_fact(spark, layout, months, rec)
        dq = quality_gate(spark, layout, months, rec, min_rows, enforce_gate)
    finally:
        rec.write(spark, layout.metrics)
    return RunReport(layout, months, rec, dq)


# --- reports over the gold tables -------------------------------------------


def _gold(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A gold table, or an empty frame with the columns of the report if it has no file yet."""
    found = lake.read_if_exists(spark, path)
    return spark.createDataFrame([], schema) if found is None else found


def report_revenue(spark: SparkSession, layout: Layout, selected: Sequence[str] | None = None) -> DataFrame:
    daily = _gold(spark, layout.daily_stats, "pickup_date date, pickup_borough string, revenue double")
    return reports.revenue_by_borough(daily, selected)


def report_peak_hours(spark: SparkSession, layout: Layout, borough: str | None = None) -> DataFrame:
    hourly = _gold(spark, layout.hourly_stats, "pickup_date date, pickup_hour int, pickup_borough string, trip_count bigint")
    return reports.peak_hours(hourly, borough)


def report_fare_by_distance(spark: SparkSession, layout: Layout) -> DataFrame:
    fact = _gold(spark, layout.fact_trips, "trip_distance double, fare_amount double, pickup_location_sk int")
    locations = _gold(spark, layout.dim_location, "location_sk int, borough string")
    checkpoint_dir(spark)
    histogram = reports.distance_histogram(fact, locations).checkpoint(eager=True)
    return reports.fare_by_bin(histogram)  # the only pass over the fact is the histogram's
