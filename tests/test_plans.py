"""Physical-plan assertions: what must hold for the jobs to scale."""

import re

import pytest
from pyspark.sql import functions as F

from faregrid.operators import cleansing as C
from faregrid.operators import quality as Q
from faregrid.plans import catalog
from faregrid.plans.catalog import Fixture
from faregrid.sources import lake
from tests.conftest import SF_SMALL, plan_text


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SF_SMALL)


@pytest.fixture(scope="module")
def landed(spark):
    from faregrid.plans import jobs
    from faregrid.plans.metrics import MetricsRecorder

    from faregrid.sources import fixture

    layout = jobs.scratch_layout(spark)
    months = [(1997, m) for m in range(1, 13)]
    jobs.land(spark, layout, fixture.raw_trips(spark, SF_SMALL), fixture.zones(spark, SF_SMALL), months, MetricsRecorder())
    return layout


def test_period_and_required_predicates_reach_the_parquet_reader(spark, landed):
    raw = lake.read_raw(spark, landed, [(1997, 3)])
    plan = plan_text(C.cleanse(raw, [(1997, 3)]).clean)
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1997-03-01T00:00)" in pushed
    assert "LessThan(tpep_pickup_datetime,1997-04-01T00:00)" in pushed
    assert "IsNotNull(fare_amount)" in pushed
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_partition_scan_reads_one_month(spark):
    scan = catalog.q_partition_scan(spark, SF_SMALL)
    plan = plan_text(scan)
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan
    assert {(r["year"], r["month"]) for r in scan.select("year", "month").distinct().collect()} == {catalog.ONE_MONTH}


def test_fare_report_aggregates_trips_by_distance(spark):
    from faregrid.operators import reports

    fact = spark.createDataFrame([(1.0, 2.0, 1), (1.0, 4.0, 1)], "trip_distance double, fare_amount double, pickup_location_sk int")
    histogram = reports.distance_histogram(fact, spark.createDataFrame([(1, "A")], "location_sk int, borough string"))
    assert [tuple(r) for r in histogram.collect()] == [(1.0, 6.0, 2)]
    assert "partial_sum" in plan_text(histogram)  # one row per distance and task is shuffled, not one per trip


def test_dedup_combines_map_side_before_the_shuffle(fx):
    plan = plan_text(fx.cleansed.deduped)
    tree = plan.split("\n\n")[0]
    # partial aggregate below the exchange: a hot key sends one row per map task
    assert re.search(r"Exchange[\s\S]*SortAggregate", tree)
    assert "partial_min(struct(" in plan


def test_enrich_and_fact_never_shuffle_trips(fx):
    for df in (fx.enriched, fx.fact):
        plan = plan_text(df)
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert plan.count("BroadcastHashJoin LeftOuter") >= 2


def test_fact_scan_reads_only_needed_columns(spark, landed):
    from faregrid.operators import enrich
    from faregrid.operators import model

    raw = lake.read_raw(spark, landed, [(1997, 3)])
    zones = lake.read_zones(spark, landed)
    fact = model.fact_trips(enrich.join_zones(C.cleanse(raw, [(1997, 3)]).clean, zones), model.dim_location(zones),
                            model.dim_date(spark, "1997-01-01", "1997-12-31"), model.calendar_rows(1))
    plan = plan_text(fact.select("trip_id", "fare_amount"))
    zone_scan = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan) if "Borough" in s or "LocationID" in s]
    assert all("Zone:" not in s for s in zone_scan)  # zone names are not read for a keys-only fact projection


def test_quality_gate_is_one_aggregate_with_partial_distinct(fx):
    plan = plan_text(Q.run_checks(fx.fact, Q.fact_gate(fx.dim_location), by=("year", "month")))
    tree = plan.split("\n\n")[0]
    # the trip rows pass through one chain of aggregates (two-level distinct), no self-join
    assert "SortMergeJoin" not in tree and "Union" not in tree
    assert "Expand" not in tree  # a single distinct aggregate: no row multiplication


def test_rolling_window_runs_on_daily_rows(fx):
    tree = plan_text(fx.daily).split("\n\n")[0]
    window_at = tree.index("Window")
    agg_at = tree.index("HashAggregate")
    assert window_at < agg_at  # in the printed tree the window sits above (after) the daily aggregate


def test_quarantine_write_is_shuffle_free(spark, landed):
    # the NULL test on a cast column (try_cast can also yield NULL) is not a Parquet
    # predicate, so the quarantine job scans the month; it never shuffles
    raw = lake.read_raw(spark, landed, [(1997, 3)])
    tree = plan_text(C.cleanse(raw, [(1997, 3)]).quarantined).split("\n\n")[0]
    assert "Exchange" not in tree and "PartitionFilters" in plan_text(raw)


def test_month_counts_come_from_footers(spark, landed):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counted = lake.month_counts(spark, landed.raw_trips, [(1997, 3), (1997, 4), (1890, 1)])
    plan = plan_text(counted)
    # one row a file: the reader answers from the footers and reads no column
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [year, month]" in plan
    assert re.findall(r"ReadSchema: struct<(.*)>", plan) == ["year:int,month:int,count(*):bigint"], plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    rows = lake.read_raw(spark, landed, [(1997, 3), (1997, 4)]).groupBy("year", "month").count()
    assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in rows.collect()}
    assert {r["month"] for r in counted.collect()} == {3, 4}
    assert lake.month_counts(spark, landed.raw_trips, [(1890, 1)]) is None
    assert lake.month_counts(spark, landed.raw_trips + "-none", [(1997, 3)]) is None


def test_month_counts_of_months_that_differ_in_types(spark, landed):
    path = landed.raw_trips + "-drift"
    for month, kind in ((1, "int"), (2, "string"), (3, "bigint")):
        rows = spark.range(10 * month).select(F.col("id").cast(kind).alias("VendorID"), F.lit(2001).alias("year"), F.lit(month).alias("month"))
        rows.write.mode("append").partitionBy("year", "month").parquet(path)
    counted = lake.month_counts(spark, path, [(2001, m) for m in range(1, 13)])
    assert {tuple(r) for r in counted.collect()} == {(2001, 1, 10), (2001, 2, 20), (2001, 3, 30)}
