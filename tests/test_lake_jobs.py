"""End-to-end over an on-disk lake, with re-runs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faregrid.plans import jobs
from faregrid.plans.metrics import MetricsRecorder
from faregrid.sources import lake, publish
from tests.conftest import SF_SMALL, TYPED_TRIP, plan_text, trip

MONTH = [(2023, 1)]
RUN = [(2021, 6), (2021, 7)]


@pytest.fixture(scope="module")
def lake_run(spark):
    """Two months: a trip delivered three times, one at a zone nobody knows, one without a fare, one over the month's end."""
    layout = jobs.scratch_layout(spark)
    june, july = datetime(2021, 6, 30, 23, 50), datetime(2021, 7, 2, 14, 5)
    feed = spark.createDataFrame(
        [trip(2, june, datetime(2021, 7, 1, 0, 20), 3, 6.25, 7, 8, 21.0, 26.5, 4.0, 0.0)] * 3
        + [trip(1, july, datetime(2021, 7, 2, 14, 25), 1, 1.5, 99, 8, 7.5, 9.0, 0.0, 0.0),
           trip(1, datetime(2021, 7, 3, 14, 0), datetime(2021, 7, 3, 14, 9), 1, 1.0, 7, 7, None, 9.0, 0.0, 0.0)],
        TYPED_TRIP,
    )
    zones = spark.createDataFrame(
        [(7, "Brooklyn", "Astoria Park", "Boro Zone"), (8, "Bronx", "Bay Terrace", "Boro Zone")],
        "LocationID int, Borough string, Zone string, service_zone string",
    )
    report = jobs.run_all(spark, layout, feed, zones, RUN, min_rows=1)
    return spark, layout, feed, zones, report


def test_each_month_of_the_run_reaches_silver_once(lake_run):
    spark, layout, *_ = lake_run
    silver = spark.read.parquet(layout.silver_trips)
    assert {(r["year"], r["month"]): r["count"] for r in silver.groupBy("year", "month").count().collect()} == {m: 1 for m in RUN}
    assert spark.read.parquet(layout.quarantine).select("quarantine_reason").first()[0] == "fare_amount"


def test_unknown_zones_stay_null_when_enriched(lake_run):
    spark, layout, *_ = lake_run
    found = {r["month"]: (r["pickup_borough"], r["dropoff_borough"]) for r in spark.read.parquet(layout.enriched).collect()}
    assert found == {6: ("Brooklyn", "Bronx"), 7: (None, "Bronx")}


def test_daily_gold_is_rolled_over_the_end_of_the_month(lake_run):
    spark, layout, *_ = lake_run
    daily = {r["pickup_borough"]: (r["revenue"], r["rolling_7d_revenue"]) for r in lake.read_partitioned(spark, layout.daily_stats).collect()}
    assert daily == {"Brooklyn": (26.5, 26.5), None: (9.0, 9.0)}


def test_gate_warns_of_the_orphan_and_is_stored(lake_run):
    spark, layout, _, _, report = lake_run
    by = {(r["month"], r["check"], r["column"]): r["status"] for r in report.dq}
    assert by[7, "foreign_key", "pickup_location_sk"] == "WARN" and set(by.values()) == {"PASS", "WARN"}
    assert spark.read.parquet(layout.quality_results).count() == 14


def test_metrics_of_the_run(lake_run):
    spark, layout, _, _, report = lake_run
    rec = report.metrics
    assert [rec.get("cleansing_records_in", year=y, month=m) for y, m in RUN] == [[3.0], [2.0]]
    assert [rec.get("cleansing_drop_rate", year=y, month=m) for y, m in RUN] == [[0.6667], [0.5]]
    assert rec.get("dedup_removed") == [2.0] and rec.get("dedup_remaining") == [2.0] and rec.get("fact_trips_rows") == [2.0]
    assert rec.get("ingestion_rows") == [5.0] and rec.get("ingestion_rows_outside") == [0.0]
    timed = {r["tags"]["job"] for r in rec.records if r["metric"] == "job_duration_seconds"}
    assert timed >= {"ingestion", "cleansing_job", "join_job", "windowed_agg_job", "dim_tables", "fact_tables", "data_quality"}
    assert rec.get("dq_referential_orphans", column="pickup_location_sk", year=2021, month=7) == [1.0]
    assert spark.read.json(layout.metrics).count() >= len(rec.records)


def test_reports_over_gold(lake_run):
    spark, layout, *_ = lake_run
    # trips without a borough are in no report
    assert {r["pickup_date"].day for r in jobs.report_revenue(spark, layout).collect()} == {30}
    assert [tuple(r) for r in jobs.report_peak_hours(spark, layout, "Brooklyn").collect()] == [(23, 1)]
    assert jobs.report_fare_by_distance(spark, layout).count() == 1


def test_landing_skips_present_months(lake_run):
    spark, layout, feed, zones, _ = lake_run
    assert lake.landed_months(spark, layout) == set(RUN)
    assert lake.land_raw(spark, feed, layout, RUN) == []


def test_partition_pruning_on_silver(lake_run):
    spark, layout, *_ = lake_run
    plan = plan_text(lake.read_months(spark, layout.silver_trips, RUN[:1]))
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_gate_failure_raises_after_storing_results(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([trip()], TYPED_TRIP)
    zones = spark.createDataFrame([(10, "Queens", "Q", "Boro Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    from faregrid.operators import DataQualityFailure

    rec = MetricsRecorder()
    with pytest.raises(DataQualityFailure, match="row_count"):
        jobs.run_all(spark, layout, feed, zones, MONTH, rec=rec)  # 1 row < 100 000
    assert spark.read.parquet(layout.quality_results).filter("status = 'FAIL'").count() == 1
    assert any(r["tags"].get("job") == "data_quality" for r in rec.records)  # timed even when failing


def test_rerun_one_month_leaves_others(spark):
    from faregrid.sources import fixture
    from tests.conftest import SF_SMALL

    layout = jobs.scratch_layout(spark)
    feed, zones = fixture.raw_trips(spark, SF_SMALL), fixture.zones(spark, SF_SMALL)
    months = [(1997, m) for m in range(1, 13)]
    jobs.run_all(spark, layout, feed, zones, months, enforce_gate=False)

    def snapshot(path):
        df = spark.read.parquet(path)
        return {(r["year"], r["month"]): (r["n"], r["s"]) for r in
                df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("fare_amount").alias("s")).collect()}

    before = snapshot(layout.fact_trips)
    assert sum(n for n, _ in before.values()) == 436  # whole of 1997 at sf0.001
    jobs.run_all(spark, layout, feed, zones, [(1997, 3)], enforce_gate=False)
    assert snapshot(layout.fact_trips) == before
    assert snapshot(layout.silver_trips) == snapshot(layout.fact_trips)


def test_command_line_runs_stages(spark, capsys):
    from faregrid.__main__ import main
    from tests.conftest import SF_SMALL

    root = jobs.scratch_layout(spark).root
    assert main(["land-fixture", "--lake", root, "--sf-dir", SF_SMALL, "--year", "1997", "--months", "3"]) == 0
    assert main(["run", "--lake", root, "--year", "1997", "--months", "3", "--no-enforce"]) == 0
    out = capsys.readouterr().out
    assert "cleansing_records_out" in out and "fact_trips_rows" in out
    assert spark.read.parquet(f"{root}/gold/fact_trips").count() == 32  # 1997-03 at sf0.001 (DuckDB agrees)
    assert main(["report", "fare-by-distance", "--lake", root]) == 0


def test_rolling_window_crosses_the_year_boundary(spark):
    from datetime import date

    layout = jobs.scratch_layout(spark)
    zones = spark.createDataFrame([(10, "Queens", "Q", "Boro Zone"), (20, "Bronx", "B", "Boro Zone")],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    feed = spark.createDataFrame(
        [trip(pickup=datetime(2022, 12, 30, 8), dropoff=datetime(2022, 12, 30, 8, 30), total=5.0),
         trip(pickup=datetime(2023, 1, 2, 8), dropoff=datetime(2023, 1, 2, 8, 30), total=7.0)],
        TYPED_TRIP,
    )
    jobs.run_all(spark, layout, feed, zones, [(2022, 12)], enforce_gate=False)
    jobs.run_all(spark, layout, feed, zones, [(2023, 1)], enforce_gate=False)  # a run of 2023 alone
    daily = lake.read_partitioned(spark, layout.daily_stats)
    r = daily.filter(F.col("pickup_date") == F.lit(date(2023, 1, 2))).first()
    assert r["rolling_7d_revenue"] == 12.0  # includes 2022-12-30
    assert daily.filter("year = 2023").count() == 1 and daily.filter("year = 2022").count() == 1


def test_raw_months_with_a_new_column(spark):
    """A month that gained a column: merged read keeps it (NULL for older months) and it
    passes through silver unchanged."""
    layout = jobs.scratch_layout(spark)
    jan = spark.createDataFrame([trip()], TYPED_TRIP)
    feb = spark.createDataFrame([trip(pickup=datetime(2023, 2, 1, 8), dropoff=datetime(2023, 2, 1, 8, 30))], TYPED_TRIP)
    lake.land_raw(spark, jan, layout, [(2023, 1)])
    lake.land_raw(spark, feb.withColumn("airport_fee", F.lit(1.25)), layout, [(2023, 2)])
    raw = lake.read_raw(spark, layout, [(2023, 1), (2023, 2)], merge_schema=True)
    assert "airport_fee" in raw.columns
    from faregrid.operators import cleansing as C

    clean = {r["month"]: r["airport_fee"] for r in C.cleanse(raw, [(2023, 1), (2023, 2)]).clean.collect()}
    assert clean == {1: None, 2: 1.25}


def test_month_runs_in_any_order_equal_one_run(spark):
    """Incremental aggregation: months run one by one, out of order and with a re-run,
    give the same gold tables as a single run over all months."""
    from faregrid.sources import fixture
    from tests.conftest import SF_SMALL

    feed, zones = fixture.raw_trips(spark, SF_SMALL), fixture.zones(spark, SF_SMALL)
    months = [(1997, m) for m in range(1, 7)]

    def gold(layout):
        def rows(path, cols):
            df = lake.read_partitioned(spark, path)
            return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                          for r in df.select(*cols).collect())
        return (rows(layout.daily_stats, ["pickup_date", "pickup_borough", "trip_count", "revenue", "rolling_7d_revenue"]),
                rows(layout.hourly_stats, ["pickup_date", "pickup_hour", "pickup_borough", "trip_count", "total_fare"]))

    together = jobs.scratch_layout(spark)
    jobs.run_all(spark, together, feed, zones, months, enforce_gate=False)
    one_by_one = jobs.scratch_layout(spark)
    for m in [(1997, 5), (1997, 3), (1997, 4)] + months + [(1997, 3)]:
        jobs.run_all(spark, one_by_one, feed, zones, [m], enforce_gate=False)
    assert gold(one_by_one) == gold(together)


def test_run_with_no_months_does_nothing(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([trip()], TYPED_TRIP)
    zones = spark.createDataFrame([(10, "Queens", "Q", "Boro Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    report = jobs.run_all(spark, layout, feed, zones, [])
    assert report.dq == [] and report.metrics.records == []
    assert lake.landed_months(spark, layout) == set()


def test_rolling_lead_in_for_every_rewritten_year(spark):
    """A run over two non-adjacent years takes each year's previous December as lead-in."""
    from datetime import date

    layout = jobs.scratch_layout(spark)
    zones = spark.createDataFrame([(10, "Queens", "Q", "Boro Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    feed = spark.createDataFrame(
        [trip(pickup=datetime(2020, 12, 30, 8), dropoff=datetime(2020, 12, 30, 8, 30), total=5.0),
         trip(pickup=datetime(2021, 1, 2, 8), dropoff=datetime(2021, 1, 2, 8, 30), total=7.0),
         trip(pickup=datetime(2022, 12, 31, 8), dropoff=datetime(2022, 12, 31, 8, 30), total=3.0),
         trip(pickup=datetime(2023, 1, 1, 8), dropoff=datetime(2023, 1, 1, 8, 30), total=2.0)],
        TYPED_TRIP,
    )
    jobs.run_all(spark, layout, feed, zones, [(2020, 12), (2022, 12)], enforce_gate=False)
    jobs.run_all(spark, layout, feed, zones, [(2021, 1), (2023, 1)], enforce_gate=False)
    daily = {r["pickup_date"]: r["rolling_7d_revenue"] for r in lake.read_partitioned(spark, layout.daily_stats).collect()}
    assert daily[date(2021, 1, 2)] == 12.0 and daily[date(2023, 1, 1)] == 5.0


def test_gate_fails_an_empty_month(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([trip()], TYPED_TRIP)  # January only
    zones = spark.createDataFrame([(10, "Queens", "Q", "Boro Zone")], "LocationID int, Borough string, Zone string, service_zone string")
    report = jobs.run_all(spark, layout, feed, zones, [(2023, 1), (2023, 2)], min_rows=1, enforce_gate=False)
    feb = {r["check"]: (r["observed"], r["status"]) for r in report.dq if r["month"] == 2}
    assert feb["row_count"] == (0, "FAIL") and feb["not_null"] == (0, "PASS")
    assert {r["status"] for r in report.dq if r["month"] == 1} == {"PASS"}
    assert spark.read.parquet(layout.quality_results).filter("month = 2").count() == 7


def test_reports_without_gold_tables_are_empty(spark):
    layout = jobs.scratch_layout(spark)
    assert jobs.report_revenue(spark, layout).count() == 0
    assert jobs.report_peak_hours(spark, layout).count() == 0
    assert jobs.report_fare_by_distance(spark, layout).count() == 0


def test_gate_results_of_other_months_stay(lake_run):
    spark, layout, _, _, _ = lake_run
    before = spark.read.parquet(layout.quality_results).collect()
    jobs.quality_gate(spark, layout, [(2021, 8)], MetricsRecorder(), enforce=False)
    after = spark.read.parquet(layout.quality_results)
    assert sorted(map(str, after.filter("month < 8").collect())) == sorted(map(str, before))
    assert after.filter("month = 8").count() == 7
    jobs.quality_gate(spark, layout, [(2021, 6)], MetricsRecorder(), min_rows=1)
    assert spark.read.parquet(layout.quality_results).count() == 21
    assert len(publish.Files(spark, layout.quality_results).names("year=*/*.parquet")) == 1


def test_whole_run_derives_its_feed_once(spark, monkeypatch):
    from faregrid.plans import catalog
    from faregrid.sources import fixture

    feeds = []
    run_all = jobs.run_all

    def caught(spark, layout, feed, *args, **kwargs):
        feeds.append(feed)
        return run_all(spark, layout, feed, *args, **kwargs)

    monkeypatch.setattr(catalog.Fixture, "months", [(1997, 1), (1997, 2)])
    monkeypatch.setattr(jobs, "run_all", caught)
    catalog.q_whole_run(spark, SF_SMALL)
    assert len(feeds) == 3
    raw = fixture.raw_trips(spark, SF_SMALL)
    for feed in feeds:  # files, not the join of the tables once more
        assert "Join" not in plan_text(feed) and "delivered" in plan_text(feed)
    assert feeds[0].schema == raw.schema
    assert feeds[0].exceptAll(raw).isEmpty() and raw.exceptAll(feeds[0]).isEmpty()


def test_derived_columns_do_not_travel_to_their_month(spark, trips):
    from faregrid.operators import cleansing

    c = cleansing.cleanse(trips([trip(), trip(), trip(fare=-1.0), trip(pu=None, vendor=2)]), [(2023, 1)], count_copies=True)
    judged = cleansing.judged(c.counted)
    assert "trip_duration_minutes" not in judged.schema[cleansing.KEPT].dataType.names
    assert cleansing.kept(judged).columns == c.clean.columns
    assert cleansing.kept(judged).exceptAll(c.clean).isEmpty() and c.clean.exceptAll(cleansing.kept(judged)).isEmpty()
