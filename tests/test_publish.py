"""Landing once from many files, months published as one step, drift between months, plans of the jobs' own writes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faregrid.operators import cleansing, quality
from faregrid.plans import jobs
from faregrid.plans.metrics import MetricsRecorder
from faregrid.sources import fixture, lake, publish
from tests.conftest import SF_SMALL, TYPED_TRIP, plan_text, trip

JAN, FEB, MAR = (2023, 1), (2023, 2), (2023, 3)


def at(month, vendor=1, day=5):
    return trip(vendor, datetime(2023, month, day, 8), datetime(2023, month, day, 9))


def rows_of(spark, path):
    return {(r["year"], r["month"]): r["count"] for r in spark.read.parquet(path).groupBy("year", "month").count().collect()}


# --- landing -----------------------------------------------------------------


def test_a_row_lands_once_in_any_order_of_months(spark):
    feed = spark.createDataFrame([at(2), at(2, 2), at(3), at(1), trip(pickup=None), trip(pickup=None, vendor=2)], TYPED_TRIP)
    whole = {JAN: 3, FEB: 2, MAR: 1}  # rows without a pickup belong to the feed's first month
    for calls in ([[JAN, FEB, MAR]], [[MAR], [FEB], [JAN]], [[FEB, MAR], [JAN, FEB], [JAN, FEB, MAR], [JAN]]):
        layout = jobs.scratch_layout(spark)
        done = [lake.land(spark, feed, layout, c) for c in calls]
        assert rows_of(spark, layout.raw_trips) == whole and sum(d.landed_rows for d in done) == 6
        assert [d.outside_rows for d in done] == [6 - sum(whole[m] for m in c) for c in calls]


def test_late_rows_are_counted(spark):
    layout, rec = jobs.scratch_layout(spark), MetricsRecorder()
    feed = spark.createDataFrame([trip(pickup=datetime(2022, 12, 31, 23))], TYPED_TRIP)
    assert jobs.land(spark, layout, feed, spark.createDataFrame([(1, "B", "Z", "S")], "LocationID int, Borough string, Zone string, service_zone string"), [JAN], rec) == []
    assert rec.get("ingestion_rows_outside") == [1.0] and rec.get("ingestion_rows") == [0.0]
    assert lake.land(spark, feed, layout, [(2022, 12)]).landed_rows == 1


def test_a_feed_without_any_pickup_lands_once(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([trip(pickup=None)], TYPED_TRIP)
    assert [lake.land(spark, feed, layout, [m]).written for m in (FEB, JAN, FEB)] == [[FEB], [], []]


def test_source_files_land_once_each_and_add_to_a_month(spark):
    layout = jobs.scratch_layout(spark)
    root = jobs.scratch_layout(spark).root

    def deliver(name, rows):
        spark.createDataFrame(rows, TYPED_TRIP).coalesce(1).write.parquet(f"{root}/{name}")

    deliver("a", [at(1), at(2), trip(pickup=None)])
    first = lake.land(spark, lake.read_feed(spark, f"{root}/a"), layout, [JAN, FEB])
    assert (first.written, first.landed_rows) == ([JAN, FEB], 3)
    deliver("b", [at(1, 2), at(2, 2), at(3, 2)])
    both = lake.read_feed(spark, f"{root}/a", f"{root}/b")
    second = lake.land(spark, both, layout, [JAN])
    assert (second.written, second.landed_rows, second.outside_rows) == ([JAN], 1, 3)
    assert rows_of(spark, layout.raw_trips) == {JAN: 3, FEB: 1}
    assert lake.land(spark, both, layout, [JAN]).written == []
    assert lake.land(spark, both, layout, [JAN, FEB, MAR]).written == [FEB, MAR]
    assert rows_of(spark, layout.raw_trips) == {JAN: 3, FEB: 2, MAR: 1}
    listed = lake.ledger(spark, layout)
    assert listed.select("source").distinct().count() == 2 and listed.count() == 5
    assert listed.agg(F.sum("rows")).first()[0] == 6 and lake.SOURCE not in lake.read_raw(spark, layout, [JAN]).columns
    # a new version of a file is a new source
    spark.createDataFrame([at(1, 1, 9)], TYPED_TRIP).coalesce(1).write.mode("overwrite").parquet(f"{root}/b")
    assert lake.land(spark, lake.read_feed(spark, f"{root}/b"), layout, [JAN]).landed_rows == 1


# --- publication -------------------------------------------------------------


class Stopped(Exception):
    pass


def stop_after(monkeypatch, moves):
    done = {"n": 0}
    move = publish.Files.move

    def limited(self, source, target):
        if done["n"] >= moves:
            raise Stopped
        done["n"] += 1
        move(self, source, target)

    monkeypatch.setattr(publish.Files, "move", limited)


@pytest.mark.parametrize("moves", range(7))
def test_a_stopped_replacement_is_all_or_nothing(spark, monkeypatch, moves):
    path = jobs.scratch_layout(spark).silver_trips
    old = spark.createDataFrame([(1, *JAN), (2, *FEB), (3, *MAR)], "v int, year int, month int")
    new = spark.createDataFrame([(10, *JAN), (30, *MAR)], "v int, year int, month int")  # February becomes empty
    lake.replace_months(old, path, [JAN, FEB, MAR])
    with monkeypatch.context() as m:
        stop_after(m, moves)
        stopped = False
        try:
            lake.replace_months(new, path, [JAN, FEB, MAR])
        except Stopped:
            stopped = True
    assert stopped == (moves < 6)  # the intent, three months set aside, two moved in
    values = sorted(r["v"] for r in lake.read_months(spark, path, [JAN, FEB, MAR]).collect())
    assert values == ([1, 2, 3] if moves == 0 else [10, 30])
    # the next run goes on as if nothing had happened
    lake.replace_months(old.filter("v = 2"), path, [FEB])
    assert sorted(r["v"] for r in lake.read_months(spark, path, [JAN, FEB, MAR]).collect()) == ([1, 2, 3] if moves == 0 else [2, 10, 30])
    assert publish.Files(spark, path).names("_intent-*") == [] and publish.Files(spark, path).names("_replaced-*") == []


@pytest.mark.parametrize("moves", range(5))
def test_a_stopped_landing_neither_loses_nor_repeats_rows(spark, monkeypatch, moves):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([at(1), at(2), at(2, 2)], TYPED_TRIP)
    with monkeypatch.context() as m:
        stop_after(m, moves)
        try:
            lake.land(spark, feed, layout, [JAN, FEB])
        except Stopped:
            pass
    lake.land(spark, feed, layout, [JAN, FEB])
    assert rows_of(spark, layout.raw_trips) == {JAN: 1, FEB: 2} and lake.ledger(spark, layout).count() == 2


# --- drift -------------------------------------------------------------------


def put(spark, layout, rows, month, change=lambda df: df):
    change(spark.createDataFrame(rows, TYPED_TRIP)).write.parquet(f"{layout.raw_trips}/year={month[0]}/month={month[1]}")


def test_a_value_beyond_the_contract_is_quarantined(spark):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [at(1)], JAN)
    wide = F.when(F.col("VendorID") == 2, F.lit(3_000_000_000)).otherwise(F.col("VendorID"))
    put(spark, layout, [at(2), at(2, 2)], FEB, lambda df: df.withColumn("VendorID", wide.cast("long")))
    jobs.cleanse(spark, layout, [JAN, FEB], MetricsRecorder())
    silver = lake.read_months(spark, layout.silver_trips, [JAN, FEB])
    assert dict(silver.dtypes)["VendorID"] == "int" and silver.count() == 2
    bad = spark.read.parquet(layout.quarantine).first()
    assert (bad["VendorID"], bad["quarantine_reason"]) == (3_000_000_000, "VendorID")


def test_one_footer_a_month_and_extra_columns_only_when_asked_for(spark, monkeypatch):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [at(1)] * 4, JAN, lambda df: df.repartition(4))
    put(spark, layout, [at(2)] * 4, FEB, lambda df: df.repartition(4).withColumn("airport_fee", F.lit(1.25)))
    read = []
    parquet = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (read.extend(x for x in p if x.endswith(".parquet")), parquet(self, *p, **k))[1])
    plain, merged = (lake.read_raw(spark, layout, [JAN, FEB], merge_schema=m) for m in (False, True))
    assert len(read) == 4  # one file of each month, twice
    assert "airport_fee" not in plain.columns and plain.count() == 8
    assert {(r["month"], r["airport_fee"]) for r in merged.collect()} == {(1, None), (2, 1.25)}


# --- plans of the writes -----------------------------------------------------


@pytest.fixture(scope="module")
def writes(spark):
    """The frames that the jobs hand to the sink, by table, for a run over two months."""
    layout, months = jobs.scratch_layout(spark), [(1997, 3), (1997, 4)]
    caught = {}
    replace = lake.replace_months

    def catch(df, path, asked):
        caught[path.split(layout.root)[1].strip("/")] = plan_text(df, "simple")
        return replace(df, path, asked)

    lake.replace_months = catch
    try:
        jobs.run_all(spark, layout, fixture.raw_trips(spark, SF_SMALL), fixture.zones(spark, SF_SMALL), months, enforce_gate=False)
    finally:
        lake.replace_months = replace
    return layout, caught


def shuffles(plan):
    return [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_enrich_fact_and_quarantine_writes_never_shuffle(spark, writes):
    layout, caught = writes
    for table in ("silver/trips_with_zones", "gold/fact_trips", "silver/quarantine"):
        assert shuffles(caught[table]) == []
    for path in (layout.silver_trips, layout.enriched, layout.fact_trips):
        assert len(publish.Files(spark, path).names("year=*/month=*/*.parquet")) == 2  # one file a month


def test_counters_sit_above_the_last_shuffle(writes):
    for plan in writes[1].values():
        lines = plan.splitlines()
        counters = [i for i, line in enumerate(lines) if "CollectMetrics" in line]
        moved = [i for i, line in enumerate(lines) if line in shuffles(plan)]
        assert not moved or not counters or max(counters) < min(moved)
    assert "CollectMetrics" in writes[1]["silver/yellow_tripdata"] and "REBALANCE" in writes[1]["silver/yellow_tripdata"]


def test_a_run_over_one_month_has_no_second_shuffle(spark):
    df = spark.createDataFrame([at(1)], TYPED_TRIP)
    counted = cleansing.cleanse(df, [JAN], count_copies=True).counted
    assert len(shuffles(plan_text(lake.by_month(cleansing.judged(counted), [JAN]), "simple"))) == 1
    assert len(shuffles(plan_text(lake.by_month(cleansing.judged(counted), [JAN, FEB]), "simple"))) == 2


def test_orphans_with_null_keys(spark):
    trips = spark.createDataFrame([(1, 7), (1, None), (9, 9), (9, 8), (None, 9)], "pu int, do int")
    zones = spark.createDataFrame([(1,), (7,), (8,)], "location_id int")
    found = {(r["column"], r["key"]): r["rows"] for r in quality.orphans(trips, ["pu", "do"], zones, "location_id").collect()}
    assert found == {("pu", 9): 2, ("pu", None): 1, ("do", None): 1, ("do", 9): 2}
