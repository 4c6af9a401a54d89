from datetime import date

import pytest

from faregrid.functions.joins import DuplicateKeyError
from faregrid.operators import daily_stats, hourly_stats, join_zones, rolling_revenue
from tests.conftest import plan_text


@pytest.fixture
def small_trips(spark):
    return spark.createDataFrame([(1, 132, 236), (2, 236, 132), (3, 999, 132)],
                                 "VendorID int, PULocationID int, DOLocationID int")


def test_join_zones_attaches_boroughs(small_trips, zones):
    rows = {r["VendorID"]: r for r in join_zones(small_trips, zones).collect()}
    assert rows[1]["pickup_borough"] == "Queens" and rows[1]["dropoff_borough"] == "Manhattan"
    assert rows[2]["pickup_borough"] == "Manhattan" and rows[2]["pickup_service_zone"] == "Yellow Zone"


def test_join_zones_unknown_location_is_null(small_trips, zones):
    row = join_zones(small_trips, zones).filter("VendorID = 3").first()
    assert row["pickup_borough"] is None and row["pickup_zone"] is None


def test_join_zones_preserves_count(small_trips, zones):
    assert join_zones(small_trips, zones).count() == 3


def test_join_zones_columns(small_trips, zones):
    cols = join_zones(small_trips, zones).columns
    assert cols[:2] == ["DOLocationID", "PULocationID"]
    assert cols[-5:] == ["pickup_borough", "pickup_zone", "pickup_service_zone", "dropoff_borough", "dropoff_zone"]


def test_join_zones_rejects_duplicate_keys(small_trips, zones):
    with pytest.raises(DuplicateKeyError):
        join_zones(small_trips, zones.unionByName(zones))


def test_join_zones_is_broadcast(small_trips, zones):
    plan = plan_text(join_zones(small_trips, zones))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.fixture
def two_days(spark):
    """Trips of two days with a NULL borough and NULL measures."""
    rows = [
        (date(2024, 2, 28), 23, "Bronx", 1.25, 6.0, 7.5, None, 8.0),
        (date(2024, 2, 28), 23, None, 4.0, 10.0, None, 1.0, 11.0),
        (date(2024, 2, 29), 0, "Bronx", None, 5.0, 4.5, 0.5, 5.5),
        (date(2024, 2, 29), 0, "Bronx", 2.75, 7.0, 5.5, 0.25, 7.25),
        (date(2024, 2, 29), 6, "Bronx", 10.0, 40.0, 60.0, 9.0, 50.0),
    ]
    return spark.createDataFrame(
        rows, "pickup_date date, pickup_hour int, pickup_borough string, trip_distance double, fare_amount double, "
        "trip_duration_minutes double, tip_amount double, total_amount double",
    )


def test_hourly_statistics_keep_a_null_borough_and_skip_null_measures(two_days):
    rows = {(r["pickup_date"].day, r["pickup_hour"], r["pickup_borough"]): r for r in hourly_stats(two_days).collect()}
    assert {k: r["trip_count"] for k, r in rows.items()} == {(28, 23, "Bronx"): 1, (28, 23, None): 1, (29, 0, "Bronx"): 2, (29, 6, "Bronx"): 1}
    midnight = rows[29, 0, "Bronx"]
    assert (midnight["total_fare"], midnight["total_tips"], midnight["avg_distance"], midnight["avg_duration_minutes"]) == (12.0, 0.75, 2.75, 5.0)
    assert rows[28, 23, "Bronx"]["total_tips"] is None and rows[28, 23, None]["avg_duration_minutes"] is None


def test_daily_statistics_sum_over_hours(two_days):
    rows = {(r["pickup_date"].day, r["pickup_borough"]): (r["trip_count"], r["revenue"]) for r in daily_stats(two_days).collect()}
    assert rows == {(28, "Bronx"): (1, 8.0), (28, None): (1, 11.0), (29, "Bronx"): (3, 62.75)}


def test_rolling_counts_calendar_days_with_gaps(spark):
    daily = spark.createDataFrame(
        [(date(2023, 1, 1), "Q", 1.0), (date(2023, 1, 7), "Q", 2.0), (date(2023, 1, 8), "Q", 4.0),
         (date(2023, 1, 1), None, 5.0), (date(2023, 1, 2), None, 6.0), (date(2023, 1, 2), "M", 7.0)],
        "pickup_date date, pickup_borough string, revenue double",
    )
    out = {(r["pickup_date"], r["pickup_borough"]): r["rolling_7d_revenue"] for r in rolling_revenue(daily).collect()}
    assert out[(date(2023, 1, 1), "Q")] == 1.0
    assert out[(date(2023, 1, 7), "Q")] == 3.0
    assert out[(date(2023, 1, 8), "Q")] == 6.0  # Jan 1 has left the window
    assert out[(date(2023, 1, 2), None)] == 11.0  # NULL borough is its own partition
    assert out[(date(2023, 1, 2), "M")] == 7.0


def test_checked_broadcast_falls_back_to_a_shuffle_join_above_the_limit(spark, small_trips, zones):
    from faregrid.functions.joins import checked_broadcast

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # leave the choice to the check
    try:
        big = checked_broadcast(zones, "location_id", max_rows=2)  # 4 rows > 2: not marked
        plan = plan_text(small_trips.join(big, small_trips.PULocationID == big.location_id, "left"))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        small = checked_broadcast(zones, "location_id", max_rows=10)
        plan = plan_text(small_trips.join(small, small_trips.PULocationID == small.location_id, "left"))
        assert "BroadcastHashJoin" in plan
        # a bound proven by construction skips the measuring job but still broadcasts
        proven = checked_broadcast(zones, "location_id", max_rows=10, proven_rows=4)
        assert "BroadcastHashJoin" in plan_text(small_trips.join(proven, small_trips.PULocationID == proven.location_id))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
