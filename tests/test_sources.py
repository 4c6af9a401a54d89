from datetime import datetime

from pyspark.sql import functions as F

from faregrid.plans import jobs
from faregrid.sources import fixture, lake
from tests.conftest import SF_SMALL, TYPED_TRIP, trip


def test_zone_csv_round_trip_with_declared_schema(spark):
    layout = jobs.scratch_layout(spark)
    zones = fixture.zones(spark, SF_SMALL)
    assert lake.land_zones(spark, zones, layout) is True
    assert lake.land_zones(spark, zones, layout) is False  # already landed: kept
    read = lake.read_zones(spark, layout)
    assert read.columns == ["location_id", "borough", "zone", "service_zone"]
    assert dict(read.dtypes)["location_id"] == "int"
    assert read.count() == 25 and read.filter("service_zone IS NULL").count() == 0


def test_fixture_raw_trips_shape(spark):
    raw = fixture.raw_trips(spark, SF_SMALL)
    assert [f.name for f in raw.schema] == [f.name for f in TYPED_TRIP]
    assert dict(raw.dtypes)["passenger_count"] == "double"
    # every 20th order is delivered twice
    dups = raw.groupBy(*raw.columns).count().filter("count > 1").count()
    assert dups > 0


def test_land_raw_partitions_by_pickup_month_and_skips_landed(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame(
        [trip(), trip(pickup=datetime(2023, 2, 3, 8), dropoff=datetime(2023, 2, 3, 9))], TYPED_TRIP
    )
    assert lake.land_raw(spark, feed, layout, [(2023, 1)]) == [(2023, 1)]
    assert lake.land_raw(spark, feed, layout, [(2023, 1), (2023, 2)]) == [(2023, 2)]
    assert lake.landed_months(spark, layout) == {(2023, 1), (2023, 2)}
    raw = lake.read_raw(spark, layout, [(2023, 2)])
    assert raw.count() == 1 and raw.select(F.col("month")).first()[0] == 2


def test_read_partitioned_keeps_partition_columns(spark):
    layout = jobs.scratch_layout(spark)
    df = spark.createDataFrame([(2023, 1, 1.0), (2023, 2, 2.0)], "year int, month int, v double")
    lake.write_partitioned(df, layout.fact_trips, ["year", "month"])
    back = lake.read_partitioned(spark, layout.fact_trips)
    assert {"year", "month", "v"} <= set(back.columns) and back.count() == 2
    # dynamic overwrite: rewriting month 2 leaves month 1
    lake.write_partitioned(spark.createDataFrame([(2023, 2, 5.0)], "year int, month int, v double"),
                           layout.fact_trips, ["year", "month"])
    rows = {(r["month"], r["v"]) for r in lake.read_partitioned(spark, layout.fact_trips).collect()}
    assert rows == {(1, 1.0), (2, 5.0)}
