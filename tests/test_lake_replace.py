"""Landing keeps every row; a re-run replaces all of its months; the schema gate and drift between months."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faregrid.plans import jobs
from faregrid.plans.metrics import MetricsRecorder
from faregrid.sources import lake
from tests.conftest import TEXT_TRIP, TYPED_TRIP, trip

JAN, FEB = (2023, 1), (2023, 2)


def put(spark, layout, rows, month, schema=TYPED_TRIP, change=lambda df: df):
    change(spark.createDataFrame(rows, schema)).write.mode("overwrite").parquet(f"{layout.raw_trips}/year={month[0]}/month={month[1]}")


def counts(spark, path):
    return spark.read.parquet(path).count() if lake.stored_months(spark, path) else 0


def test_landing_keeps_rows_without_pickup_and_late_rows(spark):
    layout = jobs.scratch_layout(spark)
    feed = spark.createDataFrame([trip(), trip(vendor=2), trip(pickup=None)], TYPED_TRIP)
    assert lake.land_raw(spark, feed, layout, [JAN, FEB]) == [JAN]  # only the month written
    assert counts(spark, layout.raw_trips) == 3 and lake.landed_months(spark, layout) == {JAN}
    rec = MetricsRecorder()
    jobs.cleanse(spark, layout, [JAN], rec)
    assert counts(spark, layout.quarantine) == 1 and rec.get("cleansing_records_in", year=2023, month=1) == [3.0]
    late = spark.createDataFrame([trip(), trip(pickup=datetime(2022, 12, 31, 23, 0))], TYPED_TRIP).withColumns({"year": F.lit(2023), "month": F.lit(1)})
    other = jobs.scratch_layout(spark)
    lake.land_raw(spark, late, other, [JAN])
    assert counts(spark, other.raw_trips) == 2
    jobs.cleanse(spark, other, [JAN], rec)
    assert counts(spark, other.silver_trips) == 1


def test_rerun_replaces_a_month_that_became_empty(spark):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [trip()], JAN)
    jobs.cleanse(spark, layout, [JAN], MetricsRecorder())
    assert counts(spark, layout.silver_trips) == 1
    put(spark, layout, [trip(vendor=None)], JAN)
    rec = MetricsRecorder()
    jobs.cleanse(spark, layout, [JAN], rec)
    assert counts(spark, layout.silver_trips) == 0 and counts(spark, layout.quarantine) == 1
    assert rec.get("cleansing_records_out", year=2023, month=1) == [0.0] and rec.get("cleansing_drop_rate", year=2023, month=1) == [1.0]
    put(spark, layout, [trip()], JAN)
    jobs.cleanse(spark, layout, [JAN], MetricsRecorder())
    assert counts(spark, layout.silver_trips) == 1 and counts(spark, layout.quarantine) == 0


@pytest.mark.parametrize("column", ["fare_amount", "VendorID"])
def test_missing_required_column_quarantines_the_month(spark, column):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [trip(), trip(vendor=2)], JAN, change=lambda df: df.drop(column))
    jobs.cleanse(spark, layout, [JAN], MetricsRecorder())
    assert counts(spark, layout.silver_trips) == 0 and counts(spark, layout.quarantine) == 2


def test_quarantine_keeps_the_offending_value(spark):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [trip(passengers="abc", distance="1", fare="1", total="1", tip="0", tolls="0"),
                        trip(passengers="2", distance="1", fare="1", total="1", tip="0", tolls="0")], JAN, TEXT_TRIP)
    jobs.cleanse(spark, layout, [JAN], MetricsRecorder())
    bad = spark.read.parquet(layout.quarantine).first()
    assert (bad["passenger_count"], bad["quarantine_reason"]) == ("abc", "passenger_count")




def test_months_of_different_types(spark):
    layout = jobs.scratch_layout(spark)
    put(spark, layout, [trip()], JAN, change=lambda df: df.withColumns({"VendorID": F.col("VendorID").cast("long"), "passenger_count": F.col("passenger_count").cast("double")}))
    put(spark, layout, [trip(pickup=datetime(2023, 2, 3), dropoff=datetime(2023, 2, 3, 1)), trip(vendor=None, pickup=datetime(2023, 2, 3))], FEB,
        change=lambda df: df.withColumn("passenger_count", F.col("passenger_count").cast("long")))
    for months in ([JAN, FEB], [FEB], [JAN]):
        jobs.cleanse(spark, layout, months, MetricsRecorder())
        assert lake.stored_months(spark, layout.silver_trips) >= set(months)
    assert counts(spark, layout.silver_trips) == 2 and counts(spark, layout.quarantine) == 1
