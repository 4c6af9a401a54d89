import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faregrid.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8, app="faregrid-tests")


# Typed raw trips: the required columns plus tip/tolls (as in the monthly files).
TYPED_TRIP = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
    ]
)

# Raw trips whose numeric columns arrive as text.
TEXT_TRIP = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.StringType()),
        T.StructField("trip_distance", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("fare_amount", T.StringType()),
        T.StructField("total_amount", T.StringType()),
        T.StructField("tip_amount", T.StringType()),
        T.StructField("tolls_amount", T.StringType()),
    ]
)


def trip(vendor=1, pickup=datetime(2023, 1, 1, 8, 0), dropoff=datetime(2023, 1, 1, 8, 30), passengers=2,
         distance=3.5, pu=10, do=20, fare=12.5, total=15.0, tip=1.0, tolls=0.0):
    return (vendor, pickup, dropoff, passengers, distance, pu, do, fare, total, tip, tolls)


@pytest.fixture
def trips(spark):
    def make(rows, schema=TYPED_TRIP):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [(132, "Queens", "JFK Airport", "Airports"), (236, "Manhattan", "Upper East Side North", "Yellow Zone"),
         (10, "Queens", "Baisley Park", "Boro Zone"), (20, "Bronx", "Belmont", "Boro Zone")],
        "location_id int, borough string, zone string, service_zone string",
    )


def plan_text(df, mode="formatted"):
    """The physical plan as printed by ``DataFrame.explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
