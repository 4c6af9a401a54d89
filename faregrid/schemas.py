"""Table contracts and fixed values.

Everything in the "fixed values" block (rule bounds, keys, metric names,
column contracts) must equal the source system's for results and outputs to
match; the code that uses them is our own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must match the original pipeline) -----------------------
# Business rules applied after deduplication.
FARE_MIN = 0.0
FARE_MAX = 5000.0
DISTANCE_MAX = 200.0
PASSENGER_MAX = 9

# Columns whose NULL sends a raw row to quarantine.
REQUIRED_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "total_amount",
)

# Columns forced to a numeric type by the tolerant cast.
INT_CAST_COLUMNS = ("passenger_count",)
DOUBLE_CAST_COLUMNS = ("trip_distance", "fare_amount", "total_amount", "tip_amount", "tolls_amount")

# Deduplication key of a trip.
DEDUP_KEYS = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime")

# Natural key hashed into trip_id (sha-256 of the '|'-joined text).
TRIP_ID_PARTS = ("VendorID", "tpep_pickup_datetime", "PULocationID")
TRIP_ID_SEPARATOR = "|"

# Minimum fact rows per month demanded by the quality gate.
MIN_ROWS_PER_MONTH = 100_000

# Report settings: default number of boroughs shown, distance window, bins.
REPORT_DEFAULT_BOROUGHS = 3
REPORT_DISTANCE_LOW = 0.0
REPORT_DISTANCE_HIGH = 50.0
REPORT_DISTANCE_BINS = 10

# Rolling revenue window: the current day and the six calendar days before.
ROLLING_DAYS = 7

# Metric names (records {metric, value, ts, tags}).
METRIC_INGESTION_SIZE_MB = "ingestion_size_mb"
METRIC_JOB_DURATION = "job_duration_seconds"
METRIC_CLEANSING_IN = "cleansing_records_in"
METRIC_CLEANSING_OUT = "cleansing_records_out"
METRIC_CLEANSING_DROP_RATE = "cleansing_drop_rate"
METRIC_JOIN_OUT = "join_records_out"
METRIC_AGG_HOURLY_ROWS = "agg_hourly_rows"
METRIC_AGG_DAILY_ROWS = "agg_daily_rows"
METRIC_FACT_ROWS = "fact_trips_rows"
METRIC_FRESHNESS_LAG = "data_freshness_lag_seconds"
# Data-quality metric per check kind.
DQ_METRIC = {
    "not_null": "dq_null_count",
    "unique": "dq_duplicate_count",
    "between": "dq_out_of_range",
    "foreign_key": "dq_referential_orphans",
    "row_count": "dq_row_count",
}
# Job names of the timed stages.
JOB_CLEANSING = "cleansing_job"
JOB_JOIN = "join_job"
JOB_WINDOWED_AGG = "windowed_agg_job"

# Table contracts: column names, types and order of the raw input and outputs.
RAW_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
    ]
)

# Zone lookup as published (CSV header names).
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

ZONE_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}

# Roles of the zone lookup: foreign key -> {lookup column: column on the trip}.
ZONE_ROLES = {
    "PULocationID": {"borough": "pickup_borough", "zone": "pickup_zone", "service_zone": "pickup_service_zone"},
    "DOLocationID": {"borough": "dropoff_borough", "zone": "dropoff_zone"},
}
LOCATION_ROLES = {
    "PULocationID": {"location_sk": "pickup_location_sk"},
    "DOLocationID": {"location_sk": "dropoff_location_sk"},
}

# Measures of the trip aggregates: output name -> (function, trip column; None counts trips).
HOURLY_MEASURES = {
    "trip_count": ("count", None),
    "total_fare": ("sum", "fare_amount"),
    "avg_fare": ("mean", "fare_amount"),
    "avg_distance": ("mean", "trip_distance"),
    "avg_duration_minutes": ("mean", "trip_duration_minutes"),
    "total_tips": ("sum", "tip_amount"),
}
DAILY_MEASURES = {"trip_count": ("count", None), "revenue": ("sum", "total_amount"), "avg_distance": ("mean", "trip_distance")}

FACT_COLUMNS = (
    "trip_id",
    "pickup_date_sk",
    "pickup_location_sk",
    "dropoff_location_sk",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "pickup_hour",
    "year",
    "month",
)

DIM_LOCATION_COLUMNS = ("location_sk", "location_id", "borough", "zone", "service_zone")

DIM_DATE_COLUMNS = (
    "full_date",
    "date_sk",
    "year",
    "month",
    "day",
    "day_of_week",
    "week_of_year",
    "is_weekend",
    "quarter",
)
# ---------------------------------------------------------------------------
