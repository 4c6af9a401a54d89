import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from faregrid.operators import DataQualityFailure, dim_date, dim_location, enforce, fact_trips, run_checks
from faregrid.operators import quality as Q
from faregrid.schemas import FACT_COLUMNS
from tests.conftest import plan_text


def test_dim_date_attributes(spark):
    d = dim_date(spark, "2023-01-01", "2023-12-31")
    assert d.count() == 365
    r = d.filter(F.col("full_date") == F.lit(date(2023, 1, 1))).first()
    assert r["date_sk"] == 20230101 and r["day_of_week"] == 1 and r["week_of_year"] == 52
    assert r["is_weekend"] is True and r["quarter"] == 1 and r["day"] == 1
    assert d.columns == ["full_date", "date_sk", "year", "month", "day", "day_of_week", "week_of_year",
                         "is_weekend", "quarter"]


def test_dim_location(zones):
    d = dim_location(zones)
    assert d.columns == ["location_sk", "location_id", "borough", "zone", "service_zone"]
    assert d.filter("location_sk != location_id").count() == 0


@pytest.fixture
def enriched(spark):
    return spark.createDataFrame(
        [
            (132, 236, 1, datetime(2023, 1, 10, 8, 0), datetime(2023, 1, 10, 8, 30), 2, 3.5, 30.0, 12.5, 1.5, 0.0,
             15.0, date(2023, 1, 10), 8, 2023, 1),
            (999, 132, 2, datetime(2023, 1, 10, 9, 0), datetime(2023, 1, 10, 9, 20), 1, 2.0, 20.0, 9.0, 1.0, 0.0,
             11.0, date(2023, 1, 10), 9, 2023, 1),
        ],
        "PULocationID int, DOLocationID int, VendorID int, tpep_pickup_datetime timestamp, "
        "tpep_dropoff_datetime timestamp, passenger_count int, trip_distance double, trip_duration_minutes double, "
        "fare_amount double, tip_amount double, tolls_amount double, total_amount double, pickup_date date, "
        "pickup_hour int, year int, month int",
    )


def test_fact_trips(spark, enriched, zones):
    f = fact_trips(enriched, dim_location(zones), dim_date(spark, "2023-01-01", "2023-12-31"))
    assert tuple(f.columns) == FACT_COLUMNS
    rows = {r["VendorID"]: r for r in f.collect()}
    assert rows[1]["pickup_location_sk"] == 132 and rows[1]["dropoff_location_sk"] == 236
    assert rows[1]["pickup_date_sk"] == 20230110
    assert rows[2]["pickup_location_sk"] is None  # unknown zone: orphan key, trip kept
    want = hashlib.sha256(b"1|2023-01-10 08:00:00|132").hexdigest()
    assert rows[1]["trip_id"] == want


def test_fact_joins_are_broadcast(spark, enriched, zones):
    f = fact_trips(enriched, dim_location(zones), dim_date(spark, "2023-01-01", "2023-12-31"))
    plan = plan_text(f)
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan


def test_trip_id_collision_is_reported(spark, enriched, zones):
    # same vendor, pickup and zone, different dropoff: one trip_id for two trips
    dup = enriched.filter("VendorID = 1").withColumn("tpep_dropoff_datetime", F.col("tpep_dropoff_datetime") + F.expr("INTERVAL 5 MINUTES"))
    f = fact_trips(enriched.unionByName(dup), dim_location(zones), dim_date(spark, "2023-01-01", "2023-12-31"))
    r = run_checks(f, [Q.unique("trip_id")]).first()
    assert r["observed"] == 1 and r["status"] == "FAIL"


@pytest.fixture
def ids(spark):
    return spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "id int, val double")


def status(df, checks):
    return [(r["check"], r["observed"], r["status"]) for r in run_checks(df, checks).orderBy("check_order").collect()]


def test_not_null_passes_and_fails(spark, ids):
    assert status(ids, [Q.not_null("id")]) == [("not_null", 0, "PASS")]
    with_null = spark.createDataFrame([(1,), (None,)], "id int")
    assert status(with_null, [Q.not_null("id")]) == [("not_null", 1, "FAIL")]
    with pytest.raises(DataQualityFailure):
        enforce(run_checks(with_null, [Q.not_null("id")]))


def test_uniqueness_passes_and_fails(spark, ids):
    assert status(ids, [Q.unique("id")]) == [("unique", 0, "PASS")]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    with pytest.raises(DataQualityFailure):
        enforce(run_checks(dup, [Q.unique("id")]))


def test_uniqueness_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "id int")
    assert status(df, [Q.unique("id")]) == [("unique", 1, "FAIL")]


def test_range_passes_fails_and_ignores_null(spark):
    df = spark.createDataFrame([(10.0,), (100.0,), (None,)], "amount double")
    assert status(df, [Q.between("amount", 0.0, 1000.0)]) == [("between", 0, "PASS")]
    assert status(df, [Q.between("amount", 0.0, 50.0)]) == [("between", 1, "FAIL")]


def test_row_count_threshold(ids):
    enforce(run_checks(ids, [Q.row_count(2)]))
    with pytest.raises(DataQualityFailure):
        enforce(run_checks(ids, [Q.row_count(10)]))


def test_foreign_key_only_warns_and_counts_null_as_orphan(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (7,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "pk int")
    res = run_checks(fact, [Q.foreign_key("fk", dim, "pk")])
    assert status(fact, [Q.foreign_key("fk", dim, "pk")]) == [("foreign_key", 2, "WARN")]
    enforce(res)  # warning only: does not raise


def test_gate_order_first_failure_raises(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 6000.0)], "trip_id string, fare_amount double")
    res = run_checks(df, [Q.between("fare_amount", 0, 5000), Q.not_null("trip_id")])
    with pytest.raises(DataQualityFailure, match="between"):
        enforce(res)


def test_checks_grouped_by_month_in_one_pass(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "b")], "year int, month int, trip_id string")
    rows = {(r["month"], r["check"]): r["observed"] for r in run_checks(df, [Q.unique("trip_id"), Q.row_count(0)],
                                                                       by=("year", "month")).collect()}
    assert rows == {(1, "unique"): 1, (1, "row_count"): 2, (2, "unique"): 0, (2, "row_count"): 1}


def test_expectation_suite_compiles_in_order():
    checks = Q.compile_suite(Q.EXPECTATION_SUITE)
    assert [(c.kind, c.column) for c in checks] == [
        ("not_null", "trip_id"), ("unique", "trip_id"), ("between", "fare_amount"), ("between", "trip_distance"),
        ("row_count", None), ("not_null", "tpep_pickup_datetime"), ("between", "passenger_count"),
    ]
    assert checks[4].low == 100000 and checks[4].high == 50000000


def test_uniqueness_tells_texts_apart_that_share_their_bytes(spark):
    digest = "ab" * 32
    ids = [digest, digest, digest.upper(), "ab", "", None, None, digest + "\n", bytes.fromhex(digest).decode("latin-1")]
    df = spark.createDataFrame([(i,) for i in ids], "trip_id string")
    assert run_checks(df, [Q.unique("trip_id")]).collect()[0]["observed"] == 2
    # a digest in hex is shuffled as its bytes
    assert "unhex" in plan_text(run_checks(df, [Q.unique("trip_id")]))
