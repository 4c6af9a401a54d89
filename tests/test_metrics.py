import json
from datetime import datetime

from pyspark.sql import functions as F

from faregrid.operators import cleansing as C
from faregrid.plans import metrics as M
from tests.conftest import trip


def test_drop_rate_value_and_empty_month():
    assert M.drop_rate_value(3, 2) == round(1 - 2 / 3, 4)
    assert M.drop_rate_value(0, 0) is None  # no division by zero on an empty month
    assert M.drop_rate_value(None, None) is None


def test_drop_rate_query_per_month(trips):
    raw = trips([trip(), trip(pickup=datetime(2023, 2, 1, 8), dropoff=datetime(2023, 2, 1, 8, 30)),
                 trip(pickup=datetime(2023, 2, 2, 8), dropoff=datetime(2023, 2, 2, 8, 30), fare=-1.0)])
    clean = C.cleanse(raw, [(2023, 1), (2023, 2)]).clean
    rows = {(r["year"], r["month"]): r for r in M.drop_rate(raw, clean).collect()}
    assert rows[(2023, 1)]["drop_rate"] == 0.0
    assert rows[(2023, 2)]["records_in"] == 2 and rows[(2023, 2)]["drop_rate"] == 0.5


def test_recorder_timer_dump_and_dataframe(spark, tmp_path):
    rec = M.MetricsRecorder()
    try:
        with rec.timer("job_x", year=2023):
            raise RuntimeError("boom")
    except RuntimeError:
        pass
    rec.record("rows", 5, table="t", column=None)
    assert rec.get("job_duration_seconds", job="job_x") and rec.records[1]["tags"] == {"table": "t"}
    assert json.loads(rec.dumps())[1]["value"] == 5.0
    df = rec.to_dataframe(spark)
    assert df.count() == 2 and df.schema["tags"].dataType.simpleString() == "map<string,string>"
    rec.write(spark, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2


def test_freshness(trips):
    df = trips([trip(pickup=datetime(2023, 1, 1, 8)), trip(pickup=datetime(2023, 1, 2, 8))])
    r = M.freshness(df, "silver", "2023-01-03 08:00:00").first()
    assert r["lag_seconds"] == 86400 and r["last_pickup"] == datetime(2023, 1, 2, 8)


def test_period_filter_same_rows_for_timestamp_and_ntz(trips):
    df = trips([trip(pickup=datetime(2023, 1, 31, 23, 59)), trip(pickup=datetime(2023, 2, 1, 0, 0)),
                trip(pickup=datetime(2022, 12, 31, 23, 59))])
    ntz = df.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    for bound in ("half_open", "reference"):
        a = sorted(r[0] for r in C.period_filter(df, [(2023, 1)], bound).select("VendorID").collect())
        b = sorted(r[0] for r in C.period_filter(ntz, [(2023, 1)], bound).select("VendorID").collect())
        assert len(a) == len(b)
    assert C.period_filter(ntz, [(2023, 1)]).count() == 1
