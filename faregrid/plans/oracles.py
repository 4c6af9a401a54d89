"""Independent SQL for each registered query, for DuckDB over the base tables.

Each string is self-contained: it re-derives ``raw_trips`` and ``zones`` from
``lineitem``, ``orders``, ``nation`` and ``region`` and then states the stage
in plain SQL (window ``row_number`` for the dedup survivor, LEFT JOINs for
enrichment, UNION ALL of per-check selects for quality), so it checks the
Spark operators rather than repeating them. Types are cast to Spark's
(INTEGER hours, BIGINT sums) and aggregated doubles are rounded as in
``catalog.present``.
"""

from __future__ import annotations

from faregrid.plans.catalog import FRESHNESS_AS_OF, ONE_MONTH
from faregrid.schemas import REQUIRED_COLUMNS

PERIOD_START = "(SELECT date_trunc('month', min(o_orderdate)) FROM orders)"
PERIOD_END = "(SELECT date_trunc('month', max(o_orderdate) + INTERVAL '1' DAY) + INTERVAL '1' MONTH FROM orders)"
IN_ONE_MONTH = "year(tpep_pickup_datetime) = {} AND month(tpep_pickup_datetime) = {}".format(*ONE_MONTH)

RAW_COLS = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
    "PULocationID, DOLocationID, fare_amount, total_amount, tip_amount, tolls_amount"
)

CTE = {}

CTE["raw_trips"] = f"""
raw_trips AS (
  WITH base AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           CAST(floor(l_extendedprice * 1e2 + 5e-1) AS BIGINT) AS cents,
           CAST(floor(l_discount * 1e2 + 5e-1) AS BIGINT) AS tip,
           CAST(floor(l_tax * 1e2 + 5e-1) AS BIGINT) AS tolls,
           o_orderdate + CAST((l_partkey * 7) % 1440 AS INT) * INTERVAL '1' MINUTE AS pu
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  one AS (
    SELECT CAST(l_linenumber % 2 + 1 AS INT) AS VendorID,
           pu AS tpep_pickup_datetime,
           pu + (CAST(l_quantity AS INT) - 3) * INTERVAL '1' MINUTE AS tpep_dropoff_datetime,
           CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE CAST(l_linenumber * 2 - 2 AS DOUBLE) END AS passenger_count,
           CAST(floor(cents / 5e2) AS DOUBLE) / 1e2 AS trip_distance,
           CAST(l_suppkey % 25 AS INT) AS PULocationID,
           CAST(l_partkey % 28 AS INT) AS DOLocationID,
           (CAST(floor(cents / 2e1) AS DOUBLE) - 1e4) / 1e2 AS fare_amount,
           (CAST(floor(cents / 2e1) AS DOUBLE) - 1e4 + tip * 1e2 + tolls * 1e2) / 1e2 AS total_amount,
           CAST(tip AS DOUBLE) AS tip_amount,
           CAST(tolls AS DOUBLE) AS tolls_amount,
           l_orderkey AS src_key
    FROM base)
  SELECT {RAW_COLS} FROM one
  UNION ALL
  SELECT {RAW_COLS} FROM one WHERE src_key % 20 = 0)"""

CTE["zones"] = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CTE["casted"] = """
casted AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
         CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
         trip_distance, PULocationID, DOLocationID, fare_amount, total_amount, tip_amount, tolls_amount
  FROM raw_trips)"""

NULL_ANY = (
    "(VendorID IS NULL OR tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL OR passenger_count IS NULL "
    "OR trip_distance IS NULL OR PULocationID IS NULL OR DOLocationID IS NULL OR fare_amount IS NULL "
    "OR total_amount IS NULL)"
)

CTE["good"] = f"""
good AS (SELECT * FROM casted WHERE NOT {NULL_ANY})"""

FAILED_COLUMNS = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in REQUIRED_COLUMNS)

CTE["bad"] = f"""
bad AS (SELECT * FROM casted WHERE {NULL_ANY})"""

CTE["in_period"] = f"""
in_period AS (
  SELECT * FROM good
  WHERE tpep_pickup_datetime >= {PERIOD_START} AND tpep_pickup_datetime < {PERIOD_END})"""

CTE["deduped"] = """
deduped AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, fare_amount, total_amount, tip_amount, tolls_amount
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime
      ORDER BY passenger_count NULLS FIRST, trip_distance NULLS FIRST, PULocationID NULLS FIRST,
               DOLocationID NULLS FIRST, fare_amount NULLS FIRST, total_amount NULLS FIRST,
               tip_amount NULLS FIRST, tolls_amount NULLS FIRST) AS rn
    FROM in_period) t
  WHERE rn = 1)"""

RULES = """fare_amount BETWEEN 0 AND 5000 AND trip_distance > 0 AND trip_distance <= 200
    AND passenger_count > 0 AND passenger_count <= 9 AND tpep_dropoff_datetime > tpep_pickup_datetime"""

CTE["ruled"] = f"""
ruled AS (SELECT * FROM deduped WHERE {RULES})"""


def _derived(src: str) -> str:
    return f"""SELECT *,
         CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
         (floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60 AS trip_duration_minutes,
         CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
  FROM {src}"""


CTE["clean"] = f"""
clean AS (
  {_derived("ruled")})"""

CTE["enriched"] = """
enriched AS (
  SELECT c.*, zp.borough AS pickup_borough, zp.zone AS pickup_zone, zp.service_zone AS pickup_service_zone,
         zd.borough AS dropoff_borough, zd.zone AS dropoff_zone
  FROM clean c
  LEFT JOIN zones zp ON c.PULocationID = zp.location_id
  LEFT JOIN zones zd ON c.DOLocationID = zd.location_id)"""

CTE["hourly"] = """
hourly AS (
  SELECT pickup_date, pickup_hour, pickup_borough,
         count(*) AS trip_count,
         sum(fare_amount) AS total_fare,
         avg(fare_amount) AS avg_fare,
         avg(trip_distance) AS avg_distance,
         avg(trip_duration_minutes) AS avg_duration_minutes,
         sum(tip_amount) AS total_tips
  FROM enriched GROUP BY pickup_date, pickup_hour, pickup_borough)"""

CTE["daily"] = """
daily AS (
  SELECT pickup_date, pickup_borough,
         count(*) AS trip_count,
         sum(total_amount) AS revenue,
         avg(trip_distance) AS avg_distance
  FROM enriched GROUP BY pickup_date, pickup_borough)"""

CTE["rolling"] = """
rolling AS (
  SELECT *, sum(revenue) OVER (
      PARTITION BY pickup_borough ORDER BY pickup_date
      RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS rolling_7d_revenue
  FROM daily)"""

CTE["dim_location"] = """
dim_location AS (
  SELECT location_id AS location_sk, location_id, borough, zone, service_zone FROM zones)"""

CTE["dim_date"] = f"""
dim_date AS (
  SELECT CAST(d AS DATE) AS full_date,
         CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk,
         CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         dayofweek(d) IN (0, 6) AS is_weekend,
         CAST(quarter(d) AS INTEGER) AS quarter
  FROM (SELECT make_date(year(min(pickup_date)), 1, 1) AS lo, make_date(year(max(pickup_date)), 12, 31) AS hi
        FROM clean) b,
       generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(d))"""

TRIP_ID = (
    "sha256(concat_ws('|', CAST(VendorID AS VARCHAR), CAST(tpep_pickup_datetime AS VARCHAR), "
    "CAST(PULocationID AS VARCHAR)))"
)

CTE["fact"] = f"""
fact AS (
  SELECT {TRIP_ID} AS trip_id,
         dd.date_sk AS pickup_date_sk,
         lp.location_sk AS pickup_location_sk,
         ld.location_sk AS dropoff_location_sk,
         e.VendorID, e.tpep_pickup_datetime, e.tpep_dropoff_datetime, e.passenger_count, e.trip_distance,
         e.trip_duration_minutes, e.fare_amount, e.tip_amount, e.tolls_amount, e.total_amount,
         e.pickup_hour, e.year, e.month
  FROM enriched e
  LEFT JOIN dim_location lp ON e.PULocationID = lp.location_id
  LEFT JOIN dim_location ld ON e.DOLocationID = ld.location_id
  LEFT JOIN dim_date dd ON e.pickup_date = dd.full_date)"""

# Stage dependencies, so each query includes exactly the CTEs it needs.
DEPS = {
    "raw_trips": [],
    "zones": [],
    "casted": ["raw_trips"],
    "good": ["casted"],
    "bad": ["casted"],
    "in_period": ["good"],
    "deduped": ["in_period"],
    "ruled": ["deduped"],
    "clean": ["ruled"],
    "enriched": ["clean", "zones"],
    "hourly": ["enriched"],
    "daily": ["enriched"],
    "rolling": ["daily"],
    "dim_location": ["zones"],
    "dim_date": ["clean"],
    "fact": ["enriched", "dim_location", "dim_date"],
}


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_(needs: list[str], body: str) -> str:
    return "WITH " + ",".join(CTE[n] for n in _closure(needs)) + "\n" + body


def _r2(c: str) -> str:
    return f"round({c}, 2) AS {c}"


def _r4(c: str) -> str:
    return f"round({c} + 1e-9, 4) AS {c}"


def _check(order: int, kind: str, column: str | None, observed: str, threshold: str, status: str, group: str = "") -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (
        f"SELECT {group}CAST({order} AS INTEGER) AS check_order, '{kind}' AS \"check\", {col} AS \"column\", "
        f"CAST({observed} AS BIGINT) AS observed, '{threshold}' AS threshold, {status} AS status"
    )


def _pass_fail(observed: str, fail: str = "FAIL") -> str:
    return f"CASE WHEN {observed} = 0 THEN 'PASS' ELSE '{fail}' END"


GROUP = "year, month, "

FK_JOIN = """fact f
  LEFT JOIN (SELECT DISTINCT location_sk AS k FROM dim_location) pk ON f.pickup_location_sk = pk.k
  LEFT JOIN (SELECT DISTINCT location_sk AS k FROM dim_location) dk ON f.dropoff_location_sk = dk.k"""


def _gate_sql() -> str:
    metrics = f"""
  SELECT year, month,
         count(*) FILTER (WHERE trip_id IS NULL) AS m1,
         count(*) FILTER (WHERE tpep_pickup_datetime IS NULL) AS m2,
         count(*) - count(DISTINCT trip_id) - CASE WHEN count(*) FILTER (WHERE trip_id IS NULL) > 0 THEN 1 ELSE 0 END AS m3,
         count(*) FILTER (WHERE NOT (fare_amount BETWEEN 0.0 AND 5000.0)) AS m4,
         count(*) FILTER (WHERE NOT (trip_distance BETWEEN 0.0 AND 200.0)) AS m5,
         count(*) FILTER (WHERE pk.k IS NULL) AS m6,
         count(*) AS m7
  FROM {FK_JOIN}
  GROUP BY year, month"""
    parts = [
        _check(1, "not_null", "trip_id", "m1", "0", _pass_fail("m1"), GROUP),
        _check(2, "not_null", "tpep_pickup_datetime", "m2", "0", _pass_fail("m2"), GROUP),
        _check(3, "unique", "trip_id", "m3", "0", _pass_fail("m3"), GROUP),
        _check(4, "between", "fare_amount", "m4", "[0.0, 5000.0]", _pass_fail("m4"), GROUP),
        _check(5, "between", "trip_distance", "m5", "[0.0, 200.0]", _pass_fail("m5"), GROUP),
        _check(6, "foreign_key", "pickup_location_sk", "m6", "0", _pass_fail("m6", "WARN"), GROUP),
        _check(7, "row_count", None, "m7", "[100000, inf]", "CASE WHEN m7 >= 100000 THEN 'PASS' ELSE 'FAIL' END", GROUP),
    ]
    return with_(["fact"], f", m AS ({metrics})\n" + "\nUNION ALL\n".join(p + " FROM m" for p in parts))


def _suite_sql() -> str:
    metrics = """
  SELECT count(*) FILTER (WHERE trip_id IS NULL) AS m1,
         count(*) - count(DISTINCT trip_id) - CASE WHEN count(*) FILTER (WHERE trip_id IS NULL) > 0 THEN 1 ELSE 0 END AS m2,
         count(*) FILTER (WHERE NOT (fare_amount BETWEEN 0.0 AND 5000.0)) AS m3,
         count(*) FILTER (WHERE NOT (trip_distance BETWEEN 0.0 AND 200.0)) AS m4,
         count(*) AS m5,
         count(*) FILTER (WHERE tpep_pickup_datetime IS NULL) AS m6,
         count(*) FILTER (WHERE NOT (passenger_count BETWEEN 1.0 AND 9.0)) AS m7
  FROM fact"""
    parts = [
        _check(1, "not_null", "trip_id", "m1", "0", _pass_fail("m1")),
        _check(2, "unique", "trip_id", "m2", "0", _pass_fail("m2")),
        _check(3, "between", "fare_amount", "m3", "[0.0, 5000.0]", _pass_fail("m3")),
        _check(4, "between", "trip_distance", "m4", "[0.0, 200.0]", _pass_fail("m4")),
        _check(5, "row_count", None, "m5", "[100000, 50000000]",
               "CASE WHEN m5 BETWEEN 100000 AND 50000000 THEN 'PASS' ELSE 'FAIL' END"),
        _check(6, "not_null", "tpep_pickup_datetime", "m6", "0", _pass_fail("m6")),
        _check(7, "between", "passenger_count", "m7", "[1.0, 9.0]", _pass_fail("m7")),
    ]
    return with_(["fact"], f", m AS ({metrics})\n" + "\nUNION ALL\n".join(p + " FROM m" for p in parts))


def _not_null_sql() -> str:
    cols = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
            "PULocationID", "DOLocationID", "fare_amount", "total_amount"]
    metrics = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS m{i + 1}" for i, c in enumerate(cols))
    parts = [_check(i + 1, "not_null", c, f"m{i + 1}", "0", _pass_fail(f"m{i + 1}")) for i, c in enumerate(cols)]
    return with_(["casted"], f", m AS (SELECT {metrics} FROM casted)\n" + "\nUNION ALL\n".join(p + " FROM m" for p in parts))


def _range_sql() -> str:
    metrics = """SELECT count(*) FILTER (WHERE NOT (fare_amount BETWEEN 0.0 AND 5000.0)) AS m1,
         count(*) FILTER (WHERE NOT (trip_distance BETWEEN 0.0 AND 200.0)) AS m2,
         count(*) FILTER (WHERE NOT (passenger_count BETWEEN 1.0 AND 9.0)) AS m3
  FROM casted"""
    parts = [
        _check(1, "between", "fare_amount", "m1", "[0.0, 5000.0]", _pass_fail("m1")),
        _check(2, "between", "trip_distance", "m2", "[0.0, 200.0]", _pass_fail("m2")),
        _check(3, "between", "passenger_count", "m3", "[1.0, 9.0]", _pass_fail("m3")),
    ]
    return with_(["casted"], f", m AS ({metrics})\n" + "\nUNION ALL\n".join(p + " FROM m" for p in parts))


def _uniqueness_sql() -> str:
    metrics = """SELECT year, month,
         count(*) - count(DISTINCT trip_id) - CASE WHEN count(*) FILTER (WHERE trip_id IS NULL) > 0 THEN 1 ELSE 0 END AS m1
  FROM fact GROUP BY year, month"""
    return with_(["fact"], f", m AS ({metrics})\n" + _check(1, "unique", "trip_id", "m1", "0", _pass_fail("m1"), GROUP) + " FROM m")


def _row_count_sql() -> str:
    metrics = "SELECT year, month, count(*) AS m1 FROM fact GROUP BY year, month"
    status = "CASE WHEN m1 >= 100000 THEN 'PASS' ELSE 'FAIL' END"
    return with_(["fact"], f", m AS ({metrics})\n" + _check(1, "row_count", None, "m1", "[100000, inf]", status, GROUP) + " FROM m")


def _orphans_sql() -> str:
    metrics = f"""SELECT year, month,
         count(*) FILTER (WHERE pk.k IS NULL) AS m1,
         count(*) FILTER (WHERE dk.k IS NULL) AS m2
  FROM {FK_JOIN} GROUP BY year, month"""
    parts = [
        _check(1, "foreign_key", "pickup_location_sk", "m1", "0", _pass_fail("m1", "WARN"), GROUP),
        _check(2, "foreign_key", "dropoff_location_sk", "m2", "0", _pass_fail("m2", "WARN"), GROUP),
    ]
    return with_(["fact"], f", m AS ({metrics})\n" + "\nUNION ALL\n".join(p + " FROM m" for p in parts))


def _fare_by_distance_sql() -> str:
    """Ten equal-width right-closed bins over [min, max] with interval labels.

    Edges: i * ((hi - lo) / 10) + lo, the top edge is hi and the bottom edge is
    lowered by 0.1 % of the range. Labels print each edge rounded to the
    smallest precision >= 3 that keeps all eleven edges distinct (fractional
    parts keep that many significant digits).
    """
    body = """, sample AS (
  SELECT f.trip_distance, f.fare_amount
  FROM fact f LEFT JOIN dim_location l ON f.pickup_location_sk = l.location_sk
  WHERE f.trip_distance IS NOT NULL AND f.fare_amount IS NOT NULL AND l.borough IS NOT NULL
    AND f.trip_distance > 0 AND f.trip_distance < 50),
ext0 AS (SELECT min(trip_distance) AS lo0, max(trip_distance) AS hi0 FROM sample),
ext AS (
  SELECT lo0, hi0,
         CASE WHEN lo0 = hi0 THEN lo0 - CASE WHEN lo0 <> 0 THEN 0.001 * abs(lo0) ELSE 0.001 END ELSE lo0 END AS lo,
         CASE WHEN lo0 = hi0 THEN hi0 + CASE WHEN hi0 <> 0 THEN 0.001 * abs(hi0) ELSE 0.001 END ELSE hi0 END AS hi
  FROM ext0),
edges AS (
  SELECT i,
         CASE WHEN i = 10 THEN hi
              WHEN i = 0 AND lo0 <> hi0 THEN (CAST(i AS DOUBLE) * ((hi - lo) / 10) + lo) - (hi - lo) * 0.001
              ELSE CAST(i AS DOUBLE) * ((hi - lo) / 10) + lo END AS e
  FROM ext, range(0, 11) r(i)),
prec AS (
  SELECT p, i, e,
         CASE WHEN e = 0 THEN e
              WHEN trunc(e) = 0 THEN round_even(e, CAST(-floor(log10(abs(e))) - 1 + p AS INTEGER))
              ELSE round_even(e, CAST(p AS INTEGER)) END AS re
  FROM edges, range(3, 20) q(p)),
chosen AS (SELECT min(p) AS p FROM (SELECT p FROM prec GROUP BY p HAVING count(DISTINCT re) = 11)),
labels AS (
  SELECT a.i AS bucket, '(' || CAST(b.re AS VARCHAR) || ', ' || CAST(a.re AS VARCHAR) || ']' AS distance_bucket
  FROM prec a JOIN prec b ON b.i = a.i - 1 AND a.p = b.p
  JOIN chosen c ON a.p = c.p
  WHERE a.i >= 1),
binned AS (
  SELECT s.fare_amount,
         1 + (SELECT count(*) FROM edges WHERE i BETWEEN 1 AND 9 AND e < s.trip_distance) AS bucket
  FROM sample s)
SELECT CAST(b.bucket AS INTEGER) AS bucket, l.distance_bucket, round(avg(b.fare_amount) + 1e-9, 4) AS fare_amount
FROM binned b JOIN labels l ON b.bucket = l.bucket
GROUP BY b.bucket, l.distance_bucket"""
    return with_(["fact"], body)


def _revenue_sql() -> str:
    # Default selection: the first three boroughs in sorted order.
    body = """, picked AS (
  SELECT pickup_borough FROM (SELECT DISTINCT pickup_borough FROM rolling WHERE pickup_borough IS NOT NULL)
  ORDER BY pickup_borough LIMIT 3)
SELECT pickup_date,
       round(sum(revenue) FILTER (WHERE pickup_borough = 'AFRICA'), 2) AS "AFRICA",
       round(sum(revenue) FILTER (WHERE pickup_borough = 'AMERICA'), 2) AS "AMERICA",
       round(sum(revenue) FILTER (WHERE pickup_borough = 'ASIA'), 2) AS "ASIA"
FROM rolling WHERE pickup_borough IN (SELECT pickup_borough FROM picked)
GROUP BY pickup_date"""
    return with_(["rolling"], body)


def _stage_counts_sql() -> str:
    stages = ["raw_trips", "bad", "in_period", "deduped", "clean", "enriched", "hourly", "rolling", "fact"]
    names = ["raw", "quarantined", "in_period", "deduplicated", "clean", "enriched", "hourly_stats",
             "daily_stats", "fact_trips"]
    parts = [
        f"SELECT CAST({i + 1} AS INTEGER) AS stage_order, '{n}' AS stage, count(*) AS rows FROM {s}"
        for i, (s, n) in enumerate(zip(stages, names))
    ]
    return with_(stages, "\nUNION ALL\n".join(parts))


def _drop_rate_sql() -> str:
    body = """, rin AS (
  SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
         count(*) AS records_in
  FROM raw_trips GROUP BY 1, 2),
rout AS (SELECT year, month, count(*) AS records_out FROM clean GROUP BY 1, 2)
SELECT COALESCE(rin.year, rout.year) AS year, COALESCE(rin.month, rout.month) AS month,
       COALESCE(records_in, 0) AS records_in, COALESCE(records_out, 0) AS records_out,
       CASE WHEN COALESCE(records_in, 0) > 0 THEN
         CAST(round(CAST(CAST(1 - COALESCE(records_out, 0) / COALESCE(records_in, 0) AS VARCHAR) AS DECIMAL(38, 18)), 4) AS DOUBLE)
       END AS drop_rate
FROM rin FULL OUTER JOIN rout ON rin.year = rout.year AND rin.month = rout.month"""
    return with_(["raw_trips", "clean"], body)


ORACLES: dict[str, str] = {
    "q_scan_raw": with_(["raw_trips"], "SELECT * FROM raw_trips"),
    "q_landed_raw": with_(
        ["raw_trips"],
        "SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, "
        "CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM raw_trips",
    ),
    "q_partition_scan": with_(
        ["raw_trips"],
        "SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, "
        f"CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM raw_trips WHERE {IN_ONE_MONTH}",
    ),
    "q_zones": with_(["zones"], "SELECT * FROM zones"),
    "q_dim_location": with_(["dim_location"], "SELECT * FROM dim_location"),
    "q_cast": with_(["casted"], "SELECT * FROM casted"),
    "q_quarantine_good": with_(["good"], "SELECT * FROM good"),
    # rows as they arrived, with the columns that failed (the raw columns of the test tables are typed: no cast fails)
    "q_quarantine_bad": with_(
        ["raw_trips"],
        f"SELECT *, concat_ws(', ', {FAILED_COLUMNS}) AS quarantine_reason FROM raw_trips WHERE {NULL_ANY}",
    ),
    "q_period_filter": with_(["in_period"], "SELECT * FROM in_period"),
    "q_period_filter_month": with_(
        ["good"],
        f"SELECT * FROM good WHERE {IN_ONE_MONTH}",
    ),
    "q_period_filter_ref": with_(
        ["good"],
        "SELECT * FROM good WHERE tpep_pickup_datetime >= date_trunc('month', tpep_pickup_datetime) "
        "AND tpep_pickup_datetime <= CAST(last_day(tpep_pickup_datetime) AS TIMESTAMP) "
        f"AND tpep_pickup_datetime >= {PERIOD_START} AND tpep_pickup_datetime < {PERIOD_END}",
    ),
    "q_dedup": with_(["deduped"], "SELECT * FROM deduped"),
    "q_dedup_stats": with_(
        ["in_period", "deduped"],
        "SELECT b.n AS before, b.n - r.n AS removed, r.n AS remaining "
        "FROM (SELECT count(*) AS n FROM in_period) b, (SELECT count(*) AS n FROM deduped) r",
    ),
    "q_business_rules": with_(["ruled"], "SELECT * FROM ruled"),
    "q_derived": with_(["good"], _derived("good")),
    "q_cleanse": with_(["clean"], "SELECT * FROM clean"),
    "q_enrich": with_(["enriched"], "SELECT * FROM enriched"),
    "q_hourly_stats": with_(
        ["hourly"],
        "SELECT pickup_date, pickup_hour, pickup_borough, trip_count, "
        + ", ".join([_r2("total_fare"), _r4("avg_fare"), _r4("avg_distance"), _r4("avg_duration_minutes"),
                     _r2("total_tips")])
        + " FROM hourly",
    ),
    "q_daily_stats": with_(
        ["daily"],
        "SELECT pickup_date, pickup_borough, trip_count, " + ", ".join([_r2("revenue"), _r4("avg_distance")])
        + " FROM daily",
    ),
    "q_rolling_7d": with_(
        ["rolling"],
        "SELECT pickup_date, pickup_borough, trip_count, "
        + ", ".join([_r2("revenue"), _r4("avg_distance"), _r2("rolling_7d_revenue")])
        + " FROM rolling",
    ),
    "q_dim_date": with_(["dim_date"], "SELECT * FROM dim_date"),
    "q_trip_id": with_(["clean"], f"SELECT VendorID, tpep_pickup_datetime, PULocationID, {TRIP_ID} AS trip_id FROM clean"),
    "q_fact_trips": with_(["fact"], "SELECT * FROM fact"),
    "q_dq_not_null": _not_null_sql(),
    "q_dq_uniqueness": _uniqueness_sql(),
    "q_dq_range": _range_sql(),
    "q_dq_row_count": _row_count_sql(),
    "q_orphans": _orphans_sql(),
    "q_orphan_rows": with_(
        ["clean", "fact", "dim_location"],
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", {c} AS key, count(*) AS rows FROM {t} "
            f"WHERE NOT EXISTS (SELECT 1 FROM dim_location WHERE {k} = {c}) GROUP BY {c}"
            for t, c, k in (("clean", "PULocationID", "location_id"), ("clean", "DOLocationID", "location_id"),
                            ("fact", "pickup_location_sk", "location_sk"), ("fact", "dropoff_location_sk", "location_sk"))
        ),
    ),
    "q_schema_gate": with_(["raw_trips"], f"SELECT {RAW_COLS.replace('fare_amount, ', '')}, 'fare_amount' AS quarantine_reason FROM raw_trips"),
    "q_dq_results": _gate_sql(),
    "q_expectation_suite": _suite_sql(),
    "q_boroughs": with_(
        ["rolling"], "SELECT DISTINCT pickup_borough FROM rolling WHERE pickup_borough IS NOT NULL ORDER BY 1"
    ),
    "q_report_revenue": _revenue_sql(),
    "q_report_peak_hours": with_(
        ["hourly"],
        "SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM hourly "
        "WHERE pickup_borough = (SELECT min(pickup_borough) FROM hourly) GROUP BY pickup_hour ORDER BY pickup_hour",
    ),
    "q_report_fare_by_distance": _fare_by_distance_sql(),
    "q_stage_counts": _stage_counts_sql(),
    "q_drop_rate": _drop_rate_sql(),
    "q_freshness": with_(
        ["clean"],
        f"SELECT 'silver_trips' AS \"table\", max(tpep_pickup_datetime) AS last_pickup, "
        f"TIMESTAMP '{FRESHNESS_AS_OF}' AS as_of, "
        f"CAST(epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max(tpep_pickup_datetime)) AS BIGINT) AS lag_seconds FROM clean",
    ),
}
# Landing, running in batches and re-running change nothing.
ORACLES["q_whole_run"] = ORACLES["q_rolling_7d"]
ORACLES["q_zones_csv"] = ORACLES["q_zones"]
