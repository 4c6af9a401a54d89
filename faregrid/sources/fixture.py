"""Trip-shaped, dirty input derived by Spark from the TPC-H-like test tables.

``raw_trips`` turns ``lineitem JOIN orders`` into yellow-taxi raw records with
the dirt the pipeline must handle (NULL passengers, injected duplicates,
out-of-range fares and distances, reversed timestamps); ``zones`` turns
``nation JOIN region`` into the zone lookup. Money goes through integer cents
with ``floor`` so both Spark and the DuckDB oracle derive identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str) -> F.Column:
    return F.floor(F.col(c) * 100.0 + 0.5)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip records (11 columns, typed as in the monthly source files)."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    base = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        _cents("l_extendedprice").alias("cents"),
        _cents("l_discount").alias("tip"),
        _cents("l_tax").alias("tolls"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=((F.col("l_partkey") * 7) % 1440).cast("int"))).alias("pu"),
    )
    fare_cents = F.floor(F.col("cents") / 20.0).cast("double") - 1e4
    trips = base.select(
        (F.col("l_linenumber") % 2 + 1).cast("int").alias("VendorID"),
        F.col("pu").alias("tpep_pickup_datetime"),
        (F.col("pu") + F.make_dt_interval(mins=F.col("l_quantity").cast("int") - 3)).alias("tpep_dropoff_datetime"),
        F.when(F.col("l_orderkey") % 41 == 0, F.lit(None).cast("double"))
        .otherwise((F.col("l_linenumber") * 2 - 2).cast("double")).alias("passenger_count"),
        (F.floor(F.col("cents") / 500.0).cast("double") / 100.0).alias("trip_distance"),
        (F.col("l_suppkey") % 25).cast("int").alias("PULocationID"),
        (F.col("l_partkey") % 28).cast("int").alias("DOLocationID"),
        (fare_cents / 100.0).alias("fare_amount"),
        ((fare_cents + F.col("tip") * 100.0 + F.col("tolls") * 100.0) / 100.0).alias("total_amount"),
        F.col("tip").cast("double").alias("tip_amount"),
        F.col("tolls").cast("double").alias("tolls_amount"),
        # every 20th order is delivered twice (exact duplicate rows)
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("l_orderkey") % 20 == 0, 2).otherwise(1))).alias("_copy"),
    )
    return trips.drop("_copy")


def months(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """Every month from the first to the last pickup (order dates plus less than a day); none without orders.

    One narrow aggregate; two numbers reach the driver.
    """
    date = F.col("o_orderdate")
    span = read_table(spark, sf_dir, "orders").agg(F.min(date).alias("lo"), (F.max(date) + F.make_dt_interval(days=F.lit(1))).alias("hi"))
    lo, hi = span.select(*[F.year(c) * 12 + F.month(c) - 1 for c in ("lo", "hi")]).first()
    return [] if lo is None else [(n // 12, n % 12 + 1) for n in range(lo, hi + 1)]


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup with the published header names (LocationID, Borough, Zone, service_zone)."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    service = (
        F.when(F.col("n_nationkey") % 3 == 0, "Yellow Zone")
        .when(F.col("n_nationkey") % 3 == 1, "Boro Zone")
        .otherwise("Airports")
    )
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        service.alias("service_zone"),
    )
