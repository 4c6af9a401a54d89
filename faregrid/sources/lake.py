"""Lake layout, Parquet/CSV sources and partitioned sinks.

Layout (all below one root, which the caller names; on a cluster it is a
shared folder, never a machine-local one)::

    raw/yellow_tripdata/year=Y/month=M/        landed raw months
    raw/taxi_zones/                            zone lookup CSV (header)
    silver/yellow_tripdata/year=Y/month=M/     cleansed trips
    silver/quarantine/year=Y/month=M/          rows with a NULL required column
    silver/trips_with_zones/year=Y/month=M/    enriched trips
    gold/hourly_stats/year=Y/                  one file per year, sorted by pickup_date
    gold/daily_stats/year=Y/                   with rolling_7d_revenue
    gold/dim_location/
    gold/dim_date/year=Y/
    gold/fact_trips/year=Y/month=M/
    quality/results/year=Y/                    one row per check and month, one file per year
    metrics/                                   metric records (JSON lines)

Trip-level tables are replaced month by month (``replace_months``): re-running a
month replaces all of it, also where it has become empty, and leaves the others alone. Rows are
staged and published as one step (``publish``). The ledger ``raw/yellow_tripdata/_ledger``
says which months of which source files have landed.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.schemas import RAW_TRIP_SCHEMA, ZONE_RENAMES, ZONE_SCHEMA
from faregrid.sources import publish


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Paths of the lake. ``raw_root`` places the raw zone elsewhere (default: below ``root``)."""

    root: str
    raw_root: str | None = None

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _raw(self, *parts: str) -> str:
        if self.raw_root is None:
            return self._p("raw", *parts)
        return "/".join([self.raw_root.rstrip("/"), *parts])

    @property
    def raw_trips(self) -> str:
        return self._raw("yellow_tripdata")

    @property
    def raw_zones(self) -> str:
        return self._raw("taxi_zones")

    @property
    def silver_trips(self) -> str:
        return self._p("silver", "yellow_tripdata")

    @property
    def quarantine(self) -> str:
        return self._p("silver", "quarantine")

    @property
    def enriched(self) -> str:
        return self._p("silver", "trips_with_zones")

    @property
    def hourly_stats(self) -> str:
        return self._p("gold", "hourly_stats")

    @property
    def daily_stats(self) -> str:
        return self._p("gold", "daily_stats")

    @property
    def dim_location(self) -> str:
        return self._p("gold", "dim_location")

    @property
    def dim_date(self) -> str:
        return self._p("gold", "dim_date")

    @property
    def fact_trips(self) -> str:
        return self._p("gold", "fact_trips")

    @property
    def quality_results(self) -> str:
        return self._p("quality", "results")

    @property
    def metrics(self) -> str:
        return self._p("metrics")


def months_filter(months: Iterable[tuple[int, int]], year_col: str = "year", month_col: str = "month"):
    """Partition predicate for a set of (year, month) pairs: prunes directories at planning time."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    preds = [(F.col(year_col) == y) & F.col(month_col).isin(sorted(ms)) for y, ms in sorted(by_year.items())]
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path object of a location."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    fs, jpath = _fs(spark, pattern)
    return [str(s.getPath().toString()) for s in fs.globStatus(jpath) or []]


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if it has no data file yet."""
    if not any(_matches(spark, f"{path}/{p}") for p in ("*.parquet", "*=*/*.parquet", "*=*/*=*")):
        return None
    return spark.read.parquet(path)


_MONTH_DIR = re.compile(r"/year=(\d+)/month=(\d+)(?:/|$)")


def _months_of(paths: Iterable[str]) -> set[tuple[int, int]]:
    return {(int(m[1]), int(m[2])) for m in map(_MONTH_DIR.search, paths) if m}


def stored_months(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    """(year, month) partitions of a table, from its directories (no file is listed)."""
    return _months_of(_matches(spark, f"{path}/year=*/month=*"))


LEDGER = "_ledger"  # names that start with an underscore are no data for Spark
LEDGER_SCHEMA = "source string, year int, month int, rows long"
SOURCE = "_source"  # which file, in which version, a row of a feed came from
SMALL_ROWS = 100_000  # (source, month) pairs that are broadcast at most


def read_feed(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of Parquet source files with the file and its modification time in ``SOURCE``, for ``land_raw``."""
    version = F.concat_ws("@", "_metadata.file_path", F.unix_millis("_metadata.file_modification_time").cast("string"))
    return spark.read.parquet(*paths).select("*", version.alias(SOURCE))


def ledger(spark: SparkSession, layout: Layout) -> DataFrame:
    """(source, year, month, rows): which months of which sources have landed, one row for each."""
    publish.recover(spark, layout.raw_trips)
    path = f"{layout.raw_trips}/{LEDGER}"
    if not _matches(spark, f"{path}/*.parquet"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def landed_months(spark: SparkSession, layout: Layout) -> set[tuple[int, int]]:
    """Raw months of which something has landed."""
    return {(r["year"], r["month"]) for r in ledger(spark, layout).select("year", "month").distinct().collect()}


@dataclass(frozen=True)
class Landing:
    """What one call of ``land`` did: months written, and rows it left out because nobody asked for their month."""

    written: list[tuple[int, int]]
    landed_rows: int
    outside_rows: int


def land(
    spark: SparkSession,
    source: DataFrame,
    layout: Layout,
    months: Sequence[tuple[int, int]],
    ts_col: str = "tpep_pickup_datetime",
    name: str = "feed",
) -> Landing:
    """Land the requested months of a raw feed, each source's rows of a month once.

    ``source`` holds rows of one or several source files. The column ``SOURCE`` (see ``read_feed``) names each row's
    file and version; a feed without it is one source called ``name``. If the feed says which file month a row came in
    (columns ``year`` and ``month``), that is its partition, whatever its pickup: late rows land where they arrived.
    Otherwise a row belongs to the month of its pickup, and rows without a pickup to the first month of their source
    (of the request, if the source has no pickup at all), so that the quarantine sees them. Neither depends on
    what is asked for.

    The ledger keeps every (source, month) that has landed; those are left out by an anti join. So however often, in
    whatever order of months and from however many files ``land`` runs, a row lands once. New rows and their ledger
    entries are published together. Rows of months not asked for are counted, and land when their month is asked for.
    """
    months = sorted(set(months))
    if not months:
        return Landing([], 0, 0)
    feed = source if SOURCE in source.columns else source.withColumn(SOURCE, F.lit(name))
    dated = {"year", "month"} <= set(source.columns)
    place = [F.col("year"), F.col("month")] if dated else [F.year(ts_col), F.month(ts_col)]
    # (source, month) pairs of the feed: a pass over two columns
    counted = feed.groupBy(SOURCE, place[0].cast("int").alias("year"), place[1].cast("int").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    first = counted.groupBy(SOURCE).agg(F.min(F.when(F.col("year").isNotNull(), F.struct("year", "month"))).alias("first"))
    start = F.struct(F.lit(months[0][0]).alias("year"), F.lit(months[0][1]).alias("month"))
    known = ledger(spark, layout)
    undated = known.select(F.col("source").alias(SOURCE)).distinct().withColumn("seen", F.lit(True))
    own = first.join(undated, SOURCE, "left")
    # a source without any pickup lands with the first month of the request, unless it has landed before
    home = F.coalesce(F.col("first"), F.when(F.col("seen").isNull(), start))
    pairs = (
        counted.join(own, SOURCE)
        .select(F.col(SOURCE).alias("source"), F.coalesce(F.col("year"), home["year"]).alias("to_year"), F.coalesce(F.col("month"), home["month"]).alias("to_month"),
                "year", "month", "rows")
    )
    run = publish.new_run(spark, layout.raw_trips)
    stage = publish.staging(layout.raw_trips, run)
    plan = f"{stage}/_plan"
    pairs.write.parquet(plan)  # what lands is decided once, however often a later step is repeated
    decided = spark.read.schema(pairs.schema).parquet(plan)
    asked = months_filter(months, "to_year", "to_month")
    have = known.select("source", F.col("year").alias("to_year"), F.col("month").alias("to_month"))
    todo = decided.filter(asked).join(have, ["source", "to_year", "to_month"], "left_anti")
    tally = decided.agg(F.coalesce(F.sum(F.when(~F.coalesce(asked, F.lit(False)), F.col("rows"))), F.lit(0)).alias("outside"), F.count(F.lit(1)).alias("pairs")).first()
    landed = todo.groupBy("source", F.col("to_year").alias("year"), F.col("to_month").alias("month")).agg(F.sum("rows").alias("rows"))
    landed.coalesce(1).write.parquet(f"{stage}/{LEDGER}")
    new = spark.read.schema(LEDGER_SCHEMA).parquet(f"{stage}/{LEDGER}")
    totals = new.groupBy("year", "month").agg(F.sum("rows").alias("rows")).collect()  # a row for each month
    files = publish.Files(spark, layout.raw_trips)
    if totals:
        wanted = todo.select(F.col("source").alias("_s"), F.col("year").alias("_y"), F.col("month").alias("_m"), "to_year", "to_month")
        wanted = F.broadcast(wanted) if tally["pairs"] <= SMALL_ROWS else wanted
        same = (F.col(SOURCE) == F.col("_s")) & place[0].eqNullSafe(F.col("_y")) & place[1].eqNullSafe(F.col("_m"))
        columns = [feed[c] for c in feed.columns if c not in (SOURCE, "year", "month")]
        rows = feed.join(wanted, same).select(*columns, F.col("to_year").alias("year"), F.col("to_month").alias("month"))
        rows.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(f"{stage}/rows")
    else:
        files.delete(f"{publish.STAGING}{run}")
        return Landing([], 0, tally["outside"])
    written = sorted((r["year"], r["month"]) for r in totals)
    publish.move_in(spark, layout.raw_trips, run, "rows", [f"year={y}/month={m}" for y, m in written], [f"{LEDGER}/*.parquet"])
    return Landing(written, sum(r["rows"] for r in totals), tally["outside"])


def land_raw(spark: SparkSession, source: DataFrame, layout: Layout, months: Sequence[tuple[int, int]],
             ts_col: str = "tpep_pickup_datetime", name: str = "feed") -> list[tuple[int, int]]:
    """``land``; returns the months written."""
    return land(spark, source, layout, months, ts_col, name).written


def land_zones(spark: SparkSession, zones: DataFrame, layout: Layout) -> bool:
    """Write the zone lookup as CSV with header once; later calls keep it."""
    if path_exists(spark, f"{layout.raw_zones}/_SUCCESS"):
        return False
    zones.coalesce(1).write.mode("overwrite").option("header", "true").csv(layout.raw_zones)
    return True


_EMPTY_RAW = T.StructType([*RAW_TRIP_SCHEMA.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
# Types that hold every value of the ones before them.
_WIDENING = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _month_schemas(spark: SparkSession, dirs: list[str]) -> list[T.StructType]:
    """A schema for each month's directory, from the footer of one file a month.

    One job merges the footers: months whose types agree share the merged schema (a month without a column reads it
    as NULL). Only where they do not merge is each footer looked at alone, a few at a time.
    """
    files = [sorted(_matches(spark, f"{d}/*.parquet"))[0] for d in dirs]
    if len(set(files)) > 1:
        try:
            return [spark.read.option("mergeSchema", "true").parquet(*files).schema] * len(dirs)
        except Exception as e:  # types differ; a footer that cannot be read fails below
            log.info("footers of %d months do not merge: %s", len(dirs), str(e)[:200])
    with ThreadPoolExecutor(8) as pool:
        return list(pool.map(lambda f: spark.read.parquet(f).schema, files))


def _common_type(kinds: set[str], contract: str | None) -> str:
    """The type in which months meet that store a column differently: no value is lost on the way to the tolerant casts."""
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= set(_WIDENING):
        return max(kinds, key=_WIDENING.index)
    if contract and kinds <= {"timestamp", "timestamp_ntz"}:
        return contract
    return "string"


def read_raw(
    spark: SparkSession, layout: Layout, months: Iterable[tuple[int, int]], merge_schema: bool = False
) -> DataFrame:
    """Raw trips of the given months; ``year``/``month`` are the source partition.

    Column types come from the files, as landed: one footer a month is read. Months that
    agree are one scan; months that do not are read by type group, so filters still
    reach each group's files, and a column that differs takes the wider type (text
    where there is none): values that the contract's type cannot hold stay as they are until the tolerant
    casts quarantine them. The partition predicate prunes directories.

    The columns are those of the first month and, of the contract's columns, all that any month has; ``merge_schema``
    adds every other column of any month (NULL where a month lacks it). A month lacks a contract column for all its
    rows, which are then quarantined.
    """
    publish.recover(spark, layout.raw_trips)
    wanted = sorted(set(months) & stored_months(spark, layout.raw_trips))
    if not wanted:
        return spark.createDataFrame([], _EMPTY_RAW)
    dirs = [f"{layout.raw_trips}/year={y}/month={m}" for y, m in wanted]
    schemas = _month_schemas(spark, dirs)
    groups: dict[str, list[int]] = {}
    for i, schema in enumerate(schemas):
        groups.setdefault(schema.json(), []).append(i)
    contract = {f.name: f.dataType.simpleString() for f in RAW_TRIP_SCHEMA}
    kinds: dict[str, set[str]] = {}
    for schema in schemas:
        for f in schema:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    leading = schemas[0].names if merge_schema or len(groups) > 1 else spark.read.parquet(dirs[0]).columns
    columns = [c for c in kinds if merge_schema or c in contract or c in leading]
    frames = []
    for members in groups.values():
        schema = schemas[members[0]]
        frame = spark.read.option("basePath", layout.raw_trips).schema(schema).parquet(*[dirs[i] for i in members])
        here = {f.name: f.dataType.simpleString() for f in schema}
        cast = {c: _common_type(kinds[c], contract.get(c)) for c in columns}
        # a plain column where nothing differs, so that predicates reach the reader
        picked = [F.col(c) if here.get(c) == cast[c] else (F.col(c) if c in here else F.lit(None)).cast(cast[c]).alias(c) for c in columns]
        frames.append(frame.filter(months_filter([wanted[i] for i in members])).select(*picked, "year", "month"))
    return reduce(DataFrame.unionByName, frames)


def read_zones(spark: SparkSession, layout: Layout) -> DataFrame:
    """Zone lookup CSV with a declared schema (no inference scan), renamed to snake case."""
    zones = spark.read.schema(ZONE_SCHEMA).option("header", "true").csv(layout.raw_zones)
    return zones.withColumnsRenamed(ZONE_RENAMES)


def month_counts(spark: SparkSession, path: str, months: Iterable[tuple[int, int]]) -> DataFrame | None:
    """(year, month, count) of a table's stored months among ``months``, or None if it has none of them.

    The counts are the row counts in the files' footers: the aggregate is pushed down to the Parquet reader,
    which returns one row a file however many rows the file holds. Only the V2 reader does so, hence the
    session of its own; the caller's settings stay as they are. Only the months' directories are listed, and as no
    data column is named, months may differ in columns and types.
    """
    wanted = sorted(set(months) & stored_months(spark, path))
    if not wanted:
        return None
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    dirs = [f"{path}/{month_name(m)}" for m in wanted]
    stored = own.read.option("basePath", path).schema("year int, month int").parquet(*dirs)
    return stored.groupBy("year", "month").count()


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned table with its partition columns (one listing, all files)."""
    return spark.read.option("basePath", path).parquet(path)


def read_months(spark: SparkSession, path: str, months: Iterable[tuple[int, int]]) -> DataFrame:
    """The given months of a trip-level table; a publication that was stopped half way is finished first."""
    publish.recover(spark, path)
    return spark.read.parquet(path).filter(months_filter(months))


def clustered(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Hash-partition on the partition columns (one file per partition directory) and
    order rows inside each file (tight min/max statistics).

    For small outputs (aggregates, dimensions, check results) only: on trip-level
    data it would funnel a whole month into one task.
    """
    out = df.repartition(*partition_by)
    return out.sortWithinPartitions(*partition_by, *sort_by) if sort_by else out


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def month_name(month: tuple[int, int]) -> str:
    return f"year={month[0]}/month={month[1]}"


def replace_months(df: DataFrame, path: str, months: Iterable[tuple[int, int]]) -> set[tuple[int, int]]:
    """Replace the given months of a (year, month) partitioned table as one step; returns those that got rows.

    The rows are written as ``df`` holds them: a frame that follows its input's month layout (a scan, a broadcast
    join) needs no shuffle and gets about as many files as the input had. After a real shuffle, where every task
    holds rows of every month, pass ``by_month(df, months)``. A month of the run that gets no row is removed:
    nothing of an earlier run stays.
    """
    spark, months = df.sparkSession, set(months)
    run = publish.new_run(spark, path)
    df.write.partitionBy("year", "month").parquet(publish.staging(path, run))
    got = publish.replace_partitions(spark, path, run, map(month_name, months))
    return {m for m in months if month_name(m) in got}


def by_month(df: DataFrame, months: Iterable[tuple[int, int]]) -> DataFrame:
    """``df`` rebalanced by month, so that a month has a few files; AQE splits large months and joins small ones.

    A run over one month needs no such shuffle: its tasks write one file each.
    """
    return df.hint("rebalance", "year", "month") if len(set(months)) > 1 else df
