"""Pipeline metrics as data.

Stage counts come from ``DataFrame.observe`` on the writes themselves (no
extra pass over the data); the records accumulate in a ``MetricsRecorder``
and are written as a small table. The query forms (``stage_counts``,
``drop_rate``, ``freshness``) compute the same numbers as DataFrames.
"""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.schemas import METRIC_JOB_DURATION

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.DoubleType(), False),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


@dataclass
class MetricsRecorder:
    """Metric records ``{metric, value, ts, tags}`` of one run."""

    records: list[dict[str, Any]] = field(default_factory=list)

    def record(self, name: str, value: float | int | None, **tags: Any) -> None:
        self.records.append(
            {
                "metric": name,
                "value": None if value is None else float(value),
                "ts": time.time(),
                "tags": {k: str(v) for k, v in tags.items() if v is not None},
            }
        )

    @contextmanager
    def timer(self, job: str, **tags: Any):
        """Record ``job_duration_seconds`` even when the job raises."""
        start = time.time()
        try:
            yield
        finally:
            self.record(METRIC_JOB_DURATION, round(time.time() - start, 3), job=job, **tags)

    def get(self, name: str, **tags: Any) -> list[float | None]:
        want = {k: str(v) for k, v in tags.items()}
        return [
            r["value"] for r in self.records
            if r["metric"] == name and all(r["tags"].get(k) == v for k, v in want.items())
        ]

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.records, schema=METRIC_SCHEMA)

    def write(self, spark: SparkSession, path: str) -> None:
        """Append this run's records as JSON lines (the metric dump)."""
        self.to_dataframe(spark).coalesce(1).write.mode("append").json(path)

    def dumps(self) -> str:
        return json.dumps(self.records, indent=2)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills when an action runs over ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def drop_rate_value(records_in: int | None, records_out: int | None) -> float | None:
    """round(1 - out/in, 4); NULL for an empty input instead of a division by zero."""
    if not records_in:
        return None
    return round(1 - (records_out or 0) / records_in, 4)


def _as_rows(agg: DataFrame, stages: list[tuple[int, str, str]]) -> DataFrame:
    """One-row aggregate -> one ``(stage_order, stage, rows)`` row per stage."""
    return agg.select(
        F.inline(F.array(*[
            F.struct(F.lit(order).alias("stage_order"), F.lit(stage).alias("stage"), F.col(col).alias("rows"))
            for order, stage, col in stages
        ]))
    )


def stage_counts(
    casted: DataFrame,
    bad: Column,
    in_period: Column,
    dedup_keys: list[str],
    clean: DataFrame,
    enriched: DataFrame,
    fact: DataFrame,
) -> DataFrame:
    """Rows per pipeline stage, each frame counted for itself.

    Pass 1 over the cast raw rows: raw, quarantined, in period, and the rows
    left by deduplication (= distinct keys among in-period rows). Clean and fact
    rows are counted where they are made, so a join that multiplies or loses rows
    shows; the pass over the enriched trips also gives hourly and daily rows (=
    distinct group keys). Distinct counts
    are two-level aggregates, so hot keys combine map-side.
    """
    first = casted.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(bad).alias("quarantined"),
        F.count_if(~bad & in_period).alias("in_period"),
        F.count_distinct(F.when(~bad & in_period, F.struct(*dedup_keys))).alias("deduplicated"),
    )
    second = enriched.agg(
        F.count(F.lit(1)).alias("enriched"),
        F.count_distinct(F.struct("pickup_date", "pickup_hour", "pickup_borough")).alias("hourly_stats"),
        F.count_distinct(F.struct("pickup_date", "pickup_borough")).alias("daily_stats"),
    )
    return _as_rows(first, [(1, "raw", "raw"), (2, "quarantined", "quarantined"), (3, "in_period", "in_period"),
                            (4, "deduplicated", "deduplicated")]).unionByName(
        _as_rows(clean.agg(F.count(F.lit(1)).alias("n")), [(5, "clean", "n")])
    ).unionByName(
        _as_rows(second, [(6, "enriched", "enriched"), (7, "hourly_stats", "hourly_stats"), (8, "daily_stats", "daily_stats")])
    ).unionByName(_as_rows(fact.agg(F.count(F.lit(1)).alias("n")), [(9, "fact_trips", "n")]))


def drop_rate(raw: DataFrame, clean: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Per pickup month: records in, records out, drop rate = round(1 - out/in, 4)."""
    rin = raw.groupBy(F.year(ts_col).alias("year"), F.month(ts_col).alias("month")).agg(
        F.count(F.lit(1)).alias("records_in")
    )
    rout = clean.groupBy("year", "month").agg(F.count(F.lit(1)).alias("records_out"))
    joined = rin.join(rout, on=["year", "month"], how="full")
    rec_in = F.coalesce(F.col("records_in"), F.lit(0))
    rec_out = F.coalesce(F.col("records_out"), F.lit(0))
    return joined.select(
        "year",
        "month",
        rec_in.alias("records_in"),
        rec_out.alias("records_out"),
        F.when(rec_in > 0, F.round(1 - rec_out / rec_in, 4)).alias("drop_rate"),
    )


def freshness(df: DataFrame, table: str, as_of: str, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Lag in seconds between ``as_of`` and the latest pickup of the table."""
    ts_type = df.schema[ts_col].dataType.simpleString()
    as_of_col = F.lit(as_of).cast(ts_type)
    return df.agg(F.max(ts_col).alias("last_pickup")).select(
        F.lit(table).alias("table"),
        "last_pickup",
        as_of_col.alias("as_of"),
        (F.unix_timestamp(as_of_col) - F.unix_timestamp(F.col("last_pickup"))).alias("lag_seconds"),
    )
