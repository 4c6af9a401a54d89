"""Benchmark: the whole trip pipeline over the test tables.

Lands the fixture's raw trips once, then times every stage of the lake job
(cleanse, enrich, aggregate, dimensions, fact, quality gate) and the three
reports, each run into a fresh lake root: one warm-up run, then the median of
three. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faregrid.plans import jobs  # noqa: E402
from faregrid.plans.metrics import MetricsRecorder  # noqa: E402
from faregrid.session import local_session  # noqa: E402
from faregrid.sources import fixture  # noqa: E402
from faregrid.sources.lake import Layout  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    return time.perf_counter() - t, out


def one_run(spark, landed: Layout, months) -> dict[str, float]:
    """All stages into a fresh lake that shares the landed raw months."""
    # a fresh curated zone per run, reading the raw zone landed once
    lk = Layout(jobs.scratch_layout(spark).root, raw_root=landed.raw_root)
    rec = MetricsRecorder()
    t = {}
    t["cleanse"], _ = timed(lambda: jobs.cleanse(spark, lk, months, rec))
    t["enrich"], _ = timed(lambda: jobs.enrich_months(spark, lk, months, rec))
    t["aggregate"], _ = timed(lambda: jobs.aggregate_months(spark, lk, months, rec))
    t["dims"], _ = timed(lambda: jobs.build_dims(spark, lk, months, rec))
    t["fact"], _ = timed(lambda: jobs.build_fact(spark, lk, months, rec))
    t["quality_gate"], _ = timed(lambda: jobs.quality_gate(spark, lk, months, rec, enforce=False))
    t["report_revenue"], _ = timed(lambda: jobs.report_revenue(spark, lk).collect())
    t["report_peak_hours"], _ = timed(lambda: jobs.report_peak_hours(spark, lk).collect())
    t["report_fare_by_distance"], _ = timed(lambda: jobs.report_fare_by_distance(spark, lk).collect())
    return t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="faregrid-bench")

    months = fixture.months(spark, sf_dir)
    base = jobs.scratch_layout(spark, "bench")
    landed = Layout(base.root, raw_root=f"{base.root}/raw")
    feed, zones = fixture.raw_trips(spark, sf_dir), fixture.zones(spark, sf_dir)
    rec = MetricsRecorder()
    t_land, _ = timed(lambda: jobs.land(spark, landed, feed, zones, months, rec))
    raw_rows = spark.read.parquet(landed.raw_trips).count()

    one_run(spark, landed, months)  # warm-up
    samples = [one_run(spark, landed, months) for _ in range(runs)]
    per_stage = {k: round(statistics.median(s[k] for s in samples), 3) for k in samples[0]}
    totals = [sum(s.values()) for s in samples]
    total = statistics.median(totals)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": per_stage,
        "sf": float(m.group(1)) if m else None,
        "raw_rows": raw_rows,
        "rows_per_sec": round(raw_rows / total, 1),
        "land_sec": round(t_land, 3),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
