"""DataFrame -> DataFrame operators of the trip pipeline."""

from faregrid.operators.aggregate import daily_stats, hourly_stats, rolling_revenue
from faregrid.operators.cleansing import (
    Cleansed,
    Split,
    business_rules,
    cast_columns,
    cleanse,
    dedup,
    derive,
    period_filter,
    quarantine,
)
from faregrid.operators.enrich import join_zones
from faregrid.operators.model import dim_date, dim_date_for, dim_location, fact_trips
from faregrid.operators.quality import (
    EXPECTATION_SUITE,
    DataQualityFailure,
    compile_suite,
    enforce,
    fact_gate,
    run_checks,
)
from faregrid.operators.reports import boroughs, fare_by_distance, peak_hours, revenue_by_borough

__all__ = [
    "Cleansed",
    "DataQualityFailure",
    "EXPECTATION_SUITE",
    "Split",
    "boroughs",
    "business_rules",
    "cast_columns",
    "cleanse",
    "compile_suite",
    "daily_stats",
    "dedup",
    "derive",
    "dim_date",
    "dim_date_for",
    "dim_location",
    "enforce",
    "fact_gate",
    "fact_trips",
    "fare_by_distance",
    "hourly_stats",
    "join_zones",
    "peak_hours",
    "period_filter",
    "quarantine",
    "revenue_by_borough",
    "rolling_revenue",
    "run_checks",
]
