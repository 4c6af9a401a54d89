"""Column expressions and join helpers shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here is a Python UDF.
"""

from faregrid.functions.columns import (
    any_null,
    month_ranges,
    tolerant_double,
    tolerant_int,
    trip_duration_minutes,
    trip_id,
)
from faregrid.functions.joins import checked_broadcast

__all__ = [
    "any_null",
    "checked_broadcast",
    "month_ranges",
    "tolerant_double",
    "tolerant_int",
    "trip_duration_minutes",
    "trip_id",
]
