"""Sources and sinks: the test-table fixture and the partitioned lake."""

from faregrid.sources.fixture import raw_trips, zones
from faregrid.sources.lake import (
    Layout,
    land_raw,
    land_zones,
    landed_months,
    read_partitioned,
    read_raw,
    read_zones,
    write_partitioned,
)

__all__ = [
    "Layout",
    "land_raw",
    "land_zones",
    "landed_months",
    "raw_trips",
    "read_partitioned",
    "read_raw",
    "read_zones",
    "write_partitioned",
    "zones",
]
