"""faregrid: a Spark-native batch analytics engine for taxi-trip records.

Raw monthly trip files and a zone lookup are landed, cleansed, enriched,
aggregated and modelled into a star schema, gated by one-pass data-quality
checks and summarised by reporting queries. Every step is a plain
``DataFrame -> DataFrame`` function built from Spark's own operators, so
Catalyst and AQE choose the physical plan.
"""

from faregrid.schemas import REQUIRED_COLUMNS, RAW_TRIP_SCHEMA, ZONE_SCHEMA

__all__ = ["REQUIRED_COLUMNS", "RAW_TRIP_SCHEMA", "ZONE_SCHEMA"]
