"""Join helpers.

Dimension tables (zones, locations, dates) are broadcast, but only after
their size has been checked: a dimension that unexpectedly grows past the
limit falls back to a shuffle join that Catalyst/AQE plan on their own.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# A dimension row is at most a few hundred bytes; one million rows stays well
# below the default broadcast limit of executors.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


class DuplicateKeyError(ValueError):
    """A lookup key occurs more than once, which would multiply the fact rows."""


def checked_broadcast(
    dim: DataFrame,
    key: str,
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    proven_rows: int | None = None,
) -> DataFrame:
    """Return ``dim`` marked for broadcast if it has at most ``max_rows`` rows.

    One small aggregate measures the row count and the number of distinct keys
    in the same pass; duplicate keys are rejected because a left join against
    them would silently multiply trips. Beyond the limit the dimension is
    returned unmarked and the planner picks a shuffle join.

    ``proven_rows`` is an upper bound the caller guarantees by construction
    (e.g. a calendar generated from a bounded period, one row per day); within
    the limit it replaces the measuring job.
    """
    if proven_rows is not None and proven_rows <= max_rows:
        return F.broadcast(dim)
    stats = dim.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(key)).alias("k"),
                    F.count_if(F.col(key).isNull()).alias("z")).first()
    n, k, z = stats["n"], stats["k"], stats["z"]
    if n - z != k:
        raise DuplicateKeyError(f"lookup key {key!r} is not unique: {n - z} non-null rows, {k} distinct keys")
    if n <= max_rows:
        return F.broadcast(dim)
    log.warning("dimension on %s has %d rows (> %d): not broadcast", key, n, max_rows)
    return dim


def attach_roles(trips: DataFrame, lookup: DataFrame, key: str, roles: dict[str, dict[str, str]]) -> DataFrame:
    """Left-join one lookup once per role: ``roles`` maps a foreign key of the trips to the columns it brings, renamed."""
    for foreign, columns in roles.items():
        side = lookup.select(F.col(key).alias(foreign), *[F.col(c).alias(name) for c, name in columns.items()])
        trips = trips.join(side, foreign, "left")
    return trips
