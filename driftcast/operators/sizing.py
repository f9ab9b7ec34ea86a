"""Broadcasts with a bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded by construction (e.g. the
    distinct days of one year, at most 366 rows); callers state the bound.
    All other sides are left to the adaptive planner, which knows their size
    in bytes."""
    return F.broadcast(df)
