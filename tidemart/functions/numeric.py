"""Ratios that are computed in decimals and handed out as rounded doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up."""
    ratio = part.cast("decimal(20,0)") * 100 / whole.cast("decimal(20,0)")
    return F.round(ratio, digits).cast("double")


def percent_change(now: Column, before: Column, digits: int = 2) -> Column:
    """Change from ``before`` to ``now`` in percent, rounded half up."""
    return percent(now - before, before, digits)
