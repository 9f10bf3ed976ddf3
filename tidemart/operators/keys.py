"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.ordering import SortKey, global_row_number
from tidemart.operators.skew import null_safe_join


def surrogate_key(
    df: DataFrame,
    natural: Sequence[str],
    out: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of ``df``, which is unique on ``natural``, in natural-key order.

    With ``existing`` (a dimension loaded before) only keys it lacks are
    returned, numbered after its highest id, so ids already given out never
    change.
    """
    natural = list(natural)
    start = 1
    if existing is not None:
        df = null_safe_join(df, existing.select(*natural), natural, "left_anti")
        start += existing.agg(F.max(out)).first()[0] or 0
    return global_row_number(df, [SortKey(k) for k in natural], out, start)
