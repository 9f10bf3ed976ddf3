"""Incremental dimension loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame


def new_dim_rows(
    source: DataFrame,
    dim: DataFrame,
    key: str,
    attributes: Sequence[str],
    aggs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows to append to ``dim``: the source's keys it does not hold yet.

    One row per distinct key and attributes, as loads group by both; a key whose
    attributes differ within a load appears once per variant (``pk_violations``
    reports it). NULL keys are left out on both sides: with SQL's NOT IN a single
    NULL in the dimension would block every later insert. The source collapses
    to its distinct rows before it meets the dimension.
    """
    rows = source.filter(source[key].isNotNull()).groupBy(key, *attributes)
    if aggs:
        found = rows.agg(*[column.alias(name) for name, column in aggs.items()])
    else:
        found = source.filter(source[key].isNotNull()).select(key, *attributes).distinct()
    held = dim.select(key).filter(dim[key].isNotNull())
    return found.join(held, key, "left_anti")
