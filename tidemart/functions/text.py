"""Delimited-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.constants import FIELD_SEPARATOR


def split_fields(
    text: Column, fields: dict[str, str], separator: str = FIELD_SEPARATOR
) -> list[Column]:
    """One typed column per named field of a delimited text, in order.

    ``fields`` maps the output name to its type. A field the text is too short
    for becomes NULL.
    """
    parts = F.split(text, separator)
    return [F.get(parts, i).cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items())]
