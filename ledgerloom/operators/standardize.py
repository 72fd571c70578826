"""Raw text columns to a typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.layouts import Layout


def standardize(raw: DataFrame, layout: Layout) -> DataFrame:
    """One typed row per raw row: a single projection, so nothing is dropped or shuffled."""
    return raw.select(
        *(field.parse(F.col(f"`{field.header}`")).alias(field.name) for field in layout.fields)
    )
