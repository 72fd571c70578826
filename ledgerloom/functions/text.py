"""Text clean-up and number parsing.

Every parser here yields NULL for text it cannot read, so one bad field never
ends a job and never drops a row, with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(raw: Column) -> Column:
    """Free text without the spaces around it. Only ASCII spaces go; a tab stays."""
    return F.trim(raw)


def code(raw: Column) -> Column:
    """A short code (state, party): no spaces around it, upper case."""
    return F.upper(F.trim(raw))


def long_integer(raw: Column) -> Column:
    return raw.try_cast("bigint")


def integer(raw: Column) -> Column:
    return raw.try_cast("int")
