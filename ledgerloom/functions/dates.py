"""Dates written as ``31/12/2026`` and the parts derived from a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date format of the extracts, and the format of a date key.
DMY = "dd/MM/yyyy"
DMY_TEXT = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"
KEY = "yyyyMMdd"


def dmy_date(raw: Column) -> Column:
    """Date from text with or without spaces around it; NULL when it is no valid date.

    Day and month need two digits: ``1/9/2026`` is NULL.
    """
    return dmy_date_strict(F.trim(raw))


def dmy_date_strict(raw: Column) -> Column:
    """Like :func:`dmy_date`, but text with spaces around it is NULL too.

    Same result as ``try_to_date(raw, 'dd/MM/yyyy')``, which raises and catches
    an error for every unreadable text; this stays fast when many are.
    """
    year, month, day = F.substring(raw, 7, 4), F.substring(raw, 4, 2), F.substring(raw, 1, 2)
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), day)
    return F.when(raw.rlike(DMY_TEXT), iso.try_cast("date"))


def date_key(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.date_format(day, KEY).cast("bigint")


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
    }
