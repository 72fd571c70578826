"""Column expressions that turn extract text into typed values."""

from ledgerloom.functions.dates import date_key, date_parts, dmy_date, dmy_date_strict
from ledgerloom.functions.money import amount_ptbr, amount_text_ptbr
from ledgerloom.functions.text import code, integer, long_integer, text

__all__ = [
    "amount_ptbr",
    "amount_text_ptbr",
    "code",
    "date_key",
    "date_parts",
    "dmy_date",
    "dmy_date_strict",
    "integer",
    "long_integer",
    "text",
]
