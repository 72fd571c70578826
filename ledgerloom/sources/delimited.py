"""Delimited text files, as public bodies publish them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The file format of the public extracts.
SEPARATOR = ";"
QUOTE = '"'
ENCODING = "ISO-8859-1"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    headers: Sequence[str] | None = None,
    separator: str = SEPARATOR,
    quote: str = QUOTE,
    escape: str = QUOTE,
    encoding: str = ENCODING,
) -> DataFrame:
    """Every column as a string, named by the header row; empty fields are NULL.

    Files stay splittable (no multi-line records), so a large file is read by
    many tasks. With ``headers`` (all header names, in file order) no job is
    run to look at the first line. Either way the header of every file is
    checked, so a file with other columns fails instead of shifting values.

    ``escape`` is the quote itself, so ``"A ""q"" x"`` reads as ``A "q" x``.
    Pass a backslash to get Spark's default, which leaves doubled quotes as
    they are.
    """
    reader = spark.read.options(
        header=True,
        enforceSchema=False,
        sep=separator,
        quote=quote,
        escape=escape,
        encoding=encoding,
    )
    if headers is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in headers])
        reader = reader.schema(schema)
    return reader.csv(path)


# By encoding: a line end, or a character that it cannot hold (UTF-8 holds all). One class, so a text is
# searched once; as plain ranges, because a complement of several takes many times as long.
_BROKEN = {
    "ISO-8859-1": r"[\r\n\x{100}-\x{10FFFF}]",
    "US-ASCII": r"[\r\n\x{80}-\x{10FFFF}]",
    "UTF-8": r"[\r\n]",
}


def _checked(column: str, encoding: str) -> Column:
    """The column, or an error that names it for a text that would not be read back as it is."""
    value = F.col(f"`{column}`")
    broken = value.rlike(_BROKEN[encoding])
    told = F.lit(f"column {column}: empty text, a line end, or a character beyond {encoding}")
    return F.when((value == "") | broken, F.raise_error(told)).otherwise(value).alias(column)


def write_delimited(
    df: DataFrame,
    path: str,
    *,
    separator: str = SEPARATOR,
    quote: str = QUOTE,
    encoding: str = ENCODING,
) -> None:
    """Text files that :func:`read_delimited` reads back as the same texts (all fields quoted).

    Columns that are no text are written as Spark casts them. What the format cannot
    hold ends the job with an error that names the column: empty text (it reads as
    NULL), a line end inside a value (files are split at lines), a character that the
    encoding lacks. Encodings: ISO-8859-1, US-ASCII and UTF-8.
    """
    if encoding not in _BROKEN:
        raise ValueError(f"encoding {encoding}: one of {', '.join(_BROKEN)} is needed")
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    checked = df.select(
        *(_checked(name, encoding) if name in texts else F.col(f"`{name}`") for name in df.columns)
    )
    (
        checked.write.mode("overwrite")
        .options(
            header=True,
            sep=separator,
            quote=quote,
            escape=quote,
            encoding=encoding,
            quoteAll=True,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )
