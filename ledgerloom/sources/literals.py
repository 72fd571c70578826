"""Rows written down in the code: the members that stand for "unknown"."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys and label of the unknown members.
UNKNOWN_CANDIDATE_ID = -1
UNKNOWN_CANDIDATE = "CANDIDATO NÃO IDENTIFICADO"
UNKNOWN_DATE_KEY = 0

DATE_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.LongType(), False),
        T.StructField("expense_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
    ]
)


def literal_row(spark: SparkSession, values: Mapping[str, Any], schema: T.StructType) -> DataFrame:
    """One row with the given values; columns without a value are NULL.

    The row is made of literals on the JVM side: a local Python list would
    start Python workers wherever the row is used.
    """
    columns = (F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema)
    return spark.range(0, 1, 1, 1).select(*columns)


def with_member(
    members: DataFrame, values: Mapping[str, Any], schema: T.StructType | None = None
) -> DataFrame:
    """``members`` and one more row, of the same schema unless one is given.

    The result is a new frame, so calling this again on ``members`` adds the row
    once, not twice.
    """
    row = literal_row(members.sparkSession, values, schema or members.schema)
    return members.unionByName(row)
