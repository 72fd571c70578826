"""Data-quality measurements. Each is one aggregation over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import BROADCAST_BYTES, broadcast_if_small, without_match


def volume(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def reconcile(layers: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of each raw table and its typed table, side by side.

    Pass stored typed tables: then both counts come from data that was really
    read and written, which a count over a mere projection would not show.
    """

    def count(label: str, layer: str, df: DataFrame) -> DataFrame:
        return volume(df).select(
            F.lit(label).alias("table_name"),
            F.lit(layer).alias("layer"),
            "row_count",
        )

    counts = [
        count(label, layer, df)
        for label, (raw, typed) in layers.items()
        for layer, df in (("bronze", raw), ("silver", typed))
    ]
    return reduce(DataFrame.unionByName, counts)


def control_total(df: DataFrame, measure: str) -> DataFrame:
    return df.agg(F.sum(measure).alias(f"total_{measure}"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (NULL is none) and the difference."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("distinct_ids")
    ).withColumn("possible_duplicates", F.col("row_count") - F.col("distinct_ids"))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and, per column, how many are NULL: one pass, nothing but totals is shuffled."""
    columns = columns or df.columns
    nulls = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *nulls)


def with_value(df: DataFrame, column: str, value: Any) -> DataFrame:
    """All rows with the value; on a stored table the filter reaches the files."""
    return df.where(F.col(column) == F.lit(value))


def sample_with_value(
    df: DataFrame,
    column: str,
    value: Any,
    show: Sequence[str],
    n: int,
    *,
    ordered: bool = False,
) -> DataFrame:
    """Any ``n`` rows with the value, or the first ``n`` in the order of the shown columns."""
    found = with_value(df, column, value).select(*show)
    return _first(found, n, ordered)


def _first(df: DataFrame, n: int, ordered: bool) -> DataFrame:
    """Without an order, reading ends as soon as ``n`` rows are found."""
    if ordered:
        df = df.orderBy(*(F.asc_nulls_first(name) for name in df.columns))
    return df.limit(n)


def repeated(df: DataFrame, keys: Sequence[str], *, ignore: Any = None) -> DataFrame:
    """Key combinations with more than one row, and how many rows.

    ``ignore`` is a value of the first key that marks "no key"; with it, NULL
    keys are left out too, as ``<>`` does.
    """
    if ignore is not None:
        df = df.where(F.col(keys[0]) != F.lit(ignore))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def most_repeated(
    df: DataFrame, keys: Sequence[str], n: int | None = None, *, ignore: Any = None
) -> DataFrame:
    """Repeated keys, most rows first; equal counts in key order. All of them without ``n``."""
    order = [F.desc("row_count"), *(F.asc_nulls_first(key) for key in keys)]
    found = repeated(df, keys, ignore=ignore).orderBy(*order)
    return found if n is None else found.limit(n)


def repeated_count(df: DataFrame, keys: Sequence[str], *, ignore: Any = None) -> DataFrame:
    return repeated(df, keys, ignore=ignore).agg(F.count(F.lit(1)).alias("repeated_ids"))


def orphan_rows(
    df: DataFrame,
    members: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows whose key is NULL or not among the members."""
    return without_match(df, members, {key: key}, broadcast_bytes=broadcast_bytes)


def orphan_count(
    df: DataFrame,
    members: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """How many rows :func:`orphan_rows` has.

    Rows are counted per key before a shuffled join, so that it sees each key once
    and a key with very many rows is no more work than any other. With a broadcast
    Spark may count after the join instead, which shuffles no more.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = broadcast_if_small(members.select(key), broadcast_bytes=broadcast_bytes)
    orphans = per_key.join(known, key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))


def minima(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return df.agg(*(F.min(name).alias(f"min_{name}") for name in measures))


def negative_count(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows in which at least one measure is below zero."""
    below = reduce(or_, (F.col(name) < 0 for name in measures))
    return df.where(below).agg(F.count(F.lit(1)).alias("negative_rows"))


def drill_down(
    raw: DataFrame,
    texts: Mapping[str, str],
    numbers: Mapping[str, int],
    n: int,
    *,
    ordered: bool = False,
) -> DataFrame:
    """Any ``n`` raw rows with exactly these texts and numbers, or the first ``n`` in order.

    Raw columns are text: numbers compare by value (``007`` is 7), and text
    that is no number fits none.
    """
    for name, value in texts.items():
        raw = raw.where(F.col(name) == F.lit(value))
    for name, value in numbers.items():
        raw = raw.where(F.col(name).try_cast("bigint") == F.lit(value))
    return _first(raw, n, ordered)


def profile(
    df: DataFrame, key: str, *, sentinel: Any = None, measures: Sequence[str] = ()
) -> DataFrame:
    """All counts of a table as rows ``(metric, value)``, from two passes over it.

    One pass takes every count that needs no grouping; the other groups by the
    key alone, so only keys and their counts are shuffled, whatever the number
    of columns.
    """
    counts = {"row_count": F.count(F.lit(1))}
    counts |= {f"null_{name}": F.count_if(F.col(name).isNull()) for name in df.columns}
    if sentinel is not None:
        counts["sentinel_rows"] = F.count_if(F.col(key) == F.lit(sentinel))
    if measures:
        counts["negative_rows"] = F.count_if(reduce(or_, (F.col(m) < 0 for m in measures)))

    real = F.col(key).isNotNull()
    if sentinel is not None:
        real &= F.col(key) != F.lit(sentinel)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = {
        "distinct_ids": F.count(key),
        "possible_duplicates": F.coalesce(F.sum("n"), F.lit(0)) - F.count(key),
        "repeated_ids": F.count_if(real & (F.col("n") > 1)),
    }
    return _as_rows(df, counts).unionByName(_as_rows(per_key, keys))


def _as_rows(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    wide = df.agg(*(count.alias(name) for name, count in counts.items()))
    return wide.unpivot([], list(counts), "metric", "value")
