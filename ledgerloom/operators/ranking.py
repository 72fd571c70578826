"""Totals, top lists, top lists inside top groups, and ratios."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows; the first ``n`` if ``df`` is sorted."""
    return df.limit(n)


def excluding(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows with another value. NULL is not another value, so those rows go too."""
    return df.where(F.col(column) != F.lit(value))


def totals(df: DataFrame, by: Sequence[str], measure: str, total: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(measure).alias(total))


def _largest_first(total: str, ties: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(total), *(F.asc_nulls_first(name) for name in ties)]


def top_groups(df: DataFrame, by: Sequence[str], measure: str, total: str, k: int) -> DataFrame:
    """The ``k`` groups with the largest total; equal totals in key order."""
    return totals(df, by, measure, total).orderBy(*_largest_first(total, by)).limit(k)


def top_in_top_groups(
    df: DataFrame,
    group: str,
    member: Sequence[str],
    measure: str,
    total: str,
    *,
    groups: int,
    members: int,
) -> DataFrame:
    """The ``members`` largest members inside each of the ``groups`` largest groups.

    ``rank`` counts from 1; equal totals rank in member order. A NULL group can
    be among the largest, but equals no row, so it lists no members.
    """
    leaders = top_groups(df, [group], measure, total, groups).select(group)
    # At most ``groups`` rows, so the broadcast is bounded whatever the data.
    inside = df.join(F.broadcast(leaders), group, "left_semi")
    # Totals come before the window, and Spark keeps only the first rows of each
    # group on every task before it brings a group together.
    best_first = Window.partitionBy(group).orderBy(*_largest_first(total, member))
    return (
        totals(inside, [group, *member], measure, total)
        .withColumn("rank", F.row_number().over(best_first).cast("bigint"))
        .where(F.col("rank") <= members)
        .orderBy(F.asc_nulls_first(group), "rank")
        # There are no more rows than this, so none is cut; the sort then needs no range shuffle.
        .limit(groups * members)
    )


def ratio(over: str, under: str, digits: int = 2) -> Column:
    """``over / under`` rounded half up; NULL when ``under`` is zero or NULL."""
    return F.round(F.col(over) / F.nullif(F.col(under), F.lit(0)), digits)
