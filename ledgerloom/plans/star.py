"""Star schema: four dimensions and the expense fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import date_key, date_parts
from ledgerloom.operators.keys import dense_key
from ledgerloom.operators.lookup import BROADCAST_BYTES, Lookup, require_unique, resolve
from ledgerloom.sources.literals import (
    DATE_SCHEMA,
    UNKNOWN_CANDIDATE,
    UNKNOWN_CANDIDATE_ID,
    UNKNOWN_DATE_KEY,
    with_member,
)


def candidate_dimension(candidates: DataFrame) -> DataFrame:
    """Candidates and the unknown member.

    An id that occurs twice, or is that of the unknown member, is an error, see README.
    """
    members = with_member(
        candidates.select("candidate_id", "candidate", "party", "office", "state"),
        {"candidate_id": UNKNOWN_CANDIDATE_ID, "candidate": UNKNOWN_CANDIDATE},
    )
    return require_unique(members, ["candidate_id"], "candidates")


def state_dimension(expenses: DataFrame, electorate: DataFrame) -> DataFrame:
    """One row per state with expenses, NULL included, and its voters (0 if it has none)."""
    voters = electorate.groupBy("state").agg(F.sum("voters").alias("total_voters"))
    # Both sides are grouped by state, so the join needs no further shuffle.
    members = (
        expenses.select("state")
        .distinct()
        .join(voters, "state", "left")
        .withColumn("total_voters", F.coalesce("total_voters", F.lit(0).cast("bigint")))
    )
    return dense_key(members, ["state"], "state_key")


def category_dimension(expenses: DataFrame) -> DataFrame:
    """One row per pair of category and detail text. Texts are compared as they are."""
    members = expenses.select("category", "detail").distinct()
    return dense_key(members, ["category", "detail"], "category_key")


def date_dimension(expenses: DataFrame) -> DataFrame:
    """One row per expense date, and the unknown member with key 0."""
    day = F.col("expense_date")
    members = (
        expenses.where(day.isNotNull())
        .select("expense_date")
        .distinct()
        .select(date_key(day).alias("date_key"), "expense_date", *_named(date_parts(day)))
    )
    return with_member(members, {"date_key": UNKNOWN_DATE_KEY}, DATE_SCHEMA)


def _named(columns):
    return [column.alias(name) for name, column in columns.items()]


def expense_fact(
    expenses: DataFrame,
    candidates: DataFrame,
    states: DataFrame,
    categories: DataFrame,
    dates: DataFrame,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per expense row: keys of the four dimensions and the amount.

    A candidate or date without a member takes the key of the unknown member; a
    NULL state, category or detail has no member to find and leaves its key NULL.
    """
    found = resolve(
        expenses,
        [
            Lookup(states, {"state": "state"}, {"state_key": "state_key"}),
            Lookup(
                categories,
                {"category": "category", "detail": "detail"},
                {"category_key": "category_key"},
            ),
            Lookup(dates, {"expense_date": "expense_date"}, {"date_key": "date_key"}),
            Lookup(candidates, {"candidate_id": "candidate_id"}, {"known_id": "candidate_id"}),
        ],
        broadcast_bytes=broadcast_bytes,
    )

    def or_unknown(column: str, unknown: int):
        return F.coalesce(column, F.lit(unknown).cast("bigint"))

    return found.select(
        "expense_id",
        or_unknown("known_id", UNKNOWN_CANDIDATE_ID).alias("candidate_id"),
        "state_key",
        "category_key",
        or_unknown("date_key", UNKNOWN_DATE_KEY).alias("date_key"),
        "amount",
    )
