"""Tables for reading: the fact with all its dimensions, and totals by state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import BROADCAST_BYTES, Lookup, resolve
from ledgerloom.operators.ranking import excluding, totals
from ledgerloom.sources.layouts import NATIONAL_STATE
from ledgerloom.sources.literals import UNKNOWN_CANDIDATE, UNKNOWN_CANDIDATE_ID, UNKNOWN_DATE_KEY

FACT_COLUMNS = ["expense_id", "candidate_id", "state_key", "category_key", "date_key", "amount"]

FLAT_COLUMNS = [
    "expense_id",
    "candidate_id",
    "candidate",
    "party",
    "office",
    "state_key",
    "state",
    "total_voters",
    "category_key",
    "category",
    "detail",
    "date_key",
    "expense_date",
    "year",
    "month",
    "day",
    "quarter",
    "amount",
]


def _attributes(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def flat_mart(
    fact: DataFrame,
    candidates: DataFrame,
    states: DataFrame,
    categories: DataFrame,
    dates: DataFrame,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per fact row with the attributes of its four members."""
    return resolve(
        fact,
        [
            Lookup(
                candidates,
                {"candidate_id": "candidate_id"},
                _attributes("candidate", "party", "office"),
            ),
            Lookup(states, {"state_key": "state_key"}, _attributes("state", "total_voters")),
            Lookup(
                categories, {"category_key": "category_key"}, _attributes("category", "detail")
            ),
            Lookup(
                dates,
                {"date_key": "date_key"},
                _attributes("expense_date", "year", "month", "day", "quarter"),
            ),
        ],
        broadcast_bytes=broadcast_bytes,
    ).select(*FLAT_COLUMNS)


def flat_from_expenses(
    expenses: DataFrame,
    candidates: DataFrame,
    states: DataFrame,
    categories: DataFrame,
    dates: DataFrame,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The flat mart straight from the expenses, each dimension joined once.

    Same rows as :func:`flat_mart` over the fact, without the second join of a
    large table with every dimension; the fact is a projection of the result.
    """
    wide = resolve(
        expenses.withColumnsRenamed({name: f"__{name}" for name in expenses.columns}),
        [
            Lookup(
                candidates,
                {"__candidate_id": "candidate_id"},
                {"known_id": "candidate_id", "name": "candidate"} | _attributes("party", "office"),
            ),
            Lookup(states, {"__state": "state"}, _attributes("state_key", "total_voters")),
            Lookup(
                categories,
                {"__category": "category", "__detail": "detail"},
                _attributes("category_key"),
            ),
            Lookup(
                dates,
                {"__expense_date": "expense_date"},
                _attributes("date_key", "year", "month", "day", "quarter"),
            ),
        ],
        broadcast_bytes=broadcast_bytes,
    )

    # Texts and dates are those of the member found, which the expense has as
    # well: no need to carry them through the join a second time. Where one part
    # of a composite key is NULL there is no member, and both parts are NULL.
    def of_member(column: str, key: str) -> Column:
        return F.when(F.col(key).isNotNull(), F.col(f"__{column}"))

    known = F.col("known_id").isNotNull()
    derived = {
        "expense_id": F.col("__expense_id"),
        "amount": F.col("__amount"),
        "candidate_id": F.coalesce("known_id", F.lit(UNKNOWN_CANDIDATE_ID).cast("bigint")),
        "candidate": F.when(known, F.col("name")).otherwise(F.lit(UNKNOWN_CANDIDATE)),
        "state": of_member("state", "state_key"),
        "category": of_member("category", "category_key"),
        "detail": of_member("detail", "category_key"),
        "expense_date": of_member("expense_date", "date_key"),
        "date_key": F.coalesce("date_key", F.lit(UNKNOWN_DATE_KEY).cast("bigint")),
    }
    return wide.select(*(derived.get(n, F.col(n)).alias(n) for n in FLAT_COLUMNS))


def state_mart(fact: DataFrame, states: DataFrame) -> DataFrame:
    """Total expenses by state, without the national pseudo-state and without unknown states.

    The fact is summed per state key first; the join then has one row per state.
    """
    by_state = totals(fact, ["state_key"], "amount", "total_expenses")
    return (
        by_state.join(excluding(states, "state", NATIONAL_STATE), "state_key")
        .select("state_key", "state", "total_voters", "total_expenses")
        .orderBy(F.desc_nulls_last("total_expenses"), "state_key")
    )
