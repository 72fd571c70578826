"""The five questions, asked of the flat mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranking import excluding, ratio, top_groups, top_in_top_groups
from ledgerloom.sources.layouts import NATIONAL_STATE


def top_states(flat: DataFrame, k: int = 5) -> DataFrame:
    """States with the largest expenses; national and unknown states do not count."""
    states = excluding(flat, "state", NATIONAL_STATE)
    return top_groups(states, ["state"], "amount", "total_expenses", k)


def top_candidates_in_top_states(flat: DataFrame, states: int = 5, members: int = 3) -> DataFrame:
    """The candidates with the largest expenses in each of the largest states.

    Candidates are told apart by id, so namesakes stay apart; rows without a
    known candidate count as one candidate.
    """
    ranked = top_in_top_groups(
        excluding(flat, "state", NATIONAL_STATE),
        "state",
        ["candidate_id", "candidate", "party", "office"],
        "amount",
        "total_expenses",
        groups=states,
        members=members,
    )
    return ranked.select(
        "state", "rank", "candidate_id", "candidate", "party", "office", "total_expenses"
    )


def top_categories(flat: DataFrame, k: int = 3) -> DataFrame:
    """Categories with the largest expenses; all states count, the national one too."""
    return top_groups(flat, ["category"], "amount", "total_expenses", k)


def top_details_in_top_categories(
    flat: DataFrame, categories: int = 3, members: int = 3
) -> DataFrame:
    """The detail texts with the largest expenses in each of the largest categories."""
    ranked = top_in_top_groups(
        flat,
        "category",
        ["detail"],
        "amount",
        "total_expenses",
        groups=categories,
        members=members,
    )
    return ranked.select("category", "rank", "detail", "total_expenses")


def cost_per_voter(flat: DataFrame) -> DataFrame:
    """Expenses per voter by state, largest first; NULL, and last, where there are no voters."""
    by_state = (
        excluding(flat, "state", NATIONAL_STATE)
        .groupBy("state")
        .agg(
            F.sum("amount").alias("total_expenses"),
            # Equal in all rows of a state.
            F.max("total_voters").alias("total_voters"),
        )
    )
    return by_state.withColumn(
        "expenses_per_voter", ratio("total_expenses", "total_voters")
    ).orderBy(F.desc_nulls_last("expenses_per_voter"), "state")
