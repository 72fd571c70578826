"""The three extracts, derived from the bundled test tables.

Order lines play the expenses, suppliers the candidates, customers the voter
groups. The test tables are clean, so defects of real extracts are put in by
rules on column values (never by leaving rows out):

=====================  =========================================================
order line with        becomes
=====================  =========================================================
quantity 50            sentinel: id -1, detail ``#NULO``, amount ``0,00``, no date
quantity 1             no state
quantity 2             no candidate
quantity 3             unreadable amount
quantity 4             unreadable date
quantity 5             no category
tax 0.08               candidate id that no candidate has
=====================  =========================================================

Nation ``NATION_19`` is the national pseudo-state of the expenses, so the
voters of that nation belong to a state without expenses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import amount_text_ptbr
from ledgerloom.functions.dates import DMY
from ledgerloom.functions.money import AMOUNT_TYPE
from ledgerloom.operators.lookup import broadcast_if_small
from ledgerloom.sources.delimited import write_delimited
from ledgerloom.sources.layouts import (
    CANDIDATES,
    ELECTORATE,
    EXPENSES,
    MISSING_EXPENSE_ID,
    NATIONAL_STATE,
    Layout,
)

NATIONAL_NATION = "NATION_19"
NO_CANDIDATE_OFFSET = 1_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(value: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(value), F.lit(" "))


def _in_layout(df: DataFrame, layout: Layout, columns: dict[str, Column]) -> DataFrame:
    """Columns under their extract headers, all as text."""
    return df.select(
        *(columns[f.name].cast("string").alias(f.header) for f in layout.fields)
    )


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "n_name")
    )
    # Measured, so that lines are shuffled only for a table that is really large. Parts are the
    # larger ones: joined first, while the lines are narrow.
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(broadcast_if_small(parts), F.col("l_partkey") == F.col("p_partkey"))
        .join(broadcast_if_small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    quantity = F.col("l_quantity")
    sentinel = quantity == 50
    state = F.when(F.col("n_name") == NATIONAL_NATION, NATIONAL_STATE).otherwise(F.col("n_name"))
    price = F.col("l_extendedprice").cast(AMOUNT_TYPE)
    return _in_layout(
        lines,
        EXPENSES,
        {
            "expense_id": F.when(sentinel, MISSING_EXPENSE_ID).otherwise(F.col("l_orderkey")),
            "candidate_id": F.when(quantity == 2, None)
            .when(F.col("l_tax") == 0.08, F.col("l_suppkey") + NO_CANDIDATE_OFFSET)
            .otherwise(F.col("l_suppkey")),
            "state": F.when(quantity != 1, _padded(state)),
            "category": F.when(quantity != 5, F.concat("p_type", F.lit(" "))),
            "detail": F.when(sentinel, "#NULO").otherwise(F.col("p_name")),
            "amount": F.when(sentinel, "0,00")
            .when(quantity == 3, "#NULO")
            .otherwise(amount_text_ptbr(price)),
            "expense_date": F.when(quantity == 4, "31/02/1996").when(
                ~sentinel, F.date_format("l_shipdate", DMY)
            ),
        },
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _in_layout(
        people,
        CANDIDATES,
        {
            "candidate_id": F.col("s_suppkey"),
            "candidate": F.concat(F.lit("  "), "s_name", F.lit(" ")),
            "party": _padded(F.col("r_name")),
            "office": F.concat(F.lit("OFFICE_"), F.col("s_suppkey") % 3),
            "state": _padded(F.col("n_name")),
        },
    )


def repeated_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of which those in debt are listed twice."""
    once = candidates(spark, sf_dir)
    debtors = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select("s_suppkey")
    twice = once.join(debtors, F.col("SQ_CANDIDATO") == F.col("s_suppkey").cast("string"), "semi")
    return once.unionByName(twice)


def electorate(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    number, balance = F.col("c_custkey"), F.col("c_acctbal")
    # The remainders repeat with town and zone, so some groups occur twice.
    return _in_layout(
        groups,
        ELECTORATE,
        {
            "generated_on": F.lit("01/09/2026"),
            "state": _padded(F.col("n_name")),
            "town_code": number % 50,
            "town": F.concat(F.lit("TOWN_"), number % 50, F.lit(" ")),
            "zone": number % 7,
            "gender": F.concat(F.lit("G"), number % 2),
            "marital_status": F.concat(F.lit("M"), number % 5),
            "age_band": F.concat(F.lit("A"), number % 7),
            "schooling": F.concat(F.lit("S"), number % 10),
            "race": F.concat(F.lit("R"), number % 5),
            "voting_duty": F.col("c_mktsegment"),
            "voters": F.floor(F.abs(balance)),
            "voters_biometrics": F.floor(F.abs(balance) / 2),
            "voters_disability": F.floor(balance / 100),
            "voters_social_name": number % 3,
        },
    )


class Landed(Mapping[str, str]):
    """Paths of the extracts by name; each is written as text when its path is first asked for."""

    _MAKE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        CANDIDATES.name: candidates,
        EXPENSES.name: expenses,
        ELECTORATE.name: electorate,
    }

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        self._spark, self._sf_dir, self._folder = spark, sf_dir, folder
        self._written: dict[str, str] = {}

    def __getitem__(self, name: str) -> str:
        if name not in self._written:
            rows = self._MAKE[name](self._spark, self._sf_dir)
            path = f"{self._folder}/extracts/{name}"
            write_delimited(rows, path)
            self._written[name] = path
        return self._written[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._MAKE)

    def __len__(self) -> int:
        return len(self._MAKE)


def land(spark: SparkSession, sf_dir: str, folder: str) -> Mapping[str, str]:
    """The paths of the extracts as text files; a table nobody reads is not written."""
    return Landed(spark, sf_dir, folder)
