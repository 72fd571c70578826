"""Queries over the bundled test tables, one per operator or dataflow.

A :class:`Warehouse` is loaded once per session and data folder from text
extracts; a query reads the tables it needs, which are built on first use,
and so are the extracts, written from the test tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as fn
from ledgerloom.operators import quality, ranking
from ledgerloom.operators.standardize import standardize
from ledgerloom.operators.keys import dense_key
from ledgerloom.plans import marts, questions, star
from ledgerloom.plans.names import COLUMNS, VIEWS
from ledgerloom.plans.warehouse import GOLD, Warehouse
from ledgerloom.sources import sample
from ledgerloom.sources.delimited import read_delimited
from ledgerloom.sources.layouts import (
    CANDIDATES,
    ELECTORATE,
    ELECTORATE_COUNTS,
    ELECTORATE_GRAIN,
    EXPENSES,
    MISSING_EXPENSE_ID,
)
from ledgerloom.sources.tables import create_database, fresh_folder, list_tables

# Values looked up by the point look-up and the drill-down.
LOOKED_UP_EXPENSE = 1102
DRILL_STATE, DRILL_TOWN, DRILL_ZONE = " nation_17 ", 7, 0

# Rows that the previews without an order show.
SENTINELS_SHOWN, DRILL_SHOWN, PREVIEWED = 10, 1, 20

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

_loaded: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        folder = fresh_folder(spark, "spending")
        database = folder.rsplit("/", 1)[1].replace("-", "_")
        extracts = sample.land(spark, sf_dir, folder)
        _loaded[key] = Warehouse(spark, extracts, folder, database)
    return _loaded[key]


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def on_warehouse(make: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[make.__name__] = lambda spark, sf_dir: make(warehouse(spark, sf_dir))
    return make


def _row_counts(tables: dict[str, DataFrame], label: str) -> DataFrame:
    counts = [
        quality.volume(df).select(F.lit(name).alias("table_name"), F.col("row_count").alias(label))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# Sources and typed tables.


@on_warehouse
def src_delimited(w: Warehouse) -> DataFrame:
    """The written text files, read with known headers and typed, per state and category."""
    raw = read_delimited(w.spark, w.extracts["expenses"], headers=EXPENSES.headers)
    return (
        standardize(raw, EXPENSES)
        .groupBy("state", "category")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("expense_date").alias("dated_rows"),
            F.sum("amount").alias("total_amount"),
        )
    )


@on_warehouse
def silver_candidates(w: Warehouse) -> DataFrame:
    return standardize(w.raw_candidates, CANDIDATES)


@on_warehouse
def silver_expenses(w: Warehouse) -> DataFrame:
    return standardize(w.raw_expenses, EXPENSES)


@on_warehouse
def silver_electorate(w: Warehouse) -> DataFrame:
    return standardize(w.raw_electorate, ELECTORATE)


@query
def scalar_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts up to ten digits as Brazilian text and back, negative ones too."""
    factor = F.when(F.col("l_linestatus") == "F", -12345).otherwise(12345).cast("decimal(5,0)")
    signed = F.col("l_extendedprice").cast("decimal(9,2)") * factor
    # Every fifth quantity has a third decimal, which rounds half up.
    third = F.when(F.col("l_quantity") % 5 == 0, "5").otherwise("")
    text = F.concat(F.lit(" "), fn.amount_text_ptbr(signed.cast("decimal(18,2)")), third)
    return (
        sample.table(spark, sf_dir, "lineitem")
        .select("l_returnflag", "l_linestatus", fn.amount_ptbr(text).alias("amount"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("amount").alias("readable"),
            F.sum("amount").alias("total"),
            F.min("amount").alias("smallest"),
            F.max("amount").alias("largest"),
        )
    )


@query
def scalar_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, every other status padded with spaces; both parsers, per date."""
    day = F.date_format("l_shipdate", "dd/MM/yyyy")
    raw = F.when(F.col("l_linestatus") == "F", F.concat(F.lit(" "), day, F.lit(" "))).otherwise(day)
    return (
        sample.table(spark, sf_dir, "lineitem")
        .select(raw.alias("raw"))
        .select(
            fn.dmy_date(F.col("raw")).alias("day"),
            fn.dmy_date_strict(F.col("raw")).alias("strict_day"),
        )
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count("strict_day").alias("strict_rows"))
    )


@on_warehouse
def preview_limit(w: Warehouse) -> DataFrame:
    return ranking.preview(w.dim_category.orderBy("category_key"), 10)


# Reconciliation and data quality.


@on_warehouse
def recon_counts(w: Warehouse) -> DataFrame:
    return quality.reconcile(
        {
            "candidates": (w.raw_candidates, w.silver_candidates),
            "expenses": (w.raw_expenses, w.silver_expenses),
            "electorate": (w.raw_electorate, w.silver_electorate),
        }
    )


@on_warehouse
def total_amount(w: Warehouse) -> DataFrame:
    return quality.control_total(w.silver_expenses, "amount")


@on_warehouse
def dq_uniqueness_expenses(w: Warehouse) -> DataFrame:
    return quality.uniqueness(w.silver_expenses, "expense_id")


@on_warehouse
def dq_uniqueness_candidates(w: Warehouse) -> DataFrame:
    return quality.uniqueness(w.silver_candidates, "candidate_id")


@on_warehouse
def dq_completeness_expenses(w: Warehouse) -> DataFrame:
    return quality.completeness(w.silver_expenses)


@on_warehouse
def dq_completeness_candidates(w: Warehouse) -> DataFrame:
    return quality.completeness(w.silver_candidates)


@on_warehouse
def dq_completeness_electorate(w: Warehouse) -> DataFrame:
    return quality.completeness(w.silver_electorate)


@on_warehouse
def dq_sentinel_rows(w: Warehouse) -> DataFrame:
    show = ["expense_id", "expense_date", "amount", "detail"]
    return quality.sample_with_value(
        w.silver_expenses, "expense_id", MISSING_EXPENSE_ID, show, 10, ordered=True
    )


@on_warehouse
def dq_sentinel_count(w: Warehouse) -> DataFrame:
    found = quality.with_value(w.silver_expenses, "expense_id", MISSING_EXPENSE_ID)
    return quality.volume(found)


@on_warehouse
def dq_duplicate_ids(w: Warehouse) -> DataFrame:
    return quality.most_repeated(
        w.silver_expenses, ["expense_id"], 20, ignore=MISSING_EXPENSE_ID
    )


@on_warehouse
def dq_duplicate_id_count(w: Warehouse) -> DataFrame:
    return quality.repeated_count(w.silver_expenses, ["expense_id"], ignore=MISSING_EXPENSE_ID)


@on_warehouse
def dq_point_lookup(w: Warehouse) -> DataFrame:
    return quality.with_value(w.silver_expenses, "expense_id", LOOKED_UP_EXPENSE)


@query
def dq_duplicate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = standardize(sample.repeated_candidates(spark, sf_dir), CANDIDATES)
    return quality.most_repeated(typed, ["candidate_id"])


@on_warehouse
def dq_orphan_count(w: Warehouse) -> DataFrame:
    return quality.orphan_count(w.silver_expenses, w.silver_candidates, "candidate_id")


@on_warehouse
def dq_orphan_rows(w: Warehouse) -> DataFrame:
    return quality.orphan_rows(w.silver_expenses, w.silver_candidates, "candidate_id")


@on_warehouse
def dq_volume_electorate(w: Warehouse) -> DataFrame:
    return quality.volume(w.silver_electorate)


@on_warehouse
def dq_grain_test(w: Warehouse) -> DataFrame:
    return quality.most_repeated(w.silver_electorate, ELECTORATE_GRAIN, 10)


@on_warehouse
def dq_bronze_drilldown(w: Warehouse) -> DataFrame:
    return quality.drill_down(
        w.raw_electorate,
        {"SG_UF": DRILL_STATE},
        {"CD_MUNICIPIO": DRILL_TOWN, "NR_ZONA": DRILL_ZONE},
        20,
        ordered=True,
    )


@on_warehouse
def dq_min_measures(w: Warehouse) -> DataFrame:
    return quality.minima(w.silver_electorate, ELECTORATE_COUNTS)


@on_warehouse
def dq_negative_measures(w: Warehouse) -> DataFrame:
    return quality.negative_count(w.silver_electorate, ELECTORATE_COUNTS)


@on_warehouse
def dq_profile_expenses(w: Warehouse) -> DataFrame:
    """The counts of the checks above at once, in two passes."""
    return quality.profile(
        w.silver_expenses, "expense_id", sentinel=MISSING_EXPENSE_ID, measures=["amount"]
    )


@on_warehouse
def dq_profile_candidates(w: Warehouse) -> DataFrame:
    return quality.profile(w.silver_candidates, "candidate_id")


@on_warehouse
def dq_orphan_count_shuffled(w: Warehouse) -> DataFrame:
    """As with more candidates than may be broadcast."""
    return quality.orphan_count(
        w.silver_expenses, w.silver_candidates, "candidate_id", broadcast_bytes=0
    )


@on_warehouse
def dq_orphan_rows_shuffled(w: Warehouse) -> DataFrame:
    return quality.orphan_rows(
        w.silver_expenses, w.silver_candidates, "candidate_id", broadcast_bytes=0
    )


@on_warehouse
def dq_sentinel_unordered(w: Warehouse) -> DataFrame:
    """Any ten rows with the value: which ones is open, how many and that they have it is not."""
    show = ["expense_id", "expense_date", "amount", "detail"]
    found = quality.sample_with_value(
        w.silver_expenses, "expense_id", MISSING_EXPENSE_ID, show, SENTINELS_SHOWN
    )
    return _shown(found, F.col("expense_id") == MISSING_EXPENSE_ID)


@on_warehouse
def dq_drilldown_unordered(w: Warehouse) -> DataFrame:
    found = quality.drill_down(
        w.raw_electorate,
        {"SG_UF": DRILL_STATE},
        {"CD_MUNICIPIO": DRILL_TOWN, "NR_ZONA": DRILL_ZONE},
        DRILL_SHOWN,
    )
    there = (F.trim("SG_UF") == DRILL_STATE.strip()) & (F.col("CD_MUNICIPIO") == str(DRILL_TOWN))
    return _shown(found, there & (F.col("NR_ZONA") == str(DRILL_ZONE)))


@on_warehouse
def preview_unordered(w: Warehouse) -> DataFrame:
    """Any twenty rows of the fact; every one of them has a key of the candidate dimension."""
    return _shown(ranking.preview(w.fact_expense, PREVIEWED), F.col("candidate_id").isNotNull())


def _shown(found: DataFrame, fits: Column) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("rows_shown"), F.count_if(fits).alias("rows_that_fit")
    )


# Star schema, marts, saved tables.


@on_warehouse
def dim_candidate(w: Warehouse) -> DataFrame:
    return w.dim_candidate


@on_warehouse
def dim_state(w: Warehouse) -> DataFrame:
    return w.dim_state.orderBy(F.asc_nulls_first("state"))


@on_warehouse
def dim_category(w: Warehouse) -> DataFrame:
    return w.dim_category


@on_warehouse
def dim_date(w: Warehouse) -> DataFrame:
    return w.dim_date


@on_warehouse
def fact_expense(w: Warehouse) -> DataFrame:
    return w.fact_expense


@on_warehouse
def fact_by_lookups(w: Warehouse) -> DataFrame:
    """The fact joined from expenses and dimensions, instead of cut out of the flat mart."""
    return star.expense_fact(w.silver_expenses, *w.dimensions)


@on_warehouse
def flat_from_fact(w: Warehouse) -> DataFrame:
    """The flat mart joined from the fact and its dimensions by key."""
    return marts.flat_mart(w.fact_expense, *w.dimensions)


@on_warehouse
def fact_shuffled(w: Warehouse) -> DataFrame:
    """The fact as with dimensions that are all too large to be broadcast."""
    return star.expense_fact(w.silver_expenses, *w.dimensions, broadcast_bytes=0)


@on_warehouse
def flat_shuffled(w: Warehouse) -> DataFrame:
    return marts.flat_from_expenses(w.silver_expenses, *w.dimensions, broadcast_bytes=0)


@on_warehouse
def dim_category_ranges(w: Warehouse) -> DataFrame:
    """Dense keys over a member list that is cut into several sorted ranges."""
    members = w.silver_expenses.select("category", "detail").distinct()
    return dense_key(members, ["category", "detail"], "category_key", ranges=7)


@on_warehouse
def state_mart(w: Warehouse) -> DataFrame:
    return w.state_mart


@on_warehouse
def flat_mart(w: Warehouse) -> DataFrame:
    return w.flat_mart


@on_warehouse
def sink_tables(w: Warehouse) -> DataFrame:
    """Rows of each saved table, read back from the catalog."""
    w.gold()
    return _row_counts(
        {name: w.spark.table(f"`{w.database}`.`{name}`") for name in GOLD}, "rows_read"
    )


@on_warehouse
def catalog_tables(w: Warehouse) -> DataFrame:
    """What the catalog lists after saving, with the rows the load handed over."""
    handed_over = _row_counts(w.gold(), "rows_saved")
    return list_tables(w.spark, w.database).drop("database").join(handed_over, "table_name")


@on_warehouse
def registered_views(w: Warehouse) -> DataFrame:
    """SQL over the Portuguese view names: rows of each of the eleven views."""
    views = w.register_views()
    counts = (f"SELECT '{view}' AS view_name, COUNT(*) AS row_count FROM {view}" for view in views)
    return w.spark.sql(" UNION ALL ".join(counts))


def _filled(spark: SparkSession, columns: dict[str, list[str]]) -> DataFrame:
    """SQL that reads every column of the named relations: how many values each has, and how many differ."""

    def profile(relation: str, column: str) -> str:
        name = relation.rsplit(".", 1)[-1].strip("`")
        # One distinct count an aggregate: it groups by that column alone and reads no other. Several in one
        # copy every row once a column, each copy with all columns as its key.
        return (
            f"SELECT '{name}' AS view_name, '{column}' AS column_name, COUNT({column}) AS filled, "
            f"COUNT(DISTINCT {column}) AS differing FROM {relation}"
        )

    return spark.sql(" UNION ALL ".join(profile(relation, c) for relation, own in columns.items() for c in own))


@on_warehouse
def sql_view_columns(w: Warehouse) -> DataFrame:
    """Every column of the typed and the star views by its Portuguese name."""
    w.register_views()
    return _filled(
        w.spark,
        {
            view: [COLUMNS.get(column, column) for column in getattr(w, name).columns]
            for name, view in VIEWS.items()
            if name != "raw_electorate"
        },
    )


@on_warehouse
def published_columns(w: Warehouse) -> DataFrame:
    """The same for the six views that publishing leaves in a database of the catalog."""
    database = f"{w.database}_published"
    w.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = dict(zip(w.publish(database), GOLD, strict=True))
    return _filled(
        w.spark,
        {
            view: [COLUMNS.get(column, column) for column in getattr(w, name).columns]
            for view, name in names.items()
        },
    )


@on_warehouse
def saved_columns(w: Warehouse) -> DataFrame:
    """The same for the six tables saved a second time under their Portuguese names."""
    database = f"{w.database}_saved"
    create_database(w.spark, database, f"{w.folder}/{database}")
    names = dict(zip(w.save_tables(database), GOLD, strict=True))
    return _filled(
        w.spark,
        {
            table: [COLUMNS.get(column, column) for column in getattr(w, name).columns]
            for table, name in names.items()
        },
    )


def _sql_on_views(text: str) -> Callable[[Warehouse], DataFrame]:
    def run(w: Warehouse) -> DataFrame:
        w.register_views()
        return w.spark.sql(text)

    return run


_SQL = {
    "sql_q1": """
        SELECT ESTADO AS state, SUM(VALOR_DESPESA) AS total_expenses
        FROM gold_despesa_analitica WHERE ESTADO <> 'BR'
        GROUP BY ESTADO ORDER BY total_expenses DESC NULLS LAST, state LIMIT 5""",
    "sql_q1_1": """
        WITH leaders AS (
          SELECT ESTADO FROM gold_despesa_analitica WHERE ESTADO <> 'BR'
          GROUP BY ESTADO ORDER BY SUM(VALOR_DESPESA) DESC NULLS LAST, ESTADO LIMIT 5
        ),
        spent AS (
          SELECT ESTADO, ID_CANDIDATO, CANDIDATO, PARTIDO, CARGO, SUM(VALOR_DESPESA) AS total
          FROM gold_despesa_analitica WHERE ESTADO IN (SELECT ESTADO FROM leaders)
          GROUP BY ALL
        ),
        placed AS (
          SELECT *, ROW_NUMBER() OVER (
            PARTITION BY ESTADO ORDER BY total DESC NULLS LAST, ID_CANDIDATO, CANDIDATO) AS place
          FROM spent
        )
        SELECT ESTADO AS state, CAST(place AS BIGINT) AS rank, ID_CANDIDATO AS candidate_id,
               CANDIDATO AS candidate, PARTIDO AS party, CARGO AS office, total AS total_expenses
        FROM placed WHERE place <= 3""",
    "sql_q2": """
        SELECT CATEGORIA_DESPESA AS category, SUM(VALOR_DESPESA) AS total_expenses
        FROM gold_despesa_analitica GROUP BY CATEGORIA_DESPESA
        ORDER BY total_expenses DESC NULLS LAST, category NULLS FIRST LIMIT 3""",
    "sql_q2_1": """
        WITH leaders AS (
          SELECT CATEGORIA_DESPESA FROM gold_despesa_analitica GROUP BY CATEGORIA_DESPESA
          ORDER BY SUM(VALOR_DESPESA) DESC NULLS LAST, CATEGORIA_DESPESA NULLS FIRST LIMIT 3
        ),
        spent AS (
          SELECT CATEGORIA_DESPESA, DESPESA_DETALHADA, SUM(VALOR_DESPESA) AS total
          FROM gold_despesa_analitica JOIN leaders USING (CATEGORIA_DESPESA)
          GROUP BY ALL
        )
        SELECT CATEGORIA_DESPESA AS category, CAST(place AS BIGINT) AS rank,
               DESPESA_DETALHADA AS detail, total AS total_expenses
        FROM (SELECT *, ROW_NUMBER() OVER (
                PARTITION BY CATEGORIA_DESPESA
                ORDER BY total DESC NULLS LAST, DESPESA_DETALHADA NULLS FIRST) AS place
              FROM spent) WHERE place <= 3""",
    "sql_q3": """
        SELECT ESTADO AS state, SUM(VALOR_DESPESA) AS total_expenses,
               MAX(TOTAL_ELEITORES) AS total_voters,
               ROUND(SUM(VALOR_DESPESA) / NULLIF(MAX(TOTAL_ELEITORES), 0), 2) AS expenses_per_voter
        FROM gold_despesa_analitica WHERE ESTADO <> 'BR' GROUP BY ESTADO""",
    "sql_duplicate_ids": """
        SELECT ID_DESPESA AS expense_id, COUNT(*) AS row_count
        FROM despesas_silver WHERE ID_DESPESA <> -1
        GROUP BY ID_DESPESA HAVING COUNT(*) > 1
        ORDER BY row_count DESC, expense_id LIMIT 20""",
    "sql_orphans": """
        SELECT COUNT(*) AS orphan_rows
        FROM despesas_silver d LEFT ANTI JOIN candidatos_silver c
          ON d.ID_CANDIDATO = c.ID_CANDIDATO""",
}

for _name, _text in _SQL.items():
    _run = _sql_on_views(_text)
    _run.__name__ = _name
    on_warehouse(_run)


# Questions.


@on_warehouse
def q1_top_states(w: Warehouse) -> DataFrame:
    return questions.top_states(w.flat_mart)


@on_warehouse
def q1_1_top_candidates(w: Warehouse) -> DataFrame:
    return questions.top_candidates_in_top_states(w.flat_mart)


@on_warehouse
def q2_top_categories(w: Warehouse) -> DataFrame:
    return questions.top_categories(w.flat_mart)


@on_warehouse
def q2_1_top_descriptions(w: Warehouse) -> DataFrame:
    return questions.top_details_in_top_categories(w.flat_mart)


@on_warehouse
def q3_cost_per_voter(w: Warehouse) -> DataFrame:
    return questions.cost_per_voter(w.flat_mart)
