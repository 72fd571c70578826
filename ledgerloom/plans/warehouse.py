"""From three extracts to saved tables, each step stored once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.lookup import BROADCAST_BYTES
from ledgerloom.operators.standardize import standardize
from ledgerloom.plans import marts, star
from ledgerloom.plans.names import COLUMNS, VIEWS
from ledgerloom.sources.delimited import read_delimited
from ledgerloom.sources.layouts import CANDIDATES, ELECTORATE, EXPENSES, Layout
from ledgerloom.sources.tables import (
    create_database,
    register_view,
    save_copy,
    save_table,
    save_view,
    store,
    without_intermediates,
)

GOLD = ["dim_candidate", "dim_state", "dim_category", "dim_date", "fact_expense", "flat_mart"]


class Warehouse:
    """Tables of one load, as attributes; asking for a table builds what it needs.

    Typed tables are stored below ``folder``, dimensions, fact and flat mart are
    saved as catalog tables of ``database``. Later steps read the stored tables,
    so the text is parsed once and no step repeats the work of another.

    ``extracts`` gives the path of each extract under the names ``candidates``,
    ``expenses`` and ``electorate``; a path is asked for when its extract is read. ``folder``
    must be reachable by all executors.
    ``broadcast_bytes`` is the size up to which a dimension is sent to every
    executor; larger ones are joined by shuffle.
    """

    def __init__(
        self,
        spark: SparkSession,
        extracts: Mapping[str, str],
        folder: str,
        database: str = "spending",
        *,
        broadcast_bytes: int = BROADCAST_BYTES,
    ):
        self.spark = spark
        self.extracts = extracts
        self.folder = folder.rstrip("/")
        self.database = database
        self.broadcast_bytes = broadcast_bytes
        create_database(spark, database, f"{self.folder}/{database}")

    # Bronze: text as it comes.

    def _raw(self, layout: Layout) -> DataFrame:
        return read_delimited(self.spark, self.extracts[layout.name])

    @cached_property
    def raw_candidates(self) -> DataFrame:
        return self._raw(CANDIDATES)

    @cached_property
    def raw_expenses(self) -> DataFrame:
        return self._raw(EXPENSES)

    @cached_property
    def raw_electorate(self) -> DataFrame:
        return self._raw(ELECTORATE)

    # Silver: typed, same rows.

    def _typed(self, raw: DataFrame, layout: Layout, find_by: str | None = None) -> DataFrame:
        path = f"{self.folder}/silver/{layout.name}"
        return store(standardize(raw, layout), path, find_by=find_by)

    @cached_property
    def silver_candidates(self) -> DataFrame:
        return self._typed(self.raw_candidates, CANDIDATES)

    @cached_property
    def silver_expenses(self) -> DataFrame:
        return self._typed(self.raw_expenses, EXPENSES, find_by="expense_id")

    @cached_property
    def silver_electorate(self) -> DataFrame:
        return self._typed(self.raw_electorate, ELECTORATE)

    # Gold: star schema and marts.

    def _saved(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with without_intermediates(self.spark):
            return save_table(build(), self.database, name)

    @cached_property
    def dim_candidate(self) -> DataFrame:
        candidates = self.silver_candidates
        return self._saved("dim_candidate", lambda: star.candidate_dimension(candidates))

    @cached_property
    def dim_state(self) -> DataFrame:
        expenses, electorate = self.silver_expenses, self.silver_electorate
        return self._saved("dim_state", lambda: star.state_dimension(expenses, electorate))

    @cached_property
    def dim_category(self) -> DataFrame:
        expenses = self.silver_expenses
        return self._saved("dim_category", lambda: star.category_dimension(expenses))

    @cached_property
    def dim_date(self) -> DataFrame:
        expenses = self.silver_expenses
        return self._saved("dim_date", lambda: star.date_dimension(expenses))

    @cached_property
    def dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.dim_candidate, self.dim_state, self.dim_category, self.dim_date

    @cached_property
    def flat_mart(self) -> DataFrame:
        expenses, dimensions, limit = self.silver_expenses, self.dimensions, self.broadcast_bytes
        return self._saved(
            "flat_mart",
            lambda: marts.flat_from_expenses(expenses, *dimensions, broadcast_bytes=limit),
        )

    @cached_property
    def fact_expense(self) -> DataFrame:
        """Six columns of the flat mart, so no dimension is joined a second time."""
        flat = self.flat_mart
        return self._saved("fact_expense", lambda: flat.select(*marts.FACT_COLUMNS))

    @property
    def state_mart(self) -> DataFrame:
        """Not saved: one small aggregation of the fact."""
        return marts.state_mart(self.fact_expense, self.dim_state)

    def gold(self) -> dict[str, DataFrame]:
        """All saved tables, built now if they are not yet."""
        return {name: getattr(self, name) for name in GOLD}

    def register_views(self) -> list[str]:
        """The eleven tables as temporary views under their Portuguese names."""
        for name, view in VIEWS.items():
            register_view(getattr(self, name), view, COLUMNS)
        return list(VIEWS.values())

    def save_tables(self, database: str = "default") -> list[str]:
        """The saved tables once more, as managed tables under their Portuguese names.

        They can be overwritten, appended to or dropped without touching those of the load.
        Saving again replaces them, and views that :meth:`publish` left there.
        """
        saved = self.gold()
        for name, rows in saved.items():
            save_copy(rows.withColumnsRenamed(COLUMNS), database, VIEWS[name])
        return [f"`{database}`.`{VIEWS[name]}`" for name in saved]

    def publish(self, database: str = "default") -> list[str]:
        """The saved tables as catalog views under their Portuguese names, without a second copy."""
        views = []
        for name in self.gold():
            views.append(f"`{database}`.`{VIEWS[name]}`")
            save_view(self.spark, f"`{self.database}`.`{name}`", views[-1], COLUMNS)
        return views
