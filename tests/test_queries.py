"""Every registered query against its SQL, on the bundled tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from ledgerloom.checks import oracles, registry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.build())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = registry.QUERIES[name](spark, SF_DIR)
    expected = duck.sql(oracles.build()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    rows = _sorted_rows(expected.columns, expected.fetchall())
    assert rows, "a check on no rows shows nothing"
    assert _sorted_rows(found.columns, [tuple(r) for r in found.collect()]) == rows
