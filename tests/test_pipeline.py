"""A load from small hand-written extracts, row by row, and what must hold for any load."""

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.checks import registry
from ledgerloom.plans import marts, questions, star
from ledgerloom.plans.names import COLUMNS
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources.tables import create_database, fresh_folder, shared_folder

SF_DIR = "/root/testdata/sf0.001"

CANDIDATES = """DT_GERACAO;SQ_CANDIDATO;NM_CANDIDATO;SG_PARTIDO;DS_CARGO;SG_UF
"01/09/2026";"10";" Ana ";"aa ";"Governador";"sp"
"01/09/2026";"11";"Beto";"BB";"Senador";"rj"
"01/09/2026";"12";"Ana";"CC";"Senador";"sp"
"""

EXPENSES = """SQ_DESPESA;SQ_CANDIDATO;SG_UF;DS_ORIGEM_DESPESA;DS_DESPESA;VR_DESPESA_CONTRATADA;DT_DESPESA
"1";"10";" sp ";"Publicação";"Santinhos";"1.000,00";"02/09/2026"
"1";"10";"SP";"Publicação ";"Bandeira";"0,50";" 03/09/2026 "
"2";"11";"RJ";"Serviços";"Som";"300,00";"02/09/2026"
"3";"12";"SP";"Serviços";"Som";"1.000,50";"1/9/2026"
"4";"99";"SP";"Serviços";"Luz; palco";"10,005";"02/09/2026"
"-1";"11";"RJ";"Serviços";"#NULO";"0,00";""
"5";"11";"BR";"Publicação";"Santinhos";"9.999,99";"02/09/2026"
"6";"";"";"";"Som";"5,00";"02/09/2026"
"7";"11";"AC";"Serviços";"Som";"#NULO";"02/09/2026"
"""

ELECTORATE = """DT_GERACAO;SG_UF;CD_MUNICIPIO;NM_MUNICIPIO;NR_ZONA;DS_GENERO;DS_ESTADO_CIVIL;DS_FAIXA_ETARIA;DS_GRAU_INSTRUCAO;DS_COR_RACA;TP_OBRIGATORIEDADE_VOTO;QT_ELEITORES;QT_ELEITORES_BIOMETRIA;QT_ELEITORES_DEFICIENCIA;QT_ELEITORES_NOME_SOCIAL
"01/09/2026";"SP";"1";"São Paulo";"1";"F";"S";"20";"M";"P";"O";"600";"1";"0";"0"
"01/09/2026";"sp";"1";"São Paulo";"2";"F";"S";"20";"M";"P";"O";"400";"1";"0";"0"
"01/09/2026";"RJ";"2";"Rio";"1";"F";"S";"20";"M";"P";"O";"7";"1";"0";"0"
"01/09/2026";"MG";"3";"BH";"1";"F";"S";"20";"M";"P";"O";"1000";"1";"0";"0"
"""


def write(folder, name, text):
    path = folder / f"{name}.csv"
    path.write_bytes(text.encode("iso-8859-1"))
    return str(path)


@pytest.fixture(scope="module")
def load(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("extracts")
    paths = {
        "candidates": write(folder, "candidates", CANDIDATES),
        "expenses": write(folder, "expenses", EXPENSES),
        "electorate": write(folder, "electorate", ELECTORATE),
    }
    return Warehouse(spark, paths, fresh_folder(spark, "small"), "small")


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


def test_dimensions(load):
    assert rows(load.dim_candidate, "candidate_id") == [
        (-1, "CANDIDATO NÃO IDENTIFICADO", None, None, None),
        (10, "Ana", "AA", "Governador", "SP"),
        (11, "Beto", "BB", "Senador", "RJ"),
        (12, "Ana", "CC", "Senador", "SP"),
    ]
    # Minas has voters but no expenses; AC and BR have expenses but no voters.
    assert rows(load.dim_state, "state_key") == [
        (1, None, 0),
        (2, "AC", 0),
        (3, "BR", 0),
        (4, "RJ", 7),
        (5, "SP", 1000),
    ]
    assert rows(load.dim_category, "category_key") == [
        (1, None, "Som"),
        (2, "Publicação", "Bandeira"),
        (3, "Publicação", "Santinhos"),
        (4, "Serviços", "#NULO"),
        (5, "Serviços", "Luz; palco"),
        (6, "Serviços", "Som"),
    ]
    assert rows(load.dim_date, "date_key") == [
        (0, None, None, None, None, None),
        (20260902, date(2026, 9, 2), 2026, 9, 2, 3),
        (20260903, date(2026, 9, 3), 2026, 9, 3, 3),
    ]


def test_fact_keys(load):
    assert rows(load.fact_expense, "expense_id", "category_key") == [
        (-1, 11, 4, 4, 0, Decimal("0.00")),
        (1, 10, 5, 2, 20260903, Decimal("0.50")),
        (1, 10, 5, 3, 20260902, Decimal("1000.00")),
        (2, 11, 4, 6, 20260902, Decimal("300.00")),
        (3, 12, 5, 6, 0, Decimal("1000.50")),
        (4, -1, 5, 5, 20260902, Decimal("10.01")),
        (5, 11, 3, 3, 20260902, Decimal("9999.99")),
        (6, -1, None, None, 20260902, Decimal("5.00")),
        (7, 11, 2, 6, 20260902, None),
    ]


def test_questions(load):
    assert rows(questions.top_states(load.flat_mart, 2)) == [
        ("SP", Decimal("2011.01")),
        ("RJ", Decimal("300.00")),
    ]
    # Namesakes stay apart, the candidate without a record is one of the three.
    top = rows(questions.top_candidates_in_top_states(load.flat_mart, 1, 3))
    assert [(r[1], r[2], r[3], r[6]) for r in top] == [
        (1, 10, "Ana", Decimal("1000.50")),
        (2, 12, "Ana", Decimal("1000.50")),
        (3, -1, "CANDIDATO NÃO IDENTIFICADO", Decimal("10.01")),
    ]
    assert rows(questions.top_categories(load.flat_mart, 1)) == [
        ("Publicação", Decimal("11000.49"))
    ]
    assert rows(questions.cost_per_voter(load.flat_mart)) == [
        ("RJ", Decimal("300.00"), 7, Decimal("42.86")),
        ("SP", Decimal("2011.01"), 1000, Decimal("2.01")),
        ("AC", None, 0, None),
    ]
    assert [r[1] for r in rows(load.state_mart)] == ["SP", "RJ", "AC"]


def test_sql_with_portuguese_names(spark, load):
    load.register_views()
    total = spark.sql(
        "SELECT SUM(VALOR_DESPESA) FROM despesas_silver WHERE DATA_DESPESA IS NOT NULL"
    )
    assert total.first()[0] == Decimal("11315.50")
    found = spark.sql(
        """SELECT g.ESTADO, e.TOTAL_DESPESAS, SUM(g.VALOR_DESPESA) AS TOTAL
           FROM gold_despesa_analitica g JOIN gold_estado e ON g.ID_ESTADO = e.ID_ESTADO
           WHERE g.TRIMESTRE = 3 AND g.CANDIDATO = 'Ana' GROUP BY ALL"""
    )
    assert rows(found) == [("SP", Decimal("2011.01"), Decimal("1000.50"))]
    raw = spark.sql("SELECT * FROM eleitorado_bronze WHERE SG_UF = 'sp' AND NR_ZONA = 2")
    assert raw.count() == 1


def test_published_tables_are_listed(spark, load):
    views = load.publish("default")
    assert len(views) == 6
    listed = {
        row.tableName for row in spark.sql("SHOW TABLES IN default").collect() if row.namespace
    }
    assert {"dim_candidato", "dim_estado", "dim_data", "fact_despesa"} <= listed
    assert spark.sql("SELECT COUNT(ID_DESPESA) FROM default.fact_despesa").first()[0] == 9


def test_saved_tables_are_tables_of_their_own(spark, load):
    create_database(spark, "shown", f"{load.folder}/shown")
    load.publish("shown")
    for _ in range(2):
        names = load.save_tables("shown")
        assert len(names) == 6
        assert {spark.catalog.getTable(n).tableType for n in names} == {"MANAGED"}
    fact = spark.table("shown.fact_despesa")
    assert fact.columns == [COLUMNS.get(c, c) for c in load.fact_expense.columns]
    assert sorted(rows(fact), key=repr) == sorted(rows(load.fact_expense), key=repr)
    spark.sql("DROP TABLE shown.fact_despesa")
    fact = load.spark.table(f"`{load.database}`.fact_expense")
    assert fact.count() == load.fact_expense.count() == 9
    spark.sql("DROP DATABASE shown CASCADE")


def test_repeated_candidate_is_refused(spark, load):
    twice = load.silver_candidates.unionByName(load.silver_candidates.where("candidate_id = 10"))
    unknown = load.silver_candidates.withColumn("candidate_id", F.lit(-1).cast("bigint")).limit(1)
    for candidates in (twice, load.silver_candidates.unionByName(unknown)):
        with pytest.raises(ValueError, match="candidates: duplicated key"):
            star.candidate_dimension(candidates)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_all_ways_give_the_same_tables(load, limit):
    dims = load.dimensions
    for expected, found in (
        (load.fact_expense, star.expense_fact(load.silver_expenses, *dims, broadcast_bytes=limit)),
        (load.flat_mart, marts.flat_mart(load.fact_expense, *dims, broadcast_bytes=limit)),
        (
            load.flat_mart,
            marts.flat_from_expenses(load.silver_expenses, *dims, broadcast_bytes=limit),
        ),
    ):
        assert found.columns == expected.columns
        assert sorted(rows(found), key=repr) == sorted(rows(expected), key=repr)


def test_invariants(spark):
    w = registry.warehouse(spark, SF_DIR)
    silver, fact, flat = w.silver_expenses, w.fact_expense, w.flat_mart
    assert silver.count() == fact.count() == flat.count() == 6000
    sums = [df.agg(F.sum("amount")).first()[0] for df in (silver, fact, flat)]
    assert sums[0] == sums[1] == sums[2]
    for dim, key in (("dim_state", "state_key"), ("dim_category", "category_key")):
        low, high, n, distinct = (
            getattr(w, dim)
            .agg(F.min(key), F.max(key), F.count(F.lit(1)), F.count_distinct(key))
            .first()
        )
        assert (low, high) == (1, n) and distinct == n
    for dim, key in (("dim_candidate", "candidate_id"), ("dim_date", "date_key")):
        assert fact.join(getattr(w, dim), key, "left_anti").count() == 0


def test_second_load_gives_the_same_tables(spark):
    first = registry.warehouse(spark, SF_DIR)
    again = Warehouse(spark, first.extracts, fresh_folder(spark, "again"), "again")
    for name, df in first.gold().items():
        assert df.exceptAll(getattr(again, name)).count() == 0
        assert df.count() == getattr(again, name).count()


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["state", "total_expenses"]
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_a_load_leaves_no_intermediates(spark, tmp_path, limit):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    paths = {
        "candidates": write(tmp_path, "candidates", CANDIDATES),
        "expenses": write(tmp_path, "expenses", EXPENSES),
        "electorate": write(tmp_path, "electorate", ELECTORATE),
    }
    before = set(shared.iterdir())
    folder = fresh_folder(spark, "clean")
    w = Warehouse(spark, paths, folder, f"clean_{limit}", broadcast_bytes=limit)
    assert len(w.gold()) == 6 and w.flat_mart.count() == 9
    assert set(shared.iterdir()) - before == {shared / folder.rsplit("/", 1)[1]}
    made = {p.name for p in (shared / folder.rsplit("/", 1)[1]).iterdir()}
    assert made == {"silver", f"clean_{limit}"}
