"""DuckDB SQL over the test tables with the result each registered query must have.

Written straight from the test tables, without text, parsers or stored steps.
"""

from __future__ import annotations

from ledgerloom.plans.names import COLUMNS, VIEWS

EXP = """
exp AS (
  SELECT CASE WHEN l_quantity = 50 THEN -1 ELSE l_orderkey END AS expense_id,
         CASE WHEN l_quantity = 2 THEN NULL WHEN l_tax = 0.08::DOUBLE THEN l_suppkey + 1000000000
              ELSE l_suppkey END AS candidate_id,
         CASE WHEN l_quantity = 1 THEN NULL WHEN n_name = 'NATION_19' THEN 'BR'
              ELSE n_name END AS state,
         CASE WHEN l_quantity = 5 THEN NULL ELSE p_type END AS category,
         CASE WHEN l_quantity = 50 THEN '#NULO' ELSE p_name END AS detail,
         CAST(CASE WHEN l_quantity = 50 THEN 0 WHEN l_quantity = 3 THEN NULL
              ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount,
         CASE WHEN l_quantity IN (4, 50) THEN NULL ELSE CAST(l_shipdate AS DATE) END AS expense_date
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""

CAND = """
cand AS (
  SELECT s_suppkey AS candidate_id, s_name AS candidate, upper(r_name) AS party,
         'OFFICE_' || (s_suppkey % 3) AS office, n_name AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

ELEC = """
elec AS (
  SELECT DATE '2026-09-01' AS generated_on, n_name AS state,
         CAST(c_custkey % 50 AS INTEGER) AS town_code, 'TOWN_' || (c_custkey % 50) AS town,
         CAST(c_custkey % 7 AS INTEGER) AS zone, 'G' || (c_custkey % 2) AS gender,
         'M' || (c_custkey % 5) AS marital_status, 'A' || (c_custkey % 7) AS age_band,
         'S' || (c_custkey % 10) AS schooling, 'R' || (c_custkey % 5) AS race,
         c_mktsegment AS voting_duty, CAST(floor(abs(c_acctbal)) AS BIGINT) AS voters,
         CAST(floor(abs(c_acctbal) / 2) AS BIGINT) AS voters_biometrics,
         CAST(floor(c_acctbal / 100) AS BIGINT) AS voters_disability,
         CAST(c_custkey % 3 AS BIGINT) AS voters_social_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

STATES = """
states AS (
  SELECT row_number() OVER (ORDER BY state ASC NULLS FIRST) AS state_key, state,
         CAST(coalesce(total_voters, 0) AS BIGINT) AS total_voters
  FROM (SELECT DISTINCT state FROM exp)
       LEFT JOIN (SELECT state, sum(voters) AS total_voters FROM elec GROUP BY state) USING (state)
)"""

CATEGORIES = """
categories AS (
  SELECT row_number() OVER (ORDER BY category ASC NULLS FIRST, detail ASC NULLS FIRST)
           AS category_key, category, detail
  FROM (SELECT DISTINCT category, detail FROM exp)
)"""

DATES = """
dates AS (
  SELECT CAST(strftime(expense_date, '%Y%m%d') AS BIGINT) AS date_key, expense_date,
         CAST(year(expense_date) AS INTEGER) AS year, CAST(month(expense_date) AS INTEGER) AS month,
         CAST(day(expense_date) AS INTEGER) AS day,
         CAST(quarter(expense_date) AS INTEGER) AS quarter
  FROM (SELECT DISTINCT expense_date FROM exp WHERE expense_date IS NOT NULL)
  UNION ALL SELECT 0, NULL, NULL, NULL, NULL, NULL
)"""

PEOPLE = """
people AS (
  SELECT * FROM cand
  UNION ALL SELECT -1, 'CANDIDATO NÃO IDENTIFICADO', NULL, NULL, NULL
)"""

FACT = """
fact AS (
  SELECT e.expense_id, coalesce(p.candidate_id, -1) AS candidate_id, s.state_key, c.category_key,
         coalesce(d.date_key, 0) AS date_key, e.amount
  FROM exp e LEFT JOIN states s ON e.state = s.state
       LEFT JOIN categories c ON e.category = c.category AND e.detail = c.detail
       LEFT JOIN dates d ON e.expense_date = d.expense_date
       LEFT JOIN people p ON e.candidate_id = p.candidate_id
)"""

FLAT = """
flat AS (
  SELECT f.expense_id, f.candidate_id, p.candidate, p.party, p.office, s.state_key, s.state,
         s.total_voters, c.category_key, c.category, c.detail, d.date_key, d.expense_date,
         d.year, d.month, d.day, d.quarter, f.amount
  FROM fact f LEFT JOIN people p ON f.candidate_id = p.candidate_id
       LEFT JOIN states s ON f.state_key = s.state_key
       LEFT JOIN categories c ON f.category_key = c.category_key
       LEFT JOIN dates d ON f.date_key = d.date_key
)"""

_ALL = [EXP, CAND, ELEC, STATES, CATEGORIES, DATES, PEOPLE, FACT, FLAT]


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _exp(select: str) -> str:
    return _sql([EXP], select)


def _cand(select: str) -> str:
    return _sql([CAND], select)


def _elec(select: str) -> str:
    return _sql([ELEC], select)


def _star(select: str) -> str:
    return _sql(_ALL, select)


def _nulls(columns: str) -> str:
    counts = (f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in columns.split())
    return "count(*) AS row_count, " + ", ".join(counts)


_GRAIN = (
    "generated_on, state, town_code, zone, gender, marital_status, age_band, schooling, race, "
    "voting_duty"
)
_GRAIN_ORDER = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in _GRAIN.split(","))

_RAW_ELECTORATE = """
SELECT '01/09/2026' AS DT_GERACAO, ' ' || lower(n_name) || ' ' AS SG_UF,
       CAST(c_custkey % 50 AS VARCHAR) AS CD_MUNICIPIO,
       'TOWN_' || (c_custkey % 50) || ' ' AS NM_MUNICIPIO,
       CAST(c_custkey % 7 AS VARCHAR) AS NR_ZONA, 'G' || (c_custkey % 2) AS DS_GENERO,
       'M' || (c_custkey % 5) AS DS_ESTADO_CIVIL, 'A' || (c_custkey % 7) AS DS_FAIXA_ETARIA,
       'S' || (c_custkey % 10) AS DS_GRAU_INSTRUCAO, 'R' || (c_custkey % 5) AS DS_COR_RACA,
       c_mktsegment AS TP_OBRIGATORIEDADE_VOTO,
       CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS QT_ELEITORES,
       CAST(CAST(floor(abs(c_acctbal) / 2) AS BIGINT) AS VARCHAR) AS QT_ELEITORES_BIOMETRIA,
       CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) AS QT_ELEITORES_DEFICIENCIA,
       CAST(c_custkey % 3 AS VARCHAR) AS QT_ELEITORES_NOME_SOCIAL
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = 'NATION_17' AND c_custkey % 50 = 7 AND c_custkey % 7 = 0
ORDER BY ALL NULLS FIRST LIMIT 20
"""

_TABLES = {
    "dim_candidate": "people",
    "dim_state": "states",
    "dim_category": "categories",
    "dim_date": "dates",
    "fact_expense": "fact",
    "flat_mart": "flat",
}

_VIEWS = {
    "despesas_silver": "exp",
    "candidatos_silver": "cand",
    "eleitorado_silver": "elec",
    "eleitorado_bronze": "elec",
    "dim_candidato": "people",
    "dim_estado": "states",
    "dim_categoria_despesa": "categories",
    "dim_data": "dates",
    "fact_despesa": "fact",
    "gold_estado": "states WHERE state <> 'BR'",
    "gold_despesa_analitica": "flat",
}


def _counts(tables: dict[str, str], name: str, count: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS {name}, count(*) AS {count} FROM {source}"
        for shown, source in tables.items()
    )


_TOTAL = "CAST(sum(amount) AS DECIMAL(28,2))"

_STATE_TOTALS = f"""
SELECT state, {_TOTAL} AS total_expenses, max(total_voters) AS total_voters
FROM flat WHERE state <> 'BR' GROUP BY state
"""


def _profile(table: str, key: str, columns: str, sentinel: str | None, negative: str) -> str:
    """Counts as rows, in one UNION ALL branch per metric."""
    real = f"{key} IS NOT NULL" + (f" AND {key} <> {sentinel}" if sentinel else "")
    metrics = {"row_count": "count(*)"}
    metrics |= {f"null_{c}": f"count(*) FILTER ({c} IS NULL)" for c in columns.split()}
    if sentinel:
        metrics["sentinel_rows"] = f"count(*) FILTER ({key} = {sentinel})"
        metrics["negative_rows"] = f"count(*) FILTER ({negative})"
    metrics["distinct_ids"] = f"count(DISTINCT {key})"
    metrics["possible_duplicates"] = f"count(*) - count(DISTINCT {key})"
    branches = [
        f"SELECT '{name}' AS metric, {count} AS value FROM {table}"
        for name, count in metrics.items()
    ]
    branches.append(
        f"""SELECT 'repeated_ids' AS metric, count(*) AS value FROM (
              SELECT {key} FROM {table} WHERE {real} GROUP BY {key} HAVING count(*) > 1) AS r"""
    )
    return " UNION ALL ".join(branches)


_ENGLISH = {view: source for view, source in _VIEWS.items() if view != "eleitorado_bronze"}


def _columns(views: dict[str, str]) -> str:
    """Values and different values of every column of the views, under their Portuguese names."""
    branches = []
    for view, source in views.items():
        table = next(name for name, shown in VIEWS.items() if shown == view)
        for column in _COLUMNS_OF[table]:
            branches.append(
                f"SELECT '{view}' AS view_name, '{COLUMNS.get(column, column)}' AS column_name, "
                f"count({column}) AS filled, count(DISTINCT {column}) AS differing FROM {source}"
            )
    return " UNION ALL ".join(branches)


_ELECTORATE_COLUMNS = (
    "generated_on state town_code town zone gender marital_status age_band schooling race "
    "voting_duty voters voters_biometrics voters_disability voters_social_name"
).split()
_COLUMNS_OF = {
    "silver_expenses": "expense_id candidate_id state category detail amount expense_date".split(),
    "silver_candidates": "candidate_id candidate party office state".split(),
    "silver_electorate": _ELECTORATE_COLUMNS,
    "dim_candidate": "candidate_id candidate party office state".split(),
    "dim_state": "state_key state total_voters".split(),
    "dim_category": "category_key category detail".split(),
    "dim_date": "date_key expense_date year month day quarter".split(),
    "fact_expense": "expense_id candidate_id state_key category_key date_key amount".split(),
    "state_mart": "state_key state total_voters total_expenses".split(),
    "flat_mart": (
        "expense_id candidate_id candidate party office state_key state total_voters category_key "
        "category detail date_key expense_date year month day quarter amount"
    ).split(),
}
_MART = f"""(SELECT state_key, state, total_voters, {_TOTAL} AS total_expenses
             FROM fact JOIN states USING (state_key) WHERE state <> 'BR'
             GROUP BY state_key, state, total_voters) AS mart"""


def build() -> dict[str, str]:
    plain = _plain()
    # Other ways to the same rows.
    same = {
        "dq_orphan_count_shuffled": "dq_orphan_count",
        "dq_orphan_rows_shuffled": "dq_orphan_rows",
        "fact_shuffled": "fact_expense",
        "flat_shuffled": "flat_mart",
        "dim_category_ranges": "dim_category",
        "sql_q1": "q1_top_states",
        "sql_q1_1": "q1_1_top_candidates",
        "sql_q2": "q2_top_categories",
        "sql_q2_1": "q2_1_top_descriptions",
        "sql_q3": "q3_cost_per_voter",
        "sql_duplicate_ids": "dq_duplicate_ids",
        "sql_orphans": "dq_orphan_count",
    }
    views = _ENGLISH | {"gold_estado": _MART}
    published = {view: source for view, source in views.items() if view in _PUBLISHED}
    return plain | {name: plain[other] for name, other in same.items()} | {
        "sql_view_columns": _star(_columns(views)),
        "published_columns": _star(_columns(published)),
        "saved_columns": _star(_columns(published)),
        "dq_sentinel_unordered": _exp(
            """SELECT least(count(*), 10) AS rows_shown, least(count(*), 10) AS rows_that_fit
               FROM exp WHERE expense_id = -1"""
        ),
        "dq_drilldown_unordered": f"""
            SELECT least(count(*), 1) AS rows_shown, least(count(*), 1) AS rows_that_fit
            FROM ({_RAW_ELECTORATE}) AS found""",
        "preview_unordered": _star(
            """SELECT least(count(*), 20) AS rows_shown, least(count(*), 20) AS rows_that_fit
               FROM fact"""
        ),
    }


_PUBLISHED = [VIEWS[name] for name in _TABLES]


def _plain() -> dict[str, str]:
    return {
        "src_delimited": _exp(
            f"""SELECT state, category, count(*) AS row_count, count(expense_date) AS dated_rows,
                       {_TOTAL} AS total_amount FROM exp GROUP BY state, category"""
        ),
        "silver_candidates": _cand("SELECT * FROM cand"),
        "silver_expenses": _exp("SELECT * FROM exp"),
        "silver_electorate": _elec("SELECT * FROM elec"),
        "scalar_money": """
            WITH signed AS (
              SELECT l_returnflag, l_linestatus,
                     CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 12345 AS DECIMAL(18,2))
                     * (CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END)
                     + (CASE WHEN l_quantity % 5 <> 0 THEN 0 WHEN l_linestatus = 'F' THEN -1 ELSE 1 END)
                       * CAST(0.01 AS DECIMAL(18,2)) AS amount
              FROM lineitem)
            SELECT l_returnflag, l_linestatus, count(amount) AS readable,
                   CAST(sum(amount) AS DECIMAL(28,2)) AS total,
                   CAST(min(amount) AS DECIMAL(18,2)) AS smallest,
                   CAST(max(amount) AS DECIMAL(18,2)) AS largest
            FROM signed GROUP BY l_returnflag, l_linestatus""",
        "scalar_date_parse": """
            SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS row_count,
                   count(*) FILTER (l_linestatus <> 'F') AS strict_rows
            FROM lineitem GROUP BY CAST(l_shipdate AS DATE)""",
        "preview_limit": _sql(
            [EXP, CATEGORIES], "SELECT * FROM categories ORDER BY category_key LIMIT 10"
        ),
        "recon_counts": _sql(
            [EXP, CAND, ELEC],
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, '{layer}' AS layer, count(*) AS row_count "
                f"FROM {source}"
                for name, source in (
                    ("candidates", "cand"),
                    ("expenses", "exp"),
                    ("electorate", "elec"),
                )
                for layer in ("bronze", "silver")
            ),
        ),
        "total_amount": _exp(f"SELECT {_TOTAL} AS total_amount FROM exp"),
        "dq_uniqueness_expenses": _exp(
            """SELECT count(*) AS row_count, count(DISTINCT expense_id) AS distinct_ids,
                      count(*) - count(DISTINCT expense_id) AS possible_duplicates FROM exp"""
        ),
        "dq_uniqueness_candidates": _cand(
            """SELECT count(*) AS row_count, count(DISTINCT candidate_id) AS distinct_ids,
                      count(*) - count(DISTINCT candidate_id) AS possible_duplicates FROM cand"""
        ),
        "dq_completeness_expenses": _exp(
            "SELECT "
            + _nulls("expense_id candidate_id state category detail amount expense_date")
            + " FROM exp"
        ),
        "dq_completeness_candidates": _cand(
            "SELECT " + _nulls("candidate_id candidate party office state") + " FROM cand"
        ),
        "dq_completeness_electorate": _elec(
            "SELECT "
            + _nulls(
                "generated_on state town_code town zone gender marital_status age_band schooling "
                "race voting_duty voters voters_biometrics voters_disability voters_social_name"
            )
            + " FROM elec"
        ),
        "dq_sentinel_rows": _exp(
            """SELECT expense_id, expense_date, amount, detail FROM exp WHERE expense_id = -1
               ORDER BY expense_date NULLS FIRST, amount NULLS FIRST, detail NULLS FIRST LIMIT 10"""
        ),
        "dq_sentinel_count": _exp("SELECT count(*) AS row_count FROM exp WHERE expense_id = -1"),
        "dq_duplicate_ids": _exp(
            """SELECT expense_id, count(*) AS row_count FROM exp WHERE expense_id <> -1
               GROUP BY expense_id HAVING count(*) > 1
               ORDER BY row_count DESC, expense_id LIMIT 20"""
        ),
        "dq_duplicate_id_count": _exp(
            """SELECT count(*) AS repeated_ids FROM (
                 SELECT expense_id FROM exp WHERE expense_id <> -1
                 GROUP BY expense_id HAVING count(*) > 1) AS repeated"""
        ),
        "dq_point_lookup": _exp("SELECT * FROM exp WHERE expense_id = 1102"),
        "dq_duplicate_candidates": """
            SELECT s_suppkey AS candidate_id, CAST(2 AS BIGINT) AS row_count
            FROM supplier WHERE s_acctbal < 0""",
        "dq_orphan_count": _sql(
            [EXP, CAND],
            """SELECT count(*) AS orphan_rows FROM exp LEFT JOIN cand USING (candidate_id)
               WHERE cand.candidate_id IS NULL""",
        ),
        "dq_orphan_rows": _sql(
            [EXP, CAND],
            """SELECT exp.* FROM exp LEFT JOIN cand ON exp.candidate_id = cand.candidate_id
               WHERE cand.candidate_id IS NULL""",
        ),
        "dq_volume_electorate": _elec("SELECT count(*) AS row_count FROM elec"),
        "dq_grain_test": _elec(
            f"""SELECT {_GRAIN}, count(*) AS row_count FROM elec GROUP BY {_GRAIN}
                HAVING count(*) > 1 ORDER BY row_count DESC, {_GRAIN_ORDER} LIMIT 10"""
        ),
        "dq_bronze_drilldown": _RAW_ELECTORATE,
        "dq_min_measures": _elec(
            """SELECT min(voters) AS min_voters, min(voters_biometrics) AS min_voters_biometrics,
                      min(voters_disability) AS min_voters_disability,
                      min(voters_social_name) AS min_voters_social_name FROM elec"""
        ),
        "dq_negative_measures": _elec(
            """SELECT count(*) AS negative_rows FROM elec WHERE voters < 0
               OR voters_biometrics < 0 OR voters_disability < 0 OR voters_social_name < 0"""
        ),
        "dq_profile_expenses": _exp(
            _profile(
                "exp",
                "expense_id",
                "expense_id candidate_id state category detail amount expense_date",
                "-1",
                "amount < 0",
            )
        ),
        "dq_profile_candidates": _cand(
            _profile("cand", "candidate_id", "candidate_id candidate party office state", None, "")
        ),
        "dim_candidate": _star("SELECT * FROM people"),
        "dim_state": _star("SELECT * FROM states"),
        "dim_category": _star("SELECT * FROM categories"),
        "dim_date": _star("SELECT * FROM dates"),
        "fact_expense": _star("SELECT * FROM fact"),
        "fact_by_lookups": _star("SELECT * FROM fact"),
        "flat_from_fact": _star("SELECT * FROM flat"),
        "state_mart": _star(
            f"""SELECT state_key, state, total_voters, {_TOTAL} AS total_expenses
                FROM fact LEFT JOIN states USING (state_key) WHERE state <> 'BR'
                GROUP BY state_key, state, total_voters"""
        ),
        "flat_mart": _star("SELECT * FROM flat"),
        "sink_tables": _star(_counts(_TABLES, "table_name", "rows_read")),
        "catalog_tables": _star(_counts(_TABLES, "table_name", "rows_saved")),
        "registered_views": _star(_counts(_VIEWS, "view_name", "row_count")),
        "q1_top_states": _star(
            f"""SELECT state, {_TOTAL} AS total_expenses FROM flat WHERE state <> 'BR'
                GROUP BY state ORDER BY total_expenses DESC NULLS LAST, state LIMIT 5"""
        ),
        "q1_1_top_candidates": _star(
            f"""SELECT state, rank, candidate_id, candidate, party, office, total_expenses FROM (
                  SELECT state, candidate_id, candidate, party, office,
                         {_TOTAL} AS total_expenses,
                         row_number() OVER (PARTITION BY state
                           ORDER BY sum(amount) DESC NULLS LAST, candidate_id, candidate) AS rank
                  FROM flat WHERE state IN (
                    SELECT state FROM flat WHERE state <> 'BR' GROUP BY state
                    ORDER BY sum(amount) DESC NULLS LAST, state LIMIT 5)
                  GROUP BY state, candidate_id, candidate, party, office) AS ranked
                WHERE rank <= 3"""
        ),
        "q2_top_categories": _star(
            f"""SELECT category, {_TOTAL} AS total_expenses FROM flat GROUP BY category
                ORDER BY total_expenses DESC NULLS LAST, category NULLS FIRST LIMIT 3"""
        ),
        "q2_1_top_descriptions": _star(
            f"""SELECT category, rank, detail, total_expenses FROM (
                  SELECT category, detail, {_TOTAL} AS total_expenses,
                         row_number() OVER (PARTITION BY category
                           ORDER BY sum(amount) DESC NULLS LAST, detail NULLS FIRST) AS rank
                  FROM flat WHERE category IN (
                    SELECT category FROM flat GROUP BY category
                    ORDER BY sum(amount) DESC NULLS LAST, category NULLS FIRST LIMIT 3)
                  GROUP BY category, detail) AS ranked
                WHERE rank <= 3"""
        ),
        # Whole numbers until the end: (2 * cents + voters) // (2 * voters) is half up.
        "q3_cost_per_voter": _star(
            f"""SELECT state, total_expenses, total_voters,
                       CAST(CAST((CAST(total_expenses * 200 AS HUGEINT) + total_voters)
                         // (2 * nullif(total_voters, 0)) AS DECIMAL(29,0))
                         * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(29,2)) AS expenses_per_voter
                FROM ({_STATE_TOTALS}) AS totals"""
        ),
    }
