"""Portuguese names of tables and columns, for SQL written against them."""

from __future__ import annotations

# View and table names.
VIEWS = {
    "silver_expenses": "despesas_silver",
    "silver_candidates": "candidatos_silver",
    "silver_electorate": "eleitorado_silver",
    "raw_electorate": "eleitorado_bronze",
    "dim_candidate": "dim_candidato",
    "dim_state": "dim_estado",
    "dim_category": "dim_categoria_despesa",
    "dim_date": "dim_data",
    "fact_expense": "fact_despesa",
    "state_mart": "gold_estado",
    "flat_mart": "gold_despesa_analitica",
}

# Column names.
COLUMNS = {
    "candidate_id": "ID_CANDIDATO",
    "candidate": "CANDIDATO",
    "party": "PARTIDO",
    "office": "CARGO",
    "state": "ESTADO",
    "expense_id": "ID_DESPESA",
    "category": "CATEGORIA_DESPESA",
    "detail": "DESPESA_DETALHADA",
    "amount": "VALOR_DESPESA",
    "expense_date": "DATA_DESPESA",
    "generated_on": "DATA_GERACAO",
    "town_code": "CODIGO_MUNICIPIO",
    "town": "MUNICIPIO",
    "zone": "ZONA",
    "gender": "GENERO",
    "marital_status": "ESTADO_CIVIL",
    "age_band": "FAIXA_ETARIA",
    "schooling": "GRAU_INSTRUCAO",
    "race": "COR_RACA",
    "voting_duty": "OBRIGATORIEDADE_VOTO",
    "voters": "ELEITORES",
    "voters_biometrics": "ELEITORES_BIOMETRIA",
    "voters_disability": "ELEITORES_DEFICIENCIA",
    "voters_social_name": "ELEITORES_NOME_SOCIAL",
    "state_key": "ID_ESTADO",
    "category_key": "ID_CATEGORIA_DESPESA",
    "date_key": "ID_DATA",
    "total_voters": "TOTAL_ELEITORES",
    "total_expenses": "TOTAL_DESPESAS",
    "year": "ANO",
    "month": "MES",
    "day": "DIA",
    "quarter": "TRIMESTRE",
}
