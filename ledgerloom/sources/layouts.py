"""What the three public extracts hold and how each field is read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

from ledgerloom import functions as fn


@dataclass(frozen=True)
class Field:
    """One column: its header in the extract, its name in the typed table, its parser."""

    header: str
    name: str
    parse: Callable[[Column], Column]


@dataclass(frozen=True)
class Layout:
    name: str
    fields: tuple[Field, ...]

    @property
    def headers(self) -> list[str]:
        return [field.header for field in self.fields]

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]


# Header names of the public extracts.
CANDIDATES = Layout(
    "candidates",
    (
        Field("SQ_CANDIDATO", "candidate_id", fn.long_integer),
        Field("NM_CANDIDATO", "candidate", fn.text),
        Field("SG_PARTIDO", "party", fn.code),
        Field("DS_CARGO", "office", fn.text),
        Field("SG_UF", "state", fn.code),
    ),
)

EXPENSES = Layout(
    "expenses",
    (
        Field("SQ_DESPESA", "expense_id", fn.long_integer),
        Field("SQ_CANDIDATO", "candidate_id", fn.long_integer),
        Field("SG_UF", "state", fn.code),
        Field("DS_ORIGEM_DESPESA", "category", fn.text),
        Field("DS_DESPESA", "detail", fn.text),
        Field("VR_DESPESA_CONTRATADA", "amount", fn.amount_ptbr),
        Field("DT_DESPESA", "expense_date", fn.dmy_date),
    ),
)

ELECTORATE = Layout(
    "electorate",
    (
        Field("DT_GERACAO", "generated_on", fn.dmy_date_strict),
        Field("SG_UF", "state", fn.code),
        Field("CD_MUNICIPIO", "town_code", fn.integer),
        Field("NM_MUNICIPIO", "town", fn.text),
        Field("NR_ZONA", "zone", fn.integer),
        Field("DS_GENERO", "gender", fn.text),
        Field("DS_ESTADO_CIVIL", "marital_status", fn.text),
        Field("DS_FAIXA_ETARIA", "age_band", fn.text),
        Field("DS_GRAU_INSTRUCAO", "schooling", fn.text),
        Field("DS_COR_RACA", "race", fn.text),
        Field("TP_OBRIGATORIEDADE_VOTO", "voting_duty", fn.text),
        Field("QT_ELEITORES", "voters", fn.long_integer),
        Field("QT_ELEITORES_BIOMETRIA", "voters_biometrics", fn.long_integer),
        Field("QT_ELEITORES_DEFICIENCIA", "voters_disability", fn.long_integer),
        Field("QT_ELEITORES_NOME_SOCIAL", "voters_social_name", fn.long_integer),
    ),
)

# Fixed values with a meaning of their own in the extracts.
MISSING_EXPENSE_ID = -1
NATIONAL_STATE = "BR"

# The ten columns that describe a voter group, and its four counts.
ELECTORATE_GRAIN = [
    "generated_on",
    "state",
    "town_code",
    "zone",
    "gender",
    "marital_status",
    "age_band",
    "schooling",
    "race",
    "voting_duty",
]
ELECTORATE_COUNTS = ["voters", "voters_biometrics", "voters_disability", "voters_social_name"]
