from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import functions as fn


def parsed(spark, parse, values):
    """Values pass through rows, not literals, so nothing is folded away."""
    rows = spark.createDataFrame(list(enumerate(values)), "n int, raw string")
    found = rows.select("n", parse(F.col("raw")).alias("v")).orderBy("n").collect()
    return [row["v"] for row in found]


def test_amounts(spark):
    cases = {
        "1.234,56": "1234.56",
        "1.234.567,89": "1234567.89",
        "10,005": "10.01",
        "-10,005": "-10.01",
        "99.50": "9950.00",
        "-1,00": "-1.00",
        " 7,5 ": "7.50",
        "0,00": "0.00",
        "": None,
        "#NULO": None,
        "1,2,3": None,
        "99999999999999999,00": None,
    }
    found = parsed(spark, fn.amount_ptbr, [*cases, None])
    expected = [None if v is None else Decimal(v) for v in cases.values()]
    assert found == [*expected, None]


def test_dates(spark):
    values = ["01/09/2026", " 31/12/2026 ", "1/9/2026", "31/02/2026", "29/02/2024", "", None]
    assert parsed(spark, fn.dmy_date, values) == [
        date(2026, 9, 1),
        date(2026, 12, 31),
        None,
        None,
        date(2024, 2, 29),
        None,
        None,
    ]
    assert parsed(spark, fn.dmy_date_strict, values)[1] is None


def test_text_and_codes(spark):
    assert parsed(spark, fn.code, [" sp ", "São", None]) == ["SP", "SÃO", None]
    assert parsed(spark, fn.text, [" a b ", "a\t ", ""]) == ["a b", "a\t", ""]


def test_numbers(spark):
    assert parsed(spark, fn.long_integer, ["-1", "x", " 12 ", "9999999999", None]) == [
        -1,
        None,
        12,
        9999999999,
        None,
    ]
    assert parsed(spark, fn.integer, ["007", "9999999999"]) == [7, None]


def test_bad_text_ends_no_job_with_or_without_ansi(spark):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert parsed(spark, fn.long_integer, ["x"]) == [None]
            assert parsed(spark, fn.amount_ptbr, ["x"]) == [None]
            assert parsed(spark, fn.dmy_date, ["x"]) == [None]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_date_key_and_parts(spark):
    day = F.lit("2026-09-01").cast("date")
    row = spark.range(1).select(fn.date_key(day).alias("key"), *fn.date_parts(day).values())
    assert tuple(row.first()) == (20260901, 2026, 9, 1, 3)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.decimals(-(10**12), 10**12, places=2), min_size=200, max_size=400))
def test_amount_text_and_back(spark, amounts):
    texts = [f"{a:,.2f}".translate(str.maketrans(",.", ".,")) for a in amounts]
    expected = [a.quantize(Decimal("0.01"), ROUND_HALF_UP) for a in amounts]
    assert parsed(spark, fn.amount_ptbr, texts) == expected


_DATE_LIKE = st.text(alphabet="0123456789/ -+x\t\n", max_size=12) | st.builds(
    "{}{:02d}/{:02d}/{:04d}{}".format,
    st.sampled_from(["", " ", "0"]),
    st.integers(0, 32),
    st.integers(0, 13),
    st.integers(0, 10000),
    st.sampled_from(["", " ", "\n", "x"]),
)


@settings(max_examples=3, deadline=None)
@given(st.lists(_DATE_LIKE, min_size=300, max_size=600))
def test_dates_equal_the_pattern_parser(spark, values):
    ours = parsed(spark, lambda c: fn.dmy_date_strict(c).cast("string"), values)
    theirs = parsed(spark, lambda c: F.try_to_date(c, "dd/MM/yyyy").cast("string"), values)
    assert ours == theirs


def test_unreadable_pattern_raises_nothing(spark):
    assert parsed(spark, fn.dmy_date, ["٠١/٠٩/٢٠٢٦"]) == [None]


@pytest.mark.parametrize("amount, text", [("1234567.8", "1.234.567,80"), ("-0.5", "-0,50")])
def test_amount_text(spark, amount, text):
    column = F.lit(amount).cast("decimal(18,2)")
    assert spark.range(1).select(fn.amount_text_ptbr(column)).first()[0] == text
