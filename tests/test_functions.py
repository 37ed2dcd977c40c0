from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starpipe.functions import columns as C


def evaluate(spark, column, value, kind):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v")).alias("out")).first().out


@pytest.mark.parametrize(
    "text, expected",
    [("  a b\t", "a b"), ("\n x ", "x"), ("", ""), (None, None), ("\x1c y\x85", "y")],
)
def test_strip_like_text_strip(spark, text, expected):
    assert evaluate(spark, C.strip, text, "string") == expected
    if text is not None:
        assert expected == text.strip()


def test_strip_covers_every_white_space_character(spark):
    white = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert evaluate(spark, C.strip, white + "x" + white, "string") == "x"


def test_text_default(spark):
    assert evaluate(spark, lambda c: C.text_or(c, "1.0"), None, "string") == "1.0"
    assert evaluate(spark, lambda c: C.text_or(c, "1.0"), " 2 ", "string") == "2"


@pytest.mark.parametrize("text, expected", [("12", 12), (" v1 ", 0), (None, 0), ("", 0)])
def test_number_or_zero_never_raises(spark, text, expected):
    assert evaluate(spark, lambda c: C.number_or_zero(c, "int"), text, "string") == expected


def test_safe_date(spark):
    assert evaluate(spark, C.safe_date, "2024-02-30", "string") is None
    assert evaluate(spark, C.safe_date, "2024-02-29", "string") == date(2024, 2, 29)


@pytest.mark.parametrize(
    "kind, expected",
    [("Penalizacion", True), ("xPENALIZACIONESx", True), ("Penalización", False), (None, False)],
)
def test_penalty_word(spark, kind, expected):
    assert evaluate(spark, C.is_penalty, kind, "string") is expected


@pytest.mark.parametrize(
    "state, collation, expected",
    [
        ("Cerrado", None, True),
        ("CERRADO", None, False),
        ("CERRADO", "UNICODE_CI_AI", True),
        ("Activo", "UNICODE_CI_AI", False),
    ],
)
def test_closed_states(spark, state, collation, expected):
    assert evaluate(spark, lambda c: C.is_closed(c, collation), state, "string") is expected


@pytest.mark.parametrize(
    "day, key",
    [("2019-01-01", 1), ("2018-12-31", 1), ("2019-01-02", 2), ("2025-12-31", 2557), (None, None)],
)
def test_fixed_base_key(spark, day, key):
    value = date.fromisoformat(day) if day else None
    assert evaluate(spark, C.fixed_base_key, value, "date") == key


def test_calendar_parts(spark):
    monday, sunday = date(2024, 1, 1), date(2018, 12, 30)
    assert evaluate(spark, C.weekday_key, monday, "date") == 1
    assert evaluate(spark, C.weekday_key, sunday, "date") == 7
    assert evaluate(spark, C.year_key, monday, "date") == 6
    assert evaluate(spark, C.year_key, sunday, "date") == 0


@pytest.mark.parametrize(
    "part, whole, expected",
    [
        (1, 3, "33.33"), (2, 3, "66.67"), (1, 8, "12.50"), (0, 5, "0.00"), (5, 0, "0.00"),
        (None, 5, "0.00"), (1, 800, "0.13"),
    ],
)
def test_percentages_round_half_up(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "a bigint, b bigint")
    out = df.select(C.ratio_or_zero(F.col("a"), F.col("b"), "decimal(5,2)", 100).alias("r"))
    assert out.first().r == Decimal(expected)


@pytest.mark.parametrize(
    "capex, opex, expected",
    [("3", "2", 1.5), ("10", "0", float("inf")), ("0", "0", 0.0), ("0", "5", 0.0)],
)
def test_capex_opex(spark, capex, opex, expected):
    df = spark.createDataFrame(
        [(Decimal(capex), Decimal(opex))], "a decimal(25,2), b decimal(25,2)"
    )
    assert df.select(C.capex_opex_ratio(F.col("a"), F.col("b")).alias("r")).first().r == expected
