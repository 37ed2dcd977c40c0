"""Scalar column functions. Everything here stays inside generated code; no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# States that close a project or contract, calendar limits, default texts.
CLOSED_STATES = ("Cerrado", "Cancelado")
CANCELLED = "CANCELADO"
CALENDAR_START = "2019-01-01"
CALENDAR_END = "2025-12-31"
YEAR_ZERO = 2018
DEFAULT_VERSION = "1.0"
UNSPECIFIED = "No especificado"
PENALTY_WORD = "penalizacion"
PENALTY_TYPE = "Penalizaciones"
CAPEX = "CAPEX"
OPEX = "OPEX"

# Unicode white space as a text strip understands it; Spark's trim() alone drops only U+0020.
_SPACES = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def text_or(text: Column, default: str) -> Column:
    """Text without outer white space, ``default`` where it is null."""
    return strip(F.coalesce(text, F.lit(default)))


def number_or_zero(value: Column, kind: str) -> Column:
    """Cast that turns unreadable or missing values into 0 instead of failing under ANSI."""
    return F.coalesce(value.try_cast(kind), F.lit(0).cast(kind))


def safe_date(value: Column) -> Column:
    return value.try_cast("date")


def is_closed(state: Column, collation: str | None = None) -> Column:
    """State is one of CLOSED_STATES, byte by byte or under a named collation."""
    if collation:
        state = F.collate(state, collation)
    return state.isin(*CLOSED_STATES)


def equals_upper(text: Column, value: str) -> Column:
    return F.upper(text) == value


def is_penalty(kind: Column) -> Column:
    """Case-insensitive substring test; null is no penalty and accents are not folded."""
    return F.coalesce(F.lower(kind).contains(PENALTY_WORD), F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)


def days_between(end: Column, start: Column) -> Column:
    return F.date_diff(end, start)


def fixed_base_key(day: Column) -> Column:
    """Ordinal of a day counted from CALENDAR_START, never below 1; null stays null."""
    ordinal = F.date_diff(day, F.lit(CALENDAR_START).cast("date")) + 1
    return F.when(day.isNotNull(), F.greatest(ordinal, F.lit(1)))


def weekday_key(day: Column) -> Column:
    """1 = Monday to 7 = Sunday."""
    return F.weekday(day) + 1


def year_key(day: Column) -> Column:
    return F.year(day) - YEAR_ZERO


def ratio_or_zero(part: Column, whole: Column, kind: str, scale: int = 1) -> Column:
    """``scale * part / whole`` as an exact decimal, 0 where the whole is 0 or null."""
    # As wide as the widest total; the quotient keeps ten places.
    exact = (part * scale).cast("decimal(28,2)") / whole.cast("decimal(28,2)")
    return F.coalesce(F.when(whole != 0, exact), F.lit(0)).cast(kind)


def capex_opex_ratio(capex: Column, opex: Column) -> Column:
    """Quotient as double: infinite when there is only capital cost, 0 when there is neither."""
    return (
        F.when(opex > 0, capex.cast("double") / opex.cast("double"))
        .when(capex > 0, F.lit(float("inf")))
        .otherwise(F.lit(0.0))
    )


def max_of(values: Sequence[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def min_of(values: Sequence[Column]) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]
