"""Checked parsing of dates, plain numbers and money (F7-F10), and F21.

Rules are compiled to expression text, so these functions take and give text:
one parsed expression costs the driver a fraction of the calls that building it
column by column takes. ``text`` names a column of normalised text; every value
is null where the text is not of the right form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"\A\d{4}-\d{2}-\d{2}\z"
PLAIN_NUMBER = r"\A\d+(\.\d+)?\z"
MONEY = r"\A\d+(\.\d{1,2})?\z"

# Years 0 to 99 never survive the calendar round trip the rules are defined by.
FIRST_VALID_YEAR = 100


def has_form(text: str, form: str) -> str:
    return f"rlike({text}, r'{form}')"


def iso_date(text: str) -> str:
    """A real calendar day written YYYY-MM-DD."""
    day = f"try_cast({text} as date)"
    return (
        f"case when {has_form(text, ISO_DATE)} and year({day}) >= {FIRST_VALID_YEAR} "
        f"then {day} end"
    )


def plain_number(text: str) -> str:
    """Non-negative decimal notation as a double; an infinite one is no number."""
    number = f"try_cast({text} as double)"
    return (
        f"case when {has_form(text, PLAIN_NUMBER)} "
        f"then nullif({number}, double('infinity')) end"
    )


def minor_units(text: str) -> str:
    """Money with at most two decimals as a count of hundredths.

    The count is the double ``whole * 100 + cents``. Up to 15 characters the
    rounded product is the same integer and needs a single conversion.
    """
    whole = f"substring_index({text}, '.', 1)"
    cents = f"rpad(substr({text}, length({whole}) + 2), 2, '0')"
    return (
        f"case when not {has_form(text, MONEY)} then null "
        f"when length({text}) <= 15 then rint(try_cast({text} as double) * 100) "
        f"else try_cast({whole} as double) * 100 + try_cast({cents} as double) end"
    )


def differs_by_more_than(left: str, right: str, tolerance: float) -> str:
    """``abs(left - right) > tolerance``; not a number never counts as different."""
    gap = f"abs({left} - ({right}))"
    return f"(not isnan({gap}) and {gap} > {tolerance!r}D)"


def integer_or_zero(value: Column) -> Column:
    """an integer, or 0 for anything else."""
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
