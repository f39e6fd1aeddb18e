"""Declarative row validation compiled to expressions.

A :class:`RuleSet` is an ordered list of rules over text columns. ``validate``
turns it into three narrow projections (normalised text, typed values, messages)
with no shuffle and no Python per row. All broken rules of a row are reported,
in rule order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.functions import values
from rowgate.functions.boundary import with_computed
from rowgate.functions.text import quoted_name, quoted_text, with_normalised

# Separates messages while they travel as one string: string concatenation keeps
# the rules in generated code, where array filtering would not.
_SEPARATOR = "\n"
_TEXT = "_text_{}"
_VALUE = "_value_{}"


def _text(field: str) -> str:
    return quoted_name(_TEXT.format(field))


def _value(field: str) -> str:
    return quoted_name(_VALUE.format(field))


def _message(condition: str, wording: str) -> str:
    return f"case when {condition} then {quoted_text(wording)} end"


@dataclass(frozen=True)
class Rule:
    """Base of all rules: which fields are read, parsed and complained about."""

    def fields(self) -> Sequence[str]:
        return ()

    def typed(self) -> dict[str, str]:
        """Typed values this rule makes available to the rules after it."""
        return {}

    def message(self) -> str:
        """Expression for the rule's message; null where the row is fine."""
        raise NotImplementedError


@dataclass(frozen=True)
class Required(Rule):
    """The field is present and not blank."""

    field: str

    def fields(self):
        return (self.field,)

    def message(self):
        return _message(f"{_text(self.field)} is null", f"{self.field} is required")


@dataclass(frozen=True)
class _ParsedField(Rule):
    """A field that must parse; the first thing wrong with it is reported."""

    field: str
    required: bool = True

    form: ClassVar[str]
    malformed: ClassVar[str]
    impossible: ClassVar[str | None] = None

    def fields(self):
        return (self.field,)

    def _parse(self) -> str:
        raise NotImplementedError

    def typed(self):
        return {self.field: self._parse()}

    def message(self):
        text, value = _text(self.field), _value(self.field)
        missing = quoted_text(f"{self.field} is required") if self.required else "null"
        malformed = quoted_text(f"{self.field} {self.malformed}")
        if self.impossible is None:
            wrong = f"when {value} is null then {malformed}"
        else:
            wrong = (
                f"when {value} is null and not {values.has_form(text, self.form)} "
                f"then {malformed} when {value} is null "
                f"then {quoted_text(f'{self.field} {self.impossible}')}"
            )
        return f"case when {text} is null then {missing} {wrong} end"


@dataclass(frozen=True)
class DateField(_ParsedField):
    """A real calendar day written YYYY-MM-DD."""

    form = values.ISO_DATE
    malformed = "must use YYYY-MM-DD"
    impossible = "must be a valid date"

    def _parse(self):
        return values.iso_date(_text(self.field))


@dataclass(frozen=True)
class NumberField(_ParsedField):
    """A finite, non-negative number in plain decimal notation."""

    form = values.PLAIN_NUMBER
    malformed = "must be a non-negative number"
    impossible = "must be a finite number"

    def _parse(self):
        return values.plain_number(_text(self.field))


@dataclass(frozen=True)
class MoneyField(_ParsedField):
    """A non-negative SEK amount with at most two decimals, held in minor units."""

    form = values.MONEY
    malformed = "must be a non-negative SEK amount with max 2 decimals"

    def _parse(self):
        return values.minor_units(_text(self.field))


@dataclass(frozen=True)
class NotAfter(Rule):
    """``first`` is on or before ``second``; silent unless both were parsed."""

    first: str
    second: str

    def message(self):
        return _message(
            f"{_value(self.first)} > {_value(self.second)}",
            f"{self.first} must be on or before {self.second}",
        )


@dataclass(frozen=True)
class AtLeast(Rule):
    """``field`` is not below ``floor``; silent unless both were parsed."""

    field: str
    floor: str

    def message(self):
        return _message(
            f"{_value(self.field)} < {_value(self.floor)}",
            f"{self.field} must be at least {self.floor}",
        )


@dataclass(frozen=True)
class MatchesDifference(Rule):
    """``field`` equals ``end - start`` within a tolerance, in doubles."""

    field: str
    end: str
    start: str
    tolerance: float
    wording: str

    def message(self):
        gap = f"{_value(self.end)} - {_value(self.start)}"
        return _message(
            values.differs_by_more_than(gap, _value(self.field), self.tolerance),
            f"{self.field} {self.wording}",
        )


@dataclass(frozen=True)
class MatchesSum(Rule):
    """``total`` equals the sum of ``parts``; silent unless all were parsed."""

    total: str
    parts: tuple[str, ...]
    tolerance: float = 1.0

    def message(self):
        summed = " + ".join(_value(part) for part in self.parts)
        return _message(
            values.differs_by_more_than(_value(self.total), summed, self.tolerance),
            f"{self.total} does not match its cost components",
        )


@dataclass(frozen=True)
class RuleSet:
    """Rules in the order in which their messages are reported."""

    rules: tuple[Rule, ...]

    @property
    def fields(self) -> list[str]:
        """Every text field a rule reads, in first-use order."""
        return list(dict.fromkeys(f for rule in self.rules for f in rule.fields()))

    def typed(self) -> dict[str, Column]:
        found = {k: v for rule in self.rules for k, v in rule.typed().items()}
        return {_VALUE.format(field): F.expr(value) for field, value in found.items()}

    def messages(self) -> Column:
        """All messages of a row, one per line; empty for a valid row."""
        parts = ", ".join(rule.message() for rule in self.rules)
        return F.expr(f"concat_ws({quoted_text(_SEPARATOR)}, {parts})")


def validate(
    rows: DataFrame,
    ruleset: RuleSet,
    skip: Column | None = None,
    skip_message: str | None = None,
) -> DataFrame:
    """``rows`` plus ``errors`` (array<string>, in rule order) and ``valid``.

    Rows where ``skip`` holds get ``skip_message`` as their only error (C6).
    """
    keep = rows.columns
    normalised = with_normalised(rows, ruleset.fields, _TEXT)
    typed = normalised.withColumns(ruleset.typed())
    joined = ruleset.messages()
    if skip is not None:
        joined = F.when(skip, F.lit(skip_message)).otherwise(joined)
    checked = with_computed(typed, {"_messages": joined})
    messages = F.col("_messages")
    no_errors = F.array().cast("array<string>")
    return checked.select(
        *keep,
        F.when(messages == "", no_errors)
        .otherwise(F.split(messages, _SEPARATOR))
        .alias("errors"),
        (messages == "").alias("valid"),
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    """The rows without a broken rule."""
    return validated.where("valid").drop("errors", "valid")


def invalid_rows(validated: DataFrame) -> DataFrame:
    """The rows with at least one broken rule; keeps ``errors``."""
    return validated.where("not valid").drop("valid")
