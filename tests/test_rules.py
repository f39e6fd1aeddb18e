import math
import random
import re
from datetime import date

import pytest

from rowgate import energy
from rowgate.functions.text import ECMA_WHITESPACE
from rowgate.operators.rules import invalid_rows, valid_rows, validate


def errors_of(rows, dicts):
    found = validate(rows(dicts), energy.RULES).orderBy("n").collect()
    return [r.errors for r in found]


def test_valid_row(rows, valid_row):
    assert errors_of(rows, [valid_row]) == [[]]


def test_all_broken_rules_in_order(rows, valid_row):
    broken = {
        **valid_row,
        "meter_id": "",
        "period_end": "2026-02-30",
        "consumption_kwh": "75",
        "total_cost_sek": "-1",
    }
    assert errors_of(rows, [broken]) == [
        [
            "meter_id is required",
            "period_end must be a valid date",
            "consumption_kwh must match the meter reading difference",
            "total_cost_sek must be a non-negative SEK amount with max 2 decimals",
        ]
    ]


def test_sum_tolerates_one_minor_unit(rows, valid_row):
    found = errors_of(
        rows,
        [{**valid_row, "total_cost_sek": "383.75"}, {**valid_row, "total_cost_sek": "383.76"}],
    )
    assert found == [[], ["total_cost_sek does not match its cost components"]]


def test_sum_is_skipped_when_a_part_is_missing(rows, valid_row):
    assert errors_of(rows, [{**valid_row, "grid_vat_sek": " ", "grid_total_sek": "267.60"}]) == [[]]


@pytest.mark.parametrize(
    ("field", "text", "message"),
    [
        ("period_start", "0099-01-01", "period_start must be a valid date"),
        ("period_start", "2026-6-1", "period_start must use YYYY-MM-DD"),
        ("period_start", "2026-06-01\n2026", "period_start must use YYYY-MM-DD"),
        ("period_start", "2025-02-29", "period_start must be a valid date"),
        ("period_start", "2026-07-01", "period_start must be on or before period_end"),
        ("estimated_annual_kwh", "9" * 400, "estimated_annual_kwh must be a finite number"),
        ("estimated_annual_kwh", "1e3", "estimated_annual_kwh must be a non-negative number"),
        ("estimated_annual_kwh", "1.", "estimated_annual_kwh must be a non-negative number"),
        ("consumption_kwh", "73.999", None),
        ("consumption_kwh", "73.998", "consumption_kwh must match the meter reading difference"),
        ("energy_tax_sek", "26.645", "energy_tax_sek must be a non-negative SEK amount with max 2 decimals"),
        ("meter_id", " ﻿　", "meter_id is required"),
    ],
)
def test_traps(rows, valid_row, field, text, message):
    got = errors_of(rows, [{**valid_row, field: text}])[0]
    if message is None:
        # 3649 - 3575 - 73.999 is a little above 0.001 in doubles.
        assert got == ["consumption_kwh must match the meter reading difference"]
    else:
        assert got[0] == message


def test_every_white_space_character_is_trimmed(rows, valid_row):
    padded = {
        **valid_row,
        **{k: ECMA_WHITESPACE + v + ECMA_WHITESPACE for k, v in valid_row.items()},
    }
    assert errors_of(rows, [padded]) == [[]]


def test_long_amounts_do_not_break(rows, valid_row):
    long = {**valid_row, "total_cost_sek": "9" * 400, "grid_total_sek": "8" * 400}
    assert errors_of(rows, [long])[0] == ["grid_total_sek does not match its cost components"]


def test_split(rows, valid_row):
    checked = validate(rows([valid_row, {**valid_row, "meter_id": None}]), energy.RULES)
    assert [r.n for r in valid_rows(checked).collect()] == [0]
    assert [(r.n, r.errors) for r in invalid_rows(checked).collect()] == [
        (1, ["meter_id is required"])
    ]


# A second opinion in plain Python, for random rows.


def _text(row, field):
    return (row.get(field) or "").strip(ECMA_WHITESPACE) or None


def _expected(row):
    out, values = [], {}
    if _text(row, "meter_id") is None:
        out.append("meter_id is required")
    for f in ("period_start", "period_end"):
        t = _text(row, f)
        if t is None:
            out.append(f"{f} is required")
        elif not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", t):
            out.append(f"{f} must use YYYY-MM-DD")
        else:
            try:
                values[f] = date.fromisoformat(t)
                if values[f].year < 100:
                    del values[f]
                    raise ValueError
            except ValueError:
                out.append(f"{f} must be a valid date")
    if len(values) == 2 and values["period_start"] > values["period_end"]:
        out.append("period_start must be on or before period_end")
    for f in ("reading_start_kwh", "reading_end_kwh", "consumption_kwh", "estimated_annual_kwh"):
        t = _text(row, f)
        if t is None:
            if f != "estimated_annual_kwh":
                out.append(f"{f} is required")
        elif not re.fullmatch(r"[0-9]+(\.[0-9]+)?", t):
            out.append(f"{f} must be a non-negative number")
        elif math.isinf(float(t)):
            out.append(f"{f} must be a finite number")
        else:
            values[f] = float(t)
    start, end = values.get("reading_start_kwh"), values.get("reading_end_kwh")
    if start is not None and end is not None:
        if end < start:
            out.append("reading_end_kwh must be at least reading_start_kwh")
        used = values.get("consumption_kwh")
        if used is not None and abs(end - start - used) > 0.001:
            out.append("consumption_kwh must match the meter reading difference")
    grid = ["subscription_cost_sek", "transmission_cost_sek", "energy_tax_sek", "grid_vat_sek"]
    power = ["electricity_cost_sek", "electricity_annual_fee_sek", "electricity_vat_sek"]
    totals = ["grid_total_sek", "electricity_total_sek", "total_cost_sek"]
    for f in totals + grid + power:
        t = _text(row, f)
        if t is None:
            if f in totals:
                out.append(f"{f} is required")
        elif not re.fullmatch(r"[0-9]+(\.[0-9]{1,2})?", t):
            out.append(f"{f} must be a non-negative SEK amount with max 2 decimals")
        else:
            whole, _, cents = t.partition(".")
            values[f] = float(whole) * 100 + float(cents.ljust(2, "0"))
    for total, parts in zip(totals, (grid, power, totals[:2])):
        if total in values and all(p in values for p in parts):
            gap = abs(values[total] - sum(values[p] for p in parts))
            if gap > 1:
                out.append(f"{total} does not match its cost components")
    return out


def test_random_rows_agree_with_plain_python(rows, valid_row):
    pick = random.Random(7)
    odd = [
        None, "", "  ", "abc", "-1", "0", "1.5", "12.345", "1e5", "0.1", "2026-13-01", "2026-06-15",
        "0050-01-01", "9" * 20, "9" * 320, "\t7 ", "383.75", "267.61", "٧", "074",
        "90071992547409.93", "123456789012345.6",
    ]
    dicts = []
    for _ in range(600):
        row = dict(valid_row)
        for field in pick.sample(list(row), pick.randint(0, 5)):
            row[field] = pick.choice(odd)
        dicts.append(row)
    assert errors_of(rows, dicts) == [_expected(d) for d in dicts]
