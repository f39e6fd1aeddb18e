import hashlib
import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowgate import energy
from rowgate.functions import ids
from rowgate.operators import quarantine, staging, summary
from rowgate.operators.rules import valid_rows, validate

def as_of():
    return F.lit("2026-07-01 12:00:00").cast("timestamp")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_error_row_is_stable_and_classified(spark):
    invalid = spark.createDataFrame(
        [("import-1", 3, ["period_start must be a valid date"], {"meter_id": "home-01"}, "raw,text")],
        "import_id string, source_row_number bigint, errors array<string>, parsed map<string,string>, raw string",
    )
    rows = quarantine.error_rows(
        invalid, energy.ERROR_CLASSES, F.col("parsed"), as_of(), raw_text=F.col("raw")
    )
    assert rows.columns == [name for name, _, _ in energy.ERROR_COLUMNS]
    row = rows.first()
    assert (row.field_name, row.error_code) == ("period_start", "INVALID_DATE")
    assert row.error_id == sha("import-1|3|period_start|INVALID_DATE|period_start must be a valid date")
    assert json.loads(row.raw_row) == {"parsed": {"meter_id": "home-01"}, "rawCsv": "raw,text"}


@pytest.mark.parametrize(
    ("message", "field", "code"),
    [
        ("INVALID_COLUMN_COUNT", None, "INVALID_COLUMN_COUNT"),
        ("period_end is required", "period_end", "REQUIRED_FIELD"),
        ("period_end must use YYYY-MM-DD", "period_end", "INVALID_DATE"),
        ("period_start must be on or before period_end", "period_start", "INVALID_DATE"),
        ("grid_total_sek does not match its cost components", "grid_total_sek", "TOTAL_MISMATCH"),
        ("consumption_kwh must match the meter reading difference", "consumption_kwh", "CONSUMPTION_MISMATCH"),
        ("a_sek must be a non-negative SEK amount with max 2 decimals", "a_sek", "INVALID_MONEY"),
        ("x must be a finite number", "x", "INVALID_NUMBER"),
        ("reading_end_kwh must be at least reading_start_kwh", "reading_end_kwh", "INVALID_VALUE"),
    ],
)
def test_classes(spark, message, field, code):
    df = spark.createDataFrame([(message,)], "m string")
    got = df.select(
        quarantine.field_name(F.col("m")), energy.ERROR_CLASSES.code(F.col("m"))
    ).first()
    assert tuple(got) == (field, code)


def staged(frame):
    return staging.staging_rows(
        frame.withColumns({"import_id": F.lit("import-1"), "source_row_number": F.lit(2)}),
        energy.BUSINESS_COLUMNS,
        energy.IDENTITY_FIELDS,
        as_of(),
    )


def test_staging_row_mapping(rows, valid_row):
    row = staged(rows([{**valid_row, "meter_id": " home-01 ", "estimated_annual_kwh": " "}])).first()
    assert row.record_id == sha("home-01\n2026-06-01\n2026-06-30")
    assert row.meter_id == "home-01"
    assert row.period_start == date(2026, 6, 1)
    assert row.estimated_annual_kwh is None
    assert row.total_cost_sek == Decimal("383.74")
    assert (row.source_import_id, row.source_row_number) == ("import-1", 2)
    assert row.ingested_at == datetime(2026, 7, 1, 12)


def test_staging_columns_match_the_table(rows, valid_row):
    frame = staged(rows([valid_row]))
    assert frame.dtypes == [(name, kind) for name, kind, _ in energy.STAGING_COLUMNS]


def test_overflow_is_seen_not_nulled(rows, valid_row):
    dicts = [valid_row, {**valid_row, "estimated_annual_kwh": "9" * 30}]
    frame = rows(dicts)
    assert [r.valid for r in validate(frame, energy.RULES).orderBy("n").collect()] == [True, True]
    fits = frame.orderBy("n").select(staging.fits_types(energy.BUSINESS_COLUMNS)).collect()
    assert [r[0] for r in fits] == [True, False]


def test_ids(spark):
    one = spark.range(1).select(
        ids.import_id(F.lit("b"), F.lit("f.csv"), F.lit("1")),
        ids.record_id(F.lit(" m "), F.lit("2026-06-01"), F.lit("2026-06-30\t")),
        ids.record_id(F.lit("m"), F.lit("2026-07-01"), F.lit("2026-07-31")),
        ids.record_id(F.lit("m"), F.lit(" "), F.lit("2026-07-31")),
        ids.event_id(energy.STAGED_EVENT, F.lit("import-1")),
        ids.event_id(energy.COMPLETED_EVENT, F.lit("import-1")),
        ids.merge_job_id(F.lit("staged-event-1"), energy.MERGE_JOB_PREFIX),
        ids.load_job_id(energy.STAGING_JOB_PREFIX, F.lit("import-1"), F.lit(2)),
    ).first()
    assert list(one) == [
        sha("b\nf.csv\n1"),
        sha("m\n2026-06-01\n2026-06-30"),
        sha("m\n2026-07-01\n2026-07-31"),
        None,
        sha("EnergyImportStaged|import-1"),
        sha("EnergyImportCompleted|import-1"),
        "energy_merge_" + sha("staged-event-1"),
        "energy-staging-import-1-2",
    ]


def test_summary_counts_samples_and_empty_files(spark, rows, valid_row):
    many = [valid_row] * 11 + [{**valid_row, "meter_id": ""}] * 12
    frame = rows(many).withColumn("import_id", F.lit("a")).withColumn(
        "source_row_number", (F.col("n") + 2).cast("bigint")
    )
    files = spark.createDataFrame([("a",), ("empty",)], "import_id string")
    found = {
        r.import_id: r
        for r in summary.summarize(
            files,
            validate(frame, energy.RULES),
            energy.SAMPLE_SIZE,
            ids.record_id(*(F.col(n) for n in energy.IDENTITY_FIELDS)),
        ).collect()
    }
    a, empty = found["a"], found["empty"]
    assert (a.row_count, a.valid_row_count, a.invalid_row_count) == (23, 11, 12)
    assert [r.row_number for r in a.invalid_row_sample] == list(range(13, 23))
    assert len(a.record_id_sample) == 10
    assert a.invalid_rows_truncated and a.record_ids_truncated
    assert (empty.row_count, empty.invalid_row_sample, empty.record_id_sample) == (0, [], [])
    assert not empty.invalid_rows_truncated and not empty.record_ids_truncated
    assert len(valid_rows(validate(frame, energy.RULES)).collect()) == 11
