"""Configuration for monthly household energy readings.

The operators are generic; this module holds the one domain they are set up for.
"""

from __future__ import annotations

from rowgate.operators.envelopes import MessageSpec, StorageSpec
from rowgate.operators.outbox import COMPLETED_PAYLOAD, STAGED_PAYLOAD
from rowgate.operators.quarantine import Classifier
from rowgate.operators.rules import (
    AtLeast,
    DateField,
    MatchesDifference,
    MatchesSum,
    MoneyField,
    NotAfter,
    NumberField,
    Required,
    RuleSet,
)

# Names and types of the business columns, in table order.
_NUMERIC = "decimal(38,9)"
BUSINESS_COLUMNS: tuple[tuple[str, str, bool], ...] = (
    # name, type, required
    ("meter_id", "string", True),
    ("period_start", "date", True),
    ("period_end", "date", True),
    ("reading_start_kwh", _NUMERIC, True),
    ("reading_end_kwh", _NUMERIC, True),
    ("consumption_kwh", _NUMERIC, True),
    ("estimated_annual_kwh", _NUMERIC, False),
    ("grid_area", "string", False),
    ("subscription_cost_sek", _NUMERIC, False),
    ("transmission_cost_sek", _NUMERIC, False),
    ("energy_tax_sek", _NUMERIC, False),
    ("grid_vat_sek", _NUMERIC, False),
    ("grid_total_sek", _NUMERIC, True),
    ("electricity_cost_sek", _NUMERIC, False),
    ("electricity_annual_fee_sek", _NUMERIC, False),
    ("electricity_vat_sek", _NUMERIC, False),
    ("electricity_total_sek", _NUMERIC, True),
    ("total_cost_sek", _NUMERIC, True),
)
CSV_FIELDS = tuple(name for name, _, _ in BUSINESS_COLUMNS)
REQUIRED_FIELDS = tuple(name for name, _, required in BUSINESS_COLUMNS if required)
IDENTITY_FIELDS = ("meter_id", "period_start", "period_end")


def table_ddl(columns: tuple[tuple[str, str, bool], ...]) -> str:
    """The columns as a schema string for ``spark.read.schema``."""
    return ", ".join(
        f"{name} {kind}{' NOT NULL' if required else ''}"
        for name, kind, required in columns
    )


_PROVENANCE = (
    ("source_import_id", "string", True),
    ("source_row_number", "bigint", True),
)
STAGING_COLUMNS = (
    ("record_id", "string", True),
    *BUSINESS_COLUMNS,
    *_PROVENANCE,
    ("ingested_at", "timestamp", True),
)
CURATED_COLUMNS = (
    ("record_id", "string", True),
    *BUSINESS_COLUMNS,
    *_PROVENANCE,
    ("created_at", "timestamp", True),
    ("updated_at", "timestamp", True),
)
ERROR_COLUMNS = (
    ("error_id", "string", True),
    ("import_id", "string", True),
    ("source_row_number", "bigint", True),
    ("field_name", "string", False),
    ("error_code", "string", True),
    ("error_message", "string", True),
    ("raw_row", "string", True),
    ("created_at", "timestamp", True),
)

# What an update writes; the key and the creation time stay.
UPDATED_COLUMNS = (*CSV_FIELDS, *(name for name, _, _ in _PROVENANCE))

RULES = RuleSet(
    (
        Required("meter_id"),
        DateField("period_start"),
        DateField("period_end"),
        NotAfter("period_start", "period_end"),
        NumberField("reading_start_kwh"),
        NumberField("reading_end_kwh"),
        NumberField("consumption_kwh"),
        NumberField("estimated_annual_kwh", required=False),
        AtLeast("reading_end_kwh", "reading_start_kwh"),
        MatchesDifference(
            "consumption_kwh",
            end="reading_end_kwh",
            start="reading_start_kwh",
            tolerance=0.001,
            wording="must match the meter reading difference",
        ),
        MoneyField("grid_total_sek"),
        MoneyField("electricity_total_sek"),
        MoneyField("total_cost_sek"),
        MoneyField("subscription_cost_sek", required=False),
        MoneyField("transmission_cost_sek", required=False),
        MoneyField("energy_tax_sek", required=False),
        MoneyField("grid_vat_sek", required=False),
        MoneyField("electricity_cost_sek", required=False),
        MoneyField("electricity_annual_fee_sek", required=False),
        MoneyField("electricity_vat_sek", required=False),
        MatchesSum(
            "grid_total_sek",
            (
                "subscription_cost_sek",
                "transmission_cost_sek",
                "energy_tax_sek",
                "grid_vat_sek",
            ),
        ),
        MatchesSum(
            "electricity_total_sek",
            (
                "electricity_cost_sek",
                "electricity_annual_fee_sek",
                "electricity_vat_sek",
            ),
        ),
        MatchesSum("total_cost_sek", ("grid_total_sek", "electricity_total_sek")),
    )
)

# Wording to error code, first fit wins.
ERROR_CLASSES = Classifier(
    (
        ("endswith", " is required", "REQUIRED_FIELD"),
        ("contains", "date", "INVALID_DATE"),
        ("startswith", "period_", "INVALID_DATE"),
        ("contains", "cost components", "TOTAL_MISMATCH"),
        ("contains", "meter reading difference", "CONSUMPTION_MISMATCH"),
        ("contains", "SEK amount", "INVALID_MONEY"),
        ("contains", "number", "INVALID_NUMBER"),
        ("contains", "finite", "INVALID_NUMBER"),
    )
)

# Limits and names the services agree on.
CSV_SUFFIX = ".csv"
MAX_CSV_BYTES = 10 * 1024 * 1024
MAX_EVENT_BYTES = 1024 * 1024
SAMPLE_SIZE = 10
LEASE_MINUTES = 10
STAGING_RETENTION_DAYS = 7
STAGING_JOB_PREFIX = "energy-staging"
ERRORS_JOB_PREFIX = "energy-validation-errors"
MERGE_JOB_PREFIX = "energy_merge_"
STAGED_EVENT = "EnergyImportStaged"
COMPLETED_EVENT = "EnergyImportCompleted"

STORAGE_EVENTS = StorageSpec(
    # Fixed value: the CloudEvents type of a finished upload.
    transport_type="google.cloud.storage.object.v1.finalized",
    max_body_bytes=MAX_EVENT_BYTES,
)
# Fixed value: the CloudEvents type of a delivered bus message.
MESSAGE_TRANSPORT = "google.cloud.pubsub.topic.v1.messagePublished"


def _message_spec(event_type: str, payload, checks_type_attribute: bool) -> MessageSpec:
    counts = ("row_count", "valid_row_count", "invalid_row_count")
    return MessageSpec(
        transport_type=MESSAGE_TRANSPORT,
        event_type=event_type,
        strings=tuple(
            pair for pair in payload if pair[1] not in (*counts, "event_type")
        ),
        counts=tuple(pair for pair in payload if pair[1] in counts),
        checks_type_attribute=checks_type_attribute,
        max_body_bytes=MAX_EVENT_BYTES,
    )


STAGED_EVENTS = _message_spec(STAGED_EVENT, STAGED_PAYLOAD, False)
COMPLETED_EVENTS = _message_spec(COMPLETED_EVENT, COMPLETED_PAYLOAD, True)
