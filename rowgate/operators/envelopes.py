"""Checked decoding of event envelopes.

Input rows have ``headers`` (map<string,string>) and ``body`` (text). Decoding
never fails a job: every row gets the typed fields plus ``reason``, null for an
accepted event and otherwise the first check it broke. Malformed events are
permanent, so they go to a rejected output instead of being retried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.functions import variants as V
from rowgate.functions.boundary import with_computed
from rowgate.functions.ids import import_id

# CloudEvents header names.
EVENT_ID_HEADER = "ce-id"
EVENT_TYPE_HEADER = "ce-type"


@dataclass(frozen=True)
class MessageSpec:
    """What a message consumer accepts.

    ``strings`` and ``counts`` map payload members to output columns, in the
    order in which they are checked.
    """

    transport_type: str
    event_type: str
    strings: tuple[tuple[str, str], ...]
    counts: tuple[tuple[str, str], ...]
    checks_type_attribute: bool = False
    max_body_bytes: int = 1024 * 1024


@dataclass(frozen=True)
class StorageSpec:
    """What the file-finalised consumer accepts."""

    transport_type: str
    max_body_bytes: int = 1024 * 1024


class _Reasons:
    """Ordered checks; the first that is broken names the reason."""

    def __init__(self):
        self._broken: list[Column] = []

    def unless(self, ok: Column, reason: str) -> None:
        # A check that cannot be evaluated (a missing value) is a broken check.
        self._broken.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)))

    def first(self) -> Column:
        return F.coalesce(*self._broken)


def _with_body(envelopes: DataFrame, max_body_bytes: int) -> DataFrame:
    small = F.octet_length("body") <= max_body_bytes
    return with_computed(
        envelopes,
        {
            "cloud_event_id": V.first_header(F.col("headers"), EVENT_ID_HEADER),
            "_type": V.first_header(F.col("headers"), EVENT_TYPE_HEADER),
            "_body": F.when(small, V.parse_json(F.col("body"))),
        },
    )


def _transport_ok(transport_type: str) -> Column:
    return (F.col("_type") == transport_type) & F.col("cloud_event_id").isNotNull()


def decode_storage_events(envelopes: DataFrame, spec: StorageSpec) -> DataFrame:
    """File-finalised events as import identities, with ``reason``."""
    keep = envelopes.columns
    read = _with_body(envelopes, spec.max_body_bytes)
    body = F.col("_body")
    typed = with_computed(
        read,
        {
            "bucket_name": V.required_string(V.member(body, "bucket")),
            "object_name": V.required_string(V.member(body, "name")),
            "object_generation": V.required_string(V.member(body, "generation")),
            "size_bytes": V.safe_size(V.member(body, "size")),
        },
    )
    # The reasons, in the order of the checks.
    reasons = _Reasons()
    reasons.unless(_transport_ok(spec.transport_type), "Unsupported or malformed CloudEvent")
    reasons.unless(body.isNotNull(), "Invalid Storage event data")
    reasons.unless(V.is_object(body), "Storage event data must be a JSON object")
    for column, member in (
        ("bucket_name", "bucket"),
        ("object_name", "name"),
        ("object_generation", "generation"),
    ):
        reasons.unless(
            F.col(column).isNotNull(), f"Missing required Storage event field: {member}"
        )
    reasons.unless(
        F.col("size_bytes").isNotNull(), "Missing or invalid Storage event field: size"
    )
    decoded = with_computed(typed, {"reason": reasons.first()})
    return decoded.select(
        *keep,
        "cloud_event_id",
        import_id(
            F.col("bucket_name"), F.col("object_name"), F.col("object_generation")
        ).alias("import_id"),
        "bucket_name",
        "object_name",
        "object_generation",
        "size_bytes",
        "reason",
    )


def decode_messages(envelopes: DataFrame, spec: MessageSpec) -> DataFrame:
    """Bus messages as typed events, with ``reason``.

    The steps are separate so that each level of JSON is parsed once: envelope,
    message, payload.
    """
    keep = envelopes.columns
    read = _with_body(envelopes, spec.max_body_bytes)
    opened = with_computed(read, {"_message": V.member(F.col("_body"), "message")})
    message = F.col("_message")
    parts = with_computed(
        opened,
        {
            "message_id": V.required_string(V.member(message, "messageId")),
            "_data": V.required_string(V.member(message, "data")),
            "_attributes": V.member(message, "attributes"),
            "_publish_time": V.member(message, "publishTime"),
        },
    )
    parsed = with_computed(
        parts,
        {
            "_payload": V.parse_json(V.base64_text(F.col("_data"))),
            "_members": V.string_map(F.col("_attributes")),
            "publish_time": V.required_string(F.col("_publish_time")),
        },
    )
    payload = F.col("_payload")
    no_attributes = F.create_map().cast("map<string,string>")
    typed = with_computed(
        parsed,
        {
            "attributes": F.when(F.col("_attributes").isNull(), no_attributes).when(
                V.all_strings(F.col("_members")), V.string_members(F.col("_members"))
            ),
            "event_type": V.string_value(V.member(payload, "eventType")),
            **{c: V.required_string(V.member(payload, m)) for m, c in spec.strings},
            **{c: V.non_negative_integer(V.member(payload, m)) for m, c in spec.counts},
        },
    )

    def attribute_agrees(name: str, column: str) -> Column:
        given = F.try_element_at("attributes", F.lit(name))
        return given.isNull() | (given == F.col(column))

    # The reasons, in the order of the checks.
    reasons = _Reasons()
    reasons.unless(_transport_ok(spec.transport_type), "Unsupported or malformed CloudEvent")
    reasons.unless(F.col("_body").isNotNull(), "Invalid Pub/Sub event body")
    reasons.unless(V.is_object(F.col("_body")), "Pub/Sub envelope must be an object")
    reasons.unless(V.is_object(message), "Pub/Sub message must be an object")
    reasons.unless(F.col("message_id").isNotNull(), "messageId is required")
    reasons.unless(F.col("_data").isNotNull(), "data is required")
    reasons.unless(
        F.col("_attributes").isNull() | F.col("_members").isNotNull(),
        "attributes must be an object",
    )
    reasons.unless(F.col("attributes").isNotNull(), "attributes values must be strings")
    reasons.unless(payload.isNotNull(), f"Invalid {spec.event_type} payload")
    reasons.unless(V.is_object(payload), f"{spec.event_type} event must be an object")
    reasons.unless(
        F.col("event_type") == spec.event_type, "Unsupported domain event type"
    )
    for member, column in spec.strings:
        reasons.unless(F.col(column).isNotNull(), f"{member} is required")
    for member, column in spec.counts:
        reasons.unless(
            F.col(column).isNotNull(), f"{member} must be a non-negative integer"
        )
    reasons.unless(
        attribute_agrees("eventId", "event_id"),
        "Pub/Sub eventId attribute does not match the event payload",
    )
    if spec.checks_type_attribute:
        reasons.unless(
            attribute_agrees("eventType", "event_type"),
            "Pub/Sub eventType attribute does not match the event payload",
        )
    reasons.unless(
        F.col("_publish_time").isNull() | F.col("publish_time").isNotNull(),
        "publishTime is required",
    )
    decoded = with_computed(typed, {"reason": reasons.first()})
    return decoded.select(
        *keep,
        "cloud_event_id",
        "message_id",
        "publish_time",
        "attributes",
        "event_type",
        *(column for _, column in spec.strings),
        *(column for _, column in spec.counts),
        "reason",
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Events without a broken check, without their envelopes."""
    return decoded.where("reason is null").drop("reason", "headers", "body")


def rejected(decoded: DataFrame) -> DataFrame:
    """The permanently malformed events, with envelope, id and reason."""
    return decoded.where("reason is not null").select(
        "cloud_event_id", "reason", "headers", "body"
    )


def audit_records(events: DataFrame, event: str, as_of: Column) -> DataFrame:
    """P10: what the log says about an accepted event."""
    return events.select(
        F.lit(event).alias("event"),
        "cloud_event_id",
        "message_id",
        "event_id",
        "import_id",
        "row_count",
        "valid_row_count",
        "invalid_row_count",
        as_of.alias("logged_at"),
    )
