import base64
import json

import pytest
from pyspark.sql import functions as F

from rowgate import energy
from rowgate.operators import envelopes, outbox

STAGED = {
    "eventId": "event-1",
    "eventType": "EnergyImportStaged",
    "occurredAt": "2026-07-01T12:00:00.000Z",
    "importId": "import-1",
    "bucketName": "bucket",
    "objectName": "energy.csv",
    "objectGeneration": "1",
    "rowCount": 7,
    "validRowCount": 6,
    "invalidRowCount": 1,
}
COMPLETED = {
    **STAGED,
    "eventType": "EnergyImportCompleted",
    "stagedEventId": "staged-event-1",
    "mergeJobId": "merge-1",
}


def headers(**extra):
    return {"ce-id": "cloud-1", "ce-type": energy.MESSAGE_TRANSPORT, **extra}


def body(payload, attributes=None, **message):
    data = payload if isinstance(payload, str) else json.dumps(payload)
    content = {"data": base64.b64encode(data.encode()).decode(), "messageId": "m-1", **message}
    if attributes is not None:
        content["attributes"] = attributes
    return json.dumps({"message": content})


def decode(spark, deliveries, spec):
    frame = spark.createDataFrame(deliveries, "headers map<string,string>, body string")
    return envelopes.decode_messages(frame.coalesce(1), spec).collect()


def test_staged_event_is_decoded(spark):
    attributes = {"eventId": "event-1", "eventType": "EnergyImportStaged"}
    (row,) = decode(spark, [(headers(), body(STAGED, attributes, publishTime="t"))], energy.STAGED_EVENTS)
    assert row.reason is None
    assert (row.cloud_event_id, row.message_id, row.publish_time) == ("cloud-1", "m-1", "t")
    assert row.attributes == attributes
    assert (row.event_id, row.import_id, row.valid_row_count) == ("event-1", "import-1", 6)


def test_completed_event_is_decoded(spark):
    (row,) = decode(spark, [(headers(), body(COMPLETED))], energy.COMPLETED_EVENTS)
    assert row.reason is None
    assert (row.staged_event_id, row.merge_job_id, row.row_count) == ("staged-event-1", "merge-1", 7)
    assert row.attributes == {}


def test_reasons(spark):
    cases = [
        ((headers(), body(STAGED, {"eventId": "other"})), "Pub/Sub eventId attribute does not match the event payload"),
        ((headers(), body({**STAGED, "eventType": "OtherEvent"})), "Unsupported domain event type"),
        (({"ce-type": energy.MESSAGE_TRANSPORT}, body(STAGED)), "Unsupported or malformed CloudEvent"),
        ((headers(**{"ce-type": "x"}), body(STAGED)), "Unsupported or malformed CloudEvent"),
        ((headers(), "{"), "Invalid Pub/Sub event body"),
        ((headers(), None), "Invalid Pub/Sub event body"),
        ((headers(), json.dumps({"pad": "x" * 1048576})), "Invalid Pub/Sub event body"),
        ((headers(), "[1]"), "Pub/Sub envelope must be an object"),
        ((headers(), "null"), "Pub/Sub envelope must be an object"),
        ((headers(), '{"message":[]}'), "Pub/Sub message must be an object"),
        ((headers(), '{"message":{"data":"e30="}}'), "messageId is required"),
        ((headers(), '{"message":{"messageId":"m","data":7}}'), "data is required"),
        ((headers(), body(STAGED, attributes=[1])), "attributes must be an object"),
        ((headers(), body(STAGED, {"a": None})), "attributes values must be strings"),
        ((headers(), body("nope")), "Invalid EnergyImportStaged payload"),
        ((headers(), body("[1]")), "EnergyImportStaged event must be an object"),
        ((headers(), body({**STAGED, "occurredAt": ""})), "occurredAt is required"),
        ((headers(), body({**STAGED, "rowCount": 1.5})), "rowCount must be a non-negative integer"),
        ((headers(), body({**STAGED, "rowCount": -1})), "rowCount must be a non-negative integer"),
        ((headers(), body({**STAGED, "rowCount": True})), "rowCount must be a non-negative integer"),
        ((headers(), body({**STAGED, "rowCount": "7"})), "rowCount must be a non-negative integer"),
        ((headers(), body({**STAGED, "rowCount": 7.0})), None),
        ((headers(), body(STAGED, {"eventType": "OtherEvent"})), None),
        ((headers(), body(STAGED, publishTime=None)), "publishTime is required"),
    ]
    found = decode(spark, [c for c, _ in cases], energy.STAGED_EVENTS)
    assert [r.reason for r in found] == [reason for _, reason in cases]


def test_only_the_completed_consumer_checks_the_type_attribute(spark):
    delivery = (headers(), body(COMPLETED, {"eventType": "OtherEvent"}))
    (row,) = decode(spark, [delivery], energy.COMPLETED_EVENTS)
    assert row.reason == "Pub/Sub eventType attribute does not match the event payload"


def test_rejected_rows_keep_their_envelope(spark):
    frame = spark.createDataFrame([(headers(), "{")], "headers map<string,string>, body string")
    decoded = envelopes.decode_messages(frame, energy.STAGED_EVENTS)
    (row,) = envelopes.rejected(decoded).collect()
    assert (row.cloud_event_id, row.body) == ("cloud-1", "{")
    assert envelopes.accepted(decoded).count() == 0


def storage(spark, bodies):
    head = {"ce-id": "e-1", "ce-type": energy.STORAGE_EVENTS.transport_type}
    frame = spark.createDataFrame([(head, b) for b in bodies], "headers map<string,string>, body string")
    return envelopes.decode_storage_events(frame.coalesce(1), energy.STORAGE_EVENTS).collect()


def test_storage_event_identity(spark):
    (row,) = storage(spark, ['{"bucket":"b","name":"f.csv","generation":"12","size":"345"}'])
    assert (row.bucket_name, row.object_name, row.object_generation, row.size_bytes) == ("b", "f.csv", "12", 345)
    assert row.reason is None and len(row.import_id) == 64


def test_storage_event_missing_fields_keep_the_event_id(spark):
    (row,) = storage(spark, ['{"name":"f.csv"}'])
    assert (row.cloud_event_id, row.reason) == ("e-1", "Missing required Storage event field: bucket")


@pytest.mark.parametrize(
    ("size", "expected"),
    [
        ("345", 345), ('"345"', 345), ('""', 0), ('" 12 "', 12), ('"1e3"', 1000), ('"0x10"', 16),
        ('"0b11"', 3), ("9007199254740991", 9007199254740991), ("9007199254740992", None),
        ("1.5", None), ("-1", None), ('"ten"', None), ("true", None), ("null", None), ('"Infinity"', None),
    ],
)
def test_size_coercion(spark, size, expected):
    (row,) = storage(spark, [f'{{"bucket":"b","name":"f.csv","generation":"12","size":{size}}}'])
    assert row.size_bytes == expected


def test_published_events_come_back_through_the_envelope(spark):
    run = spark.createDataFrame(
        [("import-1", "bucket", "energy.csv", "1", 7, 6, 1)],
        "import_id string, bucket_name string, object_name string, object_generation string, "
        "row_count bigint, valid_row_count bigint, invalid_row_count bigint",
    )
    events = outbox.build_events(
        run, energy.STAGED_EVENT, outbox.STAGED_PAYLOAD, F.lit("2026-07-01 12:00:00").cast("timestamp")
    )
    later = outbox.build_events(
        run, energy.STAGED_EVENT, outbox.STAGED_PAYLOAD, F.lit("2027-07-01 12:00:00").cast("timestamp")
    )
    assert events.first().event_id == later.first().event_id
    messages = outbox.published_messages(events, outbox.STAGED_PAYLOAD)
    payload = json.loads(messages.first().data)
    assert payload == {**STAGED, "eventId": events.first().event_id}
    assert list(payload) == list(STAGED)
    delivered = outbox.push_envelopes(messages, energy.MESSAGE_TRANSPORT)
    (row,) = envelopes.decode_messages(delivered, energy.STAGED_EVENTS).collect()
    assert row.reason is None and row.import_id == "import-1"
    record = outbox.kafka_records(messages).first()
    assert {h.key: bytes(h.value).decode() for h in record.headers} == row.attributes


def test_reported_counts(spark):
    from rowgate.functions import values, variants

    texts = ["6", " 6 ", "0", "", "-1", "1.5", "x", "9007199254740993", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in frame.select(variants.safe_count(F.col("t"))).collect()]
    assert got == [6, 6, 0, 0, None, None, None, None, None]
    zero = frame.select(values.integer_or_zero(F.col("t"))).first()
    assert zero[0] == 6
