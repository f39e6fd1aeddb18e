"""Completed events to the audit table, and repeated events dropped early."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowgate import energy
from rowgate.operators import envelopes
from rowgate.sources.warehouse import COMPLETED_TOPIC, Warehouse
from rowgate.streaming.batches import Batch, batch_of, store_audit, store_rejected
from rowgate.streaming.merge import stream_messages

RECEIVED = "energy_import_completed_received"


def audit_batch(delivered: DataFrame, warehouse: Warehouse, batch: Batch) -> None:
    decoded = envelopes.decode_messages(delivered, energy.COMPLETED_EVENTS).persist()
    try:
        store_rejected(decoded, warehouse, batch)
        store_audit(decoded, warehouse, RECEIVED, batch)
    finally:
        decoded.unpersist()


def start_audit(
    spark: SparkSession, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None
):
    """Record every completed event."""

    def handle(delivered: DataFrame, batch_id: int) -> None:
        session = delivered.sparkSession
        audit_batch(delivered, warehouse, batch_of(session, checkpoint, batch_id))

    return (
        stream_messages(spark, warehouse, COMPLETED_TOPIC)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drop_repeated(events: DataFrame, event_time: str, horizon: str, key: str = "event_id") -> DataFrame:
    """Repeats of an event within ``horizon``; older ones are left to the ledger.

    State is bounded by the watermark: ids older than the horizon are forgotten.
    """
    return events.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
