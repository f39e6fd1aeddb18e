"""Staged events to the curated table, ledger and completed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from rowgate import energy
from rowgate.functions import ids
from rowgate.operators import dedup, envelopes, ledger, outbox, reconcile, upsert
from rowgate.sources.run_log import compact_when_due
from rowgate.sources.tables import (
    append_log,
    read_table,
    recover_partitions,
    replace_partitions,
    touched_partitions,
)
from rowgate.sources.warehouse import (
    COMPLETED_TOPIC,
    STAGED_TOPIC,
    Warehouse,
    runs_of,
    with_month,
)
from rowgate.streaming.batches import (
    Batch,
    batch_of,
    bounded,
    defer,
    deferred_events,
    pinned,
    store_audit,
    store_rejected,
)

RECEIVED = "energy_import_staged_received"


def stream_messages(spark: SparkSession, warehouse: Warehouse, topic: str) -> DataFrame:
    """Published messages as delivered envelopes."""
    layout = warehouse.messages(topic)
    reader = spark.readStream.schema(layout.full_ddl()).option("recursiveFileLookup", "true")
    found = reader.parquet(layout.path)
    return outbox.push_envelopes(found, energy.MESSAGE_TRANSPORT)


# Names of loads put into a scan's filter; a batch of more scans all partitions.
LISTED_LOADS = 1000


def only_loads(staging: DataFrame, loads: DataFrame) -> DataFrame:
    """The staging partitions of the given loads, by a filter that prunes the scan.

    A load is one attempt at one ingest batch, so a merge batch names few of them.
    """
    names = [r.load for r in loads.select("load").distinct().limit(LISTED_LOADS + 1).collect()]
    return staging.where(F.col("load").isin(names)) if len(names) <= LISTED_LOADS else staging


def _append(warehouse: Warehouse, outcomes: DataFrame) -> None:
    append_log(ledger.applied_runs(outcomes), warehouse.runs)


def publish_completed(
    spark: SparkSession, warehouse: Warehouse, imports: DataFrame, batch: Batch
) -> None:
    """S10, T14, T15."""
    runs = runs_of(spark, warehouse, imports)
    waiting = pinned(ledger.unpublished_completed(runs))
    if waiting.isEmpty():
        return
    events = outbox.build_events(
        waiting.withColumn("staged_event_id", F.col("processed_staged_event_id")),
        energy.COMPLETED_EVENT,
        outbox.COMPLETED_PAYLOAD,
        batch.as_of,
    )
    append_log(
        outbox.published_messages(events, outbox.COMPLETED_PAYLOAD),
        warehouse.messages(COMPLETED_TOPIC),
    )
    _append(
        warehouse,
        ledger.transition(
            events.select("import_id", "event_id"),
            waiting,
            ledger.completed_event_published(batch.as_of),
        ),
    )


def store_merges(
    warehouse: Warehouse, merged: DataFrame, counts: dict[str, int], batch: Batch
) -> None:
    """A3: one row per merged import, with the affected rows of its load."""
    rows = merged.select(
        "import_id",
        "staged_event_id",
        "merge_job_id",
        F.col("staging_row_count").alias("row_count"),
        F.lit(batch.load).alias("load"),
        *(F.lit(counts[n]).cast("bigint").alias(f"load_{n}") for n in ("inserted", "updated", "affected")),
        batch.as_of.alias("merged_at"),
    )
    append_log(rows, warehouse.merges)


def merge_batch(
    spark: SparkSession, delivered: DataFrame, warehouse: Warehouse, batch: Batch
) -> None:
    """Merge the imports that the delivered staged events name.

    An event whose import is already completed has no second effect. Events that
    do not fit the ledger or the staging table are deferred: they are kept whole,
    offered again with later batches, and given up after ``DEFERRAL_DAYS``.
    """
    held: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    as_of = batch.as_of
    recover_partitions(spark, warehouse.curated, warehouse.pending)
    try:
        waiting = deferred_events(
            spark, warehouse, STAGED_TOPIC, F.col("status") == ledger.COMPLETED, batch
        )
        offered = pinned(delivered.select("headers", "body").unionByName(waiting))
        decoded = hold(envelopes.decode_messages(offered, energy.STAGED_EVENTS))
        store_rejected(decoded, warehouse, batch)
        store_audit(decoded, warehouse, RECEIVED, batch)
        events = hold(
            dedup.latest_per_key(
                envelopes.accepted(decoded), ["event_id"], ["message_id"]
            ).select(
                "import_id",
                F.col("event_id").alias("staged_event_id"),
                "occurred_at",
                "valid_row_count",
                ids.merge_job_id(F.col("event_id"), energy.MERGE_JOB_PREFIX).alias(
                    "merge_job_id"
                ),
            )
        )
        known = pinned(runs_of(spark, warehouse, events))
        outcomes = hold(ledger.transition(events, known, ledger.completed(as_of)))
        ready = (
            outcomes.where(F.col("outcome") == ledger.APPLIED)
            .select("import_id", "staging_load")
            .join(events, "import_id")
        )
        loads = hold(
            ready.select(
                F.col("import_id").alias("source_import_id"),
                F.col("staging_load").alias("load"),
                F.struct("occurred_at", "staged_event_id").alias("arrival"),
            )
        )
        rows = only_loads(read_table(spark, warehouse.staging), loads).join(
            bounded(loads), ["source_import_id", "load"]
        )
        reconciled = hold(reconcile.reconcile(ready.drop("staging_load"), rows))
        matching = reconciled.where("matches")
        merging = rows.join(
            bounded(matching.select(F.col("import_id").alias("source_import_id"))),
            "source_import_id",
            "left_semi",
        )
        if not matching.isEmpty():
            # Not cached: that would be one more copy of all rows of the batch. The months
            # are those of all rows, also of such that a later one replaces.
            source = with_month(upsert.merge_source(merging, arrival=["arrival"]))
            target = touched_partitions(
                read_table(spark, warehouse.curated), with_month(merging), "period_month"
            )
            merged = upsert.upsert(
                target, source, "record_id", energy.UPDATED_COLUMNS, as_of
            )
            counted = Observation()
            replace_partitions(
                with_month(upsert.observed(merged, counted).drop("action")),
                warehouse.curated,
                f"{warehouse.pending}/{batch.load}",
            )
            store_merges(warehouse, matching, counted.get, batch)
        done = outcomes.join(
            matching.select("import_id"), "import_id", "left_semi"
        ).select(*outcomes.columns)
        _append(warehouse, done)
        publish_completed(spark, warehouse, events.select("import_id"), batch)

        unfit = ledger.violations(outcomes).select(
            "import_id", F.col("violation").alias("reason")
        )
        short = reconciled.where("not matches").select(
            "import_id", F.lit("the staging rows are not as many as declared").alias("reason")
        )
        late = hold(unfit.unionByName(short).dropDuplicates(["import_id"]))
        kept = decoded.where("reason is null").drop("reason").join(bounded(late), "import_id")
        defer(spark, warehouse, STAGED_TOPIC, kept, batch)
        compact_when_due(spark, warehouse.runs)
    finally:
        for df in reversed(held):
            df.unpersist()


def start_merge(
    spark: SparkSession, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None
):
    """Merge staged imports as their events arrive."""

    def handle(delivered: DataFrame, batch_id: int) -> None:
        session = delivered.sparkSession
        merge_batch(session, delivered, warehouse, batch_of(session, checkpoint, batch_id))

    return (
        stream_messages(spark, warehouse, STAGED_TOPIC)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
