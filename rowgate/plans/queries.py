"""Every operator as a query over the given tables.

Each query takes (spark, folder of the tables) and returns a frame of plain
types, so that another engine's answer can be compared with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowgate import energy
from rowgate.functions import ids
from rowgate.functions.text import with_normalised
from rowgate.functions.variants import safe_count
from rowgate.operators import csv_records as csv
from rowgate.operators import dedup, envelopes, gate, ledger, outbox
from rowgate.operators import quarantine, reconcile, retention, rules, staging, summary, upsert
from rowgate.plans import fixtures
from rowgate.session import scratch_path, shuffles_dropped, tune
from rowgate.sources import tables
from rowgate.sources import warehouse as wh
from rowgate.streaming import audit, ingest, merge

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

JOB_PREFIXES = (energy.STAGING_JOB_PREFIX, energy.ERRORS_JOB_PREFIX)
OWNER = "owner-1"


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def instant(text: str):
    """A fixed point in time without a zone, comparable across engines."""
    return F.lit(text).cast("timestamp_ntz")


def moment(text: str):
    return F.lit(text).cast("timestamp")


def as_plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned timestamps as local ones, for comparison."""
    def plain(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*(plain(name, kind) for name, kind in df.dtypes))


def parsed_columns():
    pairs = [part for name in energy.CSV_FIELDS for part in (F.lit(name), F.col(name))]
    return F.create_map(*pairs)


# Imports of these files count as arriving now, all others as merged before.
ARRIVING = "object_name like '%-3.csv'"


def validated(spark: SparkSession, sf_dir: str, files: str = "true") -> DataFrame:
    readings = fixtures.readings(spark, sf_dir).where(files)
    return rules.validate(readings, energy.RULES)


def staged(spark: SparkSession, sf_dir: str, as_of=None, files: str = "true") -> DataFrame:
    return staging.staging_rows(
        rules.valid_rows(validated(spark, sf_dir, files)),
        energy.BUSINESS_COLUMNS,
        energy.IDENTITY_FIELDS,
        instant(fixtures.AS_OF) if as_of is None else as_of,
    )


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.error_rows(
        validated(spark, sf_dir),
        energy.ERROR_CLASSES,
        parsed_columns(),
        instant(fixtures.AS_OF),
    )


@query
def normalize_rows(spark, sf_dir):
    """Trimmed text, blanks as nulls."""
    rows = with_normalised(fixtures.readings(spark, sf_dir), energy.CSV_FIELDS)
    return rows.select("import_id", "source_row_number", *energy.CSV_FIELDS)


@query
def validate_rows(spark, sf_dir):
    """V1-V11, P6."""
    return validated(spark, sf_dir).select(
        "import_id", "source_row_number", "valid", F.array_join("errors", "; ").alias("errors")
    )


@query
def error_rows(spark, sf_dir):
    """E1-E4."""
    return errors(spark, sf_dir).drop("raw_row")


@query
def error_raw_json(spark, sf_dir):
    """E5."""
    return errors(spark, sf_dir).select("error_id", "raw_row")


@query
def error_code_counts(spark, sf_dir):
    """Broken rules per import and code."""
    return (
        errors(spark, sf_dir)
        .groupBy("import_id", "error_code")
        .agg(F.count("*").alias("error_count"))
    )


@query
def staging_rows(spark, sf_dir):
    """P4, P5, P9, F1, F2."""
    return as_plain(staged(spark, sf_dir))


@query
def import_summary(spark, sf_dir):
    """A1, A4, W2, W3."""
    found = summary.summarize(
        fixtures.import_files(spark, sf_dir),
        validated(spark, sf_dir),
        energy.SAMPLE_SIZE,
        ids.record_id(*(F.col(name) for name in energy.IDENTITY_FIELDS)),
    )
    rows = F.transform(
        "invalid_row_sample",
        lambda r: F.concat(r["row_number"].cast("string"), F.lit(":"), F.array_join(r["errors"], "; ")),
    )
    return found.select(
        "import_id",
        "object_name",
        "row_count",
        "valid_row_count",
        "invalid_row_count",
        F.array_join(rows, " | ").alias("invalid_row_sample"),
        "invalid_rows_truncated",
        F.array_join("record_id_sample", ",").alias("record_id_sample"),
        "record_ids_truncated",
    )


@query
def invalid_sample(spark, sf_dir):
    """The first invalid rows of every import."""
    return summary.first_rows(
        validated(spark, sf_dir).where("not valid").select("import_id", "source_row_number"),
        energy.SAMPLE_SIZE,
    )


@query
def record_id_sample(spark, sf_dir):
    """The first record ids of every import."""
    return summary.first_rows(
        staged(spark, sf_dir).select(
            F.col("source_import_id").alias("import_id"), "source_row_number", "record_id"
        ),
        energy.SAMPLE_SIZE,
    )


@query
def dedup_latest(spark, sf_dir):
    """The last row of every record inside its import."""
    return dedup.latest_per_key(
        staged(spark, sf_dir).select(
            "source_import_id", "record_id", "source_row_number", "meter_id", "period_start"
        ),
        ["source_import_id", "record_id"],
        ["source_row_number"],
    )


@query
def dedup_latest_events(spark, sf_dir):
    """W1 on the event table: a user's last event of every type."""
    return dedup.latest_per_key(
        fixtures.table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]
    )


@query
def import_rows(spark, sf_dir):
    """The staging rows of some imports, by semi join."""
    named = fixtures.import_files(spark, sf_dir).where(
        F.col("object_name").endswith("-1.csv")
    )
    rows = upsert.rows_of_imports(
        staged(spark, sf_dir), named.select(F.col("import_id").alias("source_import_id"))
    )
    return rows.select("source_import_id", "source_row_number", "record_id")


def _split_for_merge(spark, sf_dir):
    """Staging rows of the imports merged earlier and of those arriving now."""
    return (
        staged(spark, sf_dir, files=f"not {ARRIVING}"),
        staged(spark, sf_dir, files=ARRIVING),
    )


def _merged(spark, sf_dir):
    earlier, arriving = _split_for_merge(spark, sf_dir)
    target = (
        upsert.merge_source(earlier, arrival=["source_import_id"])
        .drop("ingested_at")
        .withColumns(
            {"created_at": instant(fixtures.AS_OF), "updated_at": instant(fixtures.AS_OF)}
        )
    )
    source = upsert.merge_source(arriving, arrival=["source_import_id"])
    return upsert.upsert(
        target, source, "record_id", energy.UPDATED_COLUMNS, instant(fixtures.MERGED_AT)
    )


@query
def upsert_records(spark, sf_dir):
    """The curated table after the merge."""
    return as_plain(_merged(spark, sf_dir))


@query
def merge_affected(spark, sf_dir):
    """A3."""
    return upsert.affected_rows(_merged(spark, sf_dir).select("action"))


@query
def merge_counts(spark, sf_dir):
    """A3, M1: the affected rows of a merge, observed while its result is written."""
    layout = wh.Warehouse(scratch_path(spark, "merge-counts")).curated
    counted = Observation()
    merged = upsert.observed(_merged(spark, sf_dir), counted).drop("action")
    tables.replace_load(wh.with_month(merged), layout)
    counts = counted.get
    stored = tables.read_table(spark, layout).agg(F.count("*").alias("stored"))
    return stored.select(*(F.lit(n).alias(name) for name, n in counts.items()), "stored")


@query
def merge_once(spark, sf_dir):
    """Repeated staged events; a third of the jobs has run before."""
    runs = fixtures.import_files(spark, sf_dir)
    event = ids.event_id(energy.STAGED_EVENT, F.col("import_id"))
    events = runs.select(
        "import_id", event.alias("event_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")
    ).drop("copy")
    job = ids.merge_job_id(F.col("event_id"), energy.MERGE_JOB_PREFIX)
    done = events.where(F.substring("import_id", 1, 1).isin("0", "3", "6", "9", "c")).select(
        job.alias("merge_job_id")
    )
    return upsert.not_yet_merged(events, done, job).select(
        "import_id", "event_id", "merge_job_id"
    )


@query
def reconcile_counts(spark, sf_dir):
    """Some imports declare one row too many, some were never staged."""
    counted = summary.import_counts(
        fixtures.import_files(spark, sf_dir), validated(spark, sf_dir)
    )
    first = F.substring("import_id", 1, 1)
    events = counted.select(
        "import_id",
        (F.col("valid_row_count") + F.when(first.isin("1", "5", "a"), 1).otherwise(0)).alias(
            "valid_row_count"
        ),
    )
    rows = staged(spark, sf_dir).where(
        ~F.substring("source_import_id", 1, 1).isin("2", "7")
    )
    return reconcile.reconcile(events, rows)


@query
def append_union(spark, sf_dir):
    """Appending the arriving imports to the earlier ones."""
    earlier, arriving = _split_for_merge(spark, sf_dir)
    return as_plain(earlier.unionByName(arriving))


def _csv_validated(spark, sf_dir):
    files = fixtures.csv_files(spark, sf_dir)
    records = csv.with_named_fields(
        csv.csv_records(files, energy.CSV_FIELDS), energy.CSV_FIELDS
    )
    return rules.validate(
        records.withColumnRenamed("row_number", "source_row_number"),
        energy.RULES,
        skip=~F.col("column_count_ok"),
        skip_message=quarantine.COLUMN_COUNT_ERROR,
    )


@query
def csv_records(spark, sf_dir):
    """Records of rendered CSV files, through each file's own header."""
    files = fixtures.csv_files(spark, sf_dir)
    records = csv.csv_records(files, energy.CSV_FIELDS)
    named = csv.with_named_fields(records, energy.CSV_FIELDS)
    return named.select(
        "import_id",
        "row_number",
        "column_count_ok",
        F.size("fields").cast("bigint").alias("field_count"),
        "raw",
        *(
            F.when(F.col("column_count_ok"), F.col(name)).alias(name)
            for name in energy.CSV_FIELDS
        ),
    )


@query
def csv_short_long(spark, sf_dir):
    """Rows with too few or too many fields, reported and not validated further."""
    rows = _csv_validated(spark, sf_dir).where("not column_count_ok")
    return rows.select(
        "import_id", "source_row_number", "raw", F.array_join("errors", "; ").alias("errors")
    )


@query
def csv_errors(spark, sf_dir):
    """C1-C7 into V1-V11 and E1-E4: error counts of the rendered files."""
    rows = quarantine.error_rows(
        _csv_validated(spark, sf_dir),
        energy.ERROR_CLASSES,
        csv.parsed_map(),
        instant(fixtures.AS_OF),
        raw_text=F.col("raw"),
    )
    return rows.groupBy("error_code").agg(
        F.count("*").alias("error_count"),
        F.countDistinct("import_id", "source_row_number").alias("row_count"),
    )


@query
def csv_reject_file(spark, sf_dir):
    """An unclosed quote at the end of some files rejects all of the file."""
    files = fixtures.csv_files(spark, sf_dir)
    broken = files.withColumn(
        "text",
        F.when(
            F.col("object_name").endswith("-2.csv"), F.concat("text", F.lit('\n"never closed'))
        ).otherwise(F.col("text")),
    )
    refused = csv.rejected_files(broken).select(
        "import_id", "object_name", "reason", F.lit(0).cast("bigint").alias("record_count")
    )
    kept = (
        csv.csv_records(broken, ["meter_id"])
        .groupBy("import_id", "object_name")
        .agg(F.count("*").alias("record_count"))
        .select("import_id", "object_name", F.lit("").alias("reason"), "record_count")
    )
    return refused.unionByName(kept)


@query
def rejection_details(spark, sf_dir):
    """What is wrong with every rejected file, and on which line."""
    files = fixtures.csv_files(spark, sf_dir, damaged=False)
    name = F.col("object_name")
    damage = (
        F.when(name.endswith("-0.csv"), F.lit('\n"never closed'))
        .when(name.endswith("-1.csv"), F.lit('\nan "inner" quote'))
        .when(name.endswith("-2.csv"), F.lit('\n"closed" early,1'))
        .otherwise("")
    )
    broken = csv.with_syntax_check(files.withColumn("text", F.concat("text", damage)))
    kind, line = csv.error_position(F.col("text"))
    details = F.when(~F.col("well_formed"), csv.rejection_details(F.col("text")))
    return broken.select(
        "import_id", "object_name", "well_formed",
        F.when(~F.col("well_formed"), kind).alias("error"),
        F.when(~F.col("well_formed"), line).alias("line"),
        details.alias("rejection_details"),
    )


@query
def file_gate(spark, sf_dir):
    """Suffix before size, on one pretended upload per document."""
    files = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr(
            "concat('doc-', doc_id, case doc_id % 4 when 0 then '.csv' when 1 then '.CSV' "
            "when 2 then '.csv.txt' else '.Csv' end)"
        ).alias("object_name"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
    )
    return gate.gate_files(files, energy.CSV_SUFFIX, 2000)


def _decoded(spark, sf_dir, completed: bool):
    spec = energy.COMPLETED_EVENTS if completed else energy.STAGED_EVENTS
    return envelopes.decode_messages(
        fixtures.message_envelopes(spark, sf_dir, completed), spec
    )


@query
def decode_storage_events(spark, sf_dir):
    """S2, F13, F15, F16, F20, T17."""
    decoded = envelopes.decode_storage_events(
        fixtures.storage_envelopes(spark, sf_dir), energy.STORAGE_EVENTS
    )
    return envelopes.accepted(decoded)


@query
def rejected_storage_events(spark, sf_dir):
    """Reasons of the malformed file events."""
    decoded = envelopes.decode_storage_events(
        fixtures.storage_envelopes(spark, sf_dir), energy.STORAGE_EVENTS
    )
    return envelopes.rejected(decoded).select("cloud_event_id", "reason")


@query
def decode_staged_events(spark, sf_dir):
    """S3, F12-F19, F23, F24, T17."""
    events = envelopes.accepted(_decoded(spark, sf_dir, False))
    return events.withColumn(
        "attributes", F.coalesce(F.try_element_at("attributes", F.lit("eventId")), F.lit(""))
    )


@query
def decode_completed_events(spark, sf_dir):
    """Also checks the type attribute."""
    events = envelopes.accepted(_decoded(spark, sf_dir, True))
    return events.withColumn(
        "attributes", F.coalesce(F.try_element_at("attributes", F.lit("eventId")), F.lit(""))
    )


@query
def rejected_events(spark, sf_dir):
    """Malformed messages of both consumers with the first broken check."""
    sides = [
        envelopes.rejected(_decoded(spark, sf_dir, completed)).select(
            F.lit(name).alias("consumer"), "cloud_event_id", "reason", "body"
        )
        for name, completed in (("staged", False), ("completed", True))
    ]
    return sides[0].unionByName(sides[1]).select(
        "consumer",
        "cloud_event_id",
        F.regexp_extract("body", '"messageId":"(msg-[0-9]+)"', 1).alias("message_id"),
        "reason",
    )


@query
def audit_log(spark, sf_dir):
    """P10, T20."""
    return envelopes.audit_records(
        envelopes.accepted(_decoded(spark, sf_dir, True)),
        "energy_import_completed_received",
        instant(fixtures.AS_OF),
    )


@query
def event_ids(spark, sf_dir):
    """Both events of every import, as published."""
    counted = summary.import_counts(
        fixtures.import_files(spark, sf_dir), validated(spark, sf_dir)
    )
    as_of = moment(fixtures.AS_OF)
    staged_events = outbox.build_events(
        counted, energy.STAGED_EVENT, outbox.STAGED_PAYLOAD, as_of
    )
    merged = staged_events.withColumns(
        {
            "staged_event_id": F.col("event_id"),
            "merge_job_id": ids.merge_job_id(F.col("event_id"), energy.MERGE_JOB_PREFIX),
        }
    )
    completed_events = outbox.build_events(
        merged, energy.COMPLETED_EVENT, outbox.COMPLETED_PAYLOAD, as_of
    )
    sides = (
        (staged_events, outbox.STAGED_PAYLOAD),
        (completed_events, outbox.COMPLETED_PAYLOAD),
    )
    published = [outbox.published_messages(df, payload) for df, payload in sides]
    return published[0].unionByName(published[1]).select(
        "event_id",
        "import_id",
        "data",
        F.element_at("attributes", "eventType").alias("event_type"),
        ids.load_job_id(
            energy.STAGING_JOB_PREFIX, F.col("import_id"), F.lit(1)
        ).alias("staging_job_id"),
    )


def _runs(spark, sf_dir):
    return fixtures.import_runs(spark, sf_dir)


@query
def claim_decisions(spark, sf_dir):
    """J2, J3, T2-T6, F21, F25."""
    return ledger.claim(
        fixtures.customer_files(spark, sf_dir),
        _runs(spark, sf_dir).select(*ledger.RUN_FIELDS),
        moment(fixtures.AS_OF),
        JOB_PREFIXES,
    ).drop("bucket_name", "object_generation")


@query
def claimed_runs(spark, sf_dir):
    """The run rows a claim writes."""
    runs = _runs(spark, sf_dir).select(*ledger.RUN_FIELDS)
    as_of = moment(fixtures.AS_OF)
    claims = ledger.claim(
        fixtures.customer_files(spark, sf_dir), runs, as_of, JOB_PREFIXES
    )
    rows = ledger.claimed_runs(claims, runs, F.lit("me"), as_of, energy.LEASE_MINUTES)
    return as_plain(
        rows.select(
            "import_id", "status", "attempt_number", "owner_id", "lease_expires_at",
            "staging_job_status", "validation_errors_job_status", "created_at",
            "updated_at", "version",
        )
    )


@query
def unfinished_files(spark, sf_dir):
    """Files of imports that are not finished yet."""
    return ledger.unfinished(
        fixtures.customer_files(spark, sf_dir), _runs(spark, sf_dir)
    ).select("import_id", "event_id")


def _requests(spark, sf_dir, **columns):
    """A request per customer, for absent runs too; every tenth one arrives twice."""
    base = fixtures.customer_files(spark, sf_dir)
    c = F.expr("size_bytes div 1000")
    return base.withColumn("c", c).withColumns(columns)


def _transitioned(spark, sf_dir, requests, change, *columns):
    runs = _runs(spark, sf_dir).select(*ledger.RUN_FIELDS)
    out = ledger.transition(requests, runs, change)
    return as_plain(out.select("import_id", "status", *columns, "version", "outcome", "violation"))


@query
def ledger_output(spark, sf_dir):
    """The staging output of every run is reported as written."""
    requests = _requests(spark, sf_dir, owner_id=F.lit(OWNER), load=F.lit("load-1"))
    change = ledger.output_succeeded("staging", "staging_load", moment(fixtures.AS_OF))
    return _transitioned(
        spark, sf_dir, requests, change, "staging_job_status", "staging_load", "updated_at"
    )


@query
def ledger_stage(spark, sf_dir):
    """T8, T11."""
    requests = _requests(
        spark,
        sf_dir,
        owner_id=F.lit(OWNER),
        row_count=F.col("c") + 3,
        valid_row_count=F.col("c") + 1,
        invalid_row_count=F.lit(2),
    )
    return _transitioned(
        spark, sf_dir, requests, ledger.staged(moment(fixtures.AS_OF)),
        "row_count", "valid_row_count", "invalid_row_count", "lease_expires_at", "updated_at",
    )


@query
def ledger_fail(spark, sf_dir):
    """T9."""
    requests = _requests(
        spark,
        sf_dir,
        owner_id=F.lit(OWNER),
        technical_error=F.lit("disk full"),
        failed_output=F.when(F.col("c") % 3 == 0, F.lit("staging")),
    )
    return _transitioned(
        spark, sf_dir, requests, ledger.technical_failure(moment(fixtures.AS_OF)),
        "staging_job_status", "validation_errors_job_status", "technical_error",
        "lease_expires_at", "updated_at",
    )


@query
def ledger_reject(spark, sf_dir):
    """Some requests come from an owner, some from the size gate."""
    requests = _requests(
        spark,
        sf_dir,
        owner_id=F.when(F.col("c") % 5 != 0, F.lit(OWNER)),
        rejection_reason=F.lit(csv.INVALID_CSV),
        rejection_details=F.lit(None).cast("string"),
    )
    return _transitioned(
        spark, sf_dir, requests, ledger.rejected(moment(fixtures.AS_OF)),
        "event_id", "rejection_reason", "lease_expires_at", "created_at", "updated_at",
    )


@query
def ledger_publish_staged(spark, sf_dir):
    """T12."""
    requests = _requests(spark, sf_dir, event_id=F.concat(F.lit("new-"), "c"))
    return _transitioned(
        spark, sf_dir, requests, ledger.staged_event_published(moment(fixtures.AS_OF)),
        "staged_event_id", "staged_event_published_at", "updated_at",
    )


@query
def ledger_complete(spark, sf_dir):
    """Every fourth request names another staged event."""
    requests = _requests(
        spark,
        sf_dir,
        staged_event_id=F.concat(
            F.when(F.expr("c div 12 % 4 = 0"), "other-").otherwise("staged-"), "c"
        ),
        merge_job_id=F.concat(F.lit("merge-"), "c"),
    )
    return _transitioned(
        spark, sf_dir, requests, ledger.completed(moment(fixtures.AS_OF)),
        "staged_event_id", "staged_event_published_at", "merge_job_id", "merge_job_status",
        "processed_staged_event_id", "completed_at", "updated_at",
    )


@query
def ledger_publish_completed(spark, sf_dir):
    """Every fourth request names another completed event."""
    requests = _requests(
        spark,
        sf_dir,
        event_id=F.concat(
            F.when(F.expr("c div 12 % 4 = 0"), "other-").otherwise("completed-"), "c"
        ),
    )
    return _transitioned(
        spark, sf_dir, requests, ledger.completed_event_published(moment(fixtures.AS_OF)),
        "completed_event_id", "completed_event_published_at", "updated_at",
    )


@query
def outbox_repair(spark, sf_dir):
    """Events of finished runs that were never recorded as published."""
    runs = _runs(spark, sf_dir)
    as_of = moment(fixtures.AS_OF)
    staged_side = outbox.build_events(
        ledger.unpublished_staged(runs), energy.STAGED_EVENT, outbox.STAGED_PAYLOAD, as_of
    )
    completed_side = outbox.build_events(
        ledger.unpublished_completed(runs),
        energy.COMPLETED_EVENT,
        outbox.COMPLETED_PAYLOAD,
        as_of,
    )
    columns = ["event_id", "event_type", "occurred_at", "import_id", "row_count"]
    return staged_side.select(*columns).unionByName(completed_side.select(*columns))


def _aged_staging(spark, sf_dir):
    """Staging rows whose ingestion is spread over the ten days before ``AS_OF``."""
    days = F.col("source_row_number") % 10
    return (
        staged(spark, sf_dir)
        .withColumn("ingested_at", F.col("ingested_at") - F.make_dt_interval(days.cast("int")))
        .withColumn("ingested_date", F.to_date("ingested_at"))
    )


@query
def expire_staging(spark, sf_dir):
    """What is left of the staging table after retention."""
    rows = retention.expire_partitions(
        _aged_staging(spark, sf_dir),
        "ingested_date",
        energy.STAGING_RETENTION_DAYS,
        instant(fixtures.AS_OF),
    )
    return rows.select("source_import_id", "source_row_number", "record_id", "ingested_date")


@query
def expired_days(spark, sf_dir):
    """The day partitions retention drops."""
    return retention.expired_days(
        _aged_staging(spark, sf_dir),
        "ingested_date",
        energy.STAGING_RETENTION_DAYS,
        instant(fixtures.AS_OF),
    )


@query
def partitioned_layout(spark, sf_dir):
    """Rows written to the curated layout and all of it read back."""
    layout = wh.Warehouse(scratch_path(spark, "layout")).curated
    rows = wh.with_month(
        staged(spark, sf_dir, moment(fixtures.AS_OF))
        .withColumnRenamed("ingested_at", "created_at")
        .withColumn("updated_at", F.col("created_at"))
    )
    tables.replace_load(rows, layout)
    read = tables.read_table(spark, layout)
    return read.groupBy("period_month").agg(
        F.count("*").alias("record_count"), F.countDistinct("meter_id").alias("meter_count")
    )


def _reading_files(spark, sf_dir, files: str = "true", path: str | None = None) -> str:
    """``readings`` as real CSV files, one per import, below a scratch folder."""
    path = path or scratch_path(spark, "upload")
    with shuffles_dropped(spark):
        (
            fixtures.readings(spark, sf_dir)
            .where(files)
            .select("object_name", "source_row_number", *energy.CSV_FIELDS)
            .repartition("object_name")
            .sortWithinPartitions("object_name", "source_row_number")
            .drop("source_row_number")
            .write.partitionBy("object_name")
            .options(
                header=True,
                emptyValue="",
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
            )
            .mode("overwrite")
            .csv(path)
        )
    return path


def _reading_identity(path, _modified):
    return {
        "bucket_name": F.lit(fixtures.BUCKET),
        "object_name": F.regexp_extract(path, "object_name=([^/]+)/", 1),
        "object_generation": F.lit(fixtures.GENERATION),
    }


def _ingested(spark, sf_dir) -> wh.Warehouse:
    root = scratch_path(spark, "ingest")
    warehouse = wh.Warehouse(f"{root}/tables")
    uploaded = _reading_files(spark, sf_dir)
    ingest.start_ingest(
        spark,
        uploaded,
        warehouse,
        f"{root}/checkpoint",
        identity=_reading_identity,
    ).awaitTermination()
    # Every file is in the tables now; nothing opens it again.
    tables.drop_path(spark, uploaded)
    return warehouse


@query
def stream_ingest(spark, sf_dir):
    """Files as a stream, all resulting tables."""
    warehouse = _ingested(spark, sf_dir)
    runs = wh.runs_of(spark, warehouse).select(
        F.concat_ws(
            "/", F.lit("run"), "status", F.col("staged_event_published_at").isNotNull().cast("string")
        ).alias("kind"),
        "import_id",
        F.concat_ws("/", "row_count", "valid_row_count", "invalid_row_count").alias("item"),
    )
    staged_side = wh.committed_staging(spark, warehouse).select(
        F.concat_ws("/", F.lit("row"), "source_row_number").alias("kind"),
        F.col("source_import_id").alias("import_id"),
        F.col("record_id").alias("item"),
    )
    error_side = wh.committed_errors(spark, warehouse).select(
        F.concat_ws("/", F.lit("error"), "source_row_number").alias("kind"),
        "import_id",
        F.col("error_id").alias("item"),
    )
    return runs.unionByName(staged_side).unionByName(error_side)


@query
def stream_merge(spark, sf_dir):
    """The curated table after ingest and merge streams."""
    warehouse = _ingested(spark, sf_dir)
    merge.start_merge(spark, warehouse, f"{warehouse.root}/../merge").awaitTermination()
    curated = tables.read_table(spark, warehouse.curated)
    return as_plain(curated.drop("created_at", "updated_at"))


@query
def stream_dedup(spark, sf_dir):
    """Every event delivered twice, kept once."""
    source = f"{sf_dir.rstrip('/')}/events.parquet"
    root = scratch_path(spark, "dedup")
    delivered = (
        spark.readStream.schema(spark.read.parquet(source).schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .withColumn("event_time", F.col("ts").cast("timestamp"))
        .withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    )
    once = audit.drop_repeated(delivered, "event_time", "40 days")
    (
        once.select("event_id", "user_id", "event_type", "ts")
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")


@query
def stream_merge_twice(spark, sf_dir):
    """A second drop of files updates, inserts and keeps rows of a filled table."""
    root = scratch_path(spark, "twice")
    warehouse = wh.Warehouse(f"{root}/tables")
    for drop in ("object_name not like '%-3.csv'", "object_name like '%-3.csv'"):
        uploaded = _reading_files(spark, sf_dir, drop)
        ingest.ingest_folder(spark, uploaded, warehouse, identity=_reading_identity)
        tables.drop_path(spark, uploaded)
        merge.start_merge(spark, warehouse, f"{root}/merge").awaitTermination()
    return as_plain(tables.read_table(spark, warehouse.curated).drop("created_at", "updated_at"))


def _versioned_identity(path, modified):
    return {
        **_reading_identity(path, modified),
        "object_generation": F.unix_millis(modified).cast("string"),
    }


@query
def stream_reupload(spark, sf_dir):
    """Files uploaded again under their names are imports of their own."""
    root = scratch_path(spark, "reupload")
    warehouse = wh.Warehouse(f"{root}/tables")
    for _ in range(2):
        path = _reading_files(spark, sf_dir, path=f"{root}/upload")
        ingest.ingest_folder(spark, path, warehouse, identity=_versioned_identity)
    runs = wh.runs_of(spark, warehouse)
    return runs.groupBy("object_name", "status").agg(
        F.count("*").alias("versions"), F.sum("row_count").alias("row_count"),
        F.sum("valid_row_count").alias("valid_row_count"),
    )


@query
def csv_edge_records(spark, sf_dir):
    """A byte order mark before, and empty lines between all records."""
    files = fixtures.csv_files(spark, sf_dir, damaged=False)
    sparse = F.concat(F.lit("\ufeff"), F.replace("text", F.lit("\n"), F.lit("\n\n")))
    records = csv.csv_records(files.withColumn("text", sparse), energy.CSV_FIELDS)
    named = csv.with_named_fields(records, energy.CSV_FIELDS)
    return named.select("import_id", "row_number", "column_count_ok", "meter_id", "period_start")


@query
def safe_counts(spark, sf_dir):
    """reported row counts as text, sound and not."""
    c = F.col("c_custkey")
    reported = (
        F.when(c % 9 == 1, F.concat(c, F.lit(".0")))
        .when(c % 9 == 2, F.concat(c, F.lit(".5")))
        .when(c % 9 == 3, F.concat(F.lit("-"), c))
        .when(c % 9 == 4, "many")
        .when(c % 9 == 5, "9007199254740992")
        .when(c % 9 == 6, F.concat(F.lit(" "), c, F.lit("\t")))
        .when(c % 9 == 7, F.lit(None).cast("string"))
        .otherwise(c.cast("string"))
    )
    customers = fixtures.table(spark, sf_dir, "customer").select("c_custkey", reported.alias("reported"))
    return customers.select("c_custkey", "reported", safe_count(F.col("reported")).alias("row_count"))


@query
def optional_event_fields(spark, sf_dir):
    """sound messages with and without a publish time, some over the size limit."""
    envelopes_ = fixtures.message_envelopes(spark, sf_dir, False)
    c = F.regexp_extract(F.try_element_at("headers", F.lit("ce-id")), r"(\d+)", 1).try_cast("bigint")
    sound = envelopes_.withColumn("c", c).where("c % 19 in (0, 17, 18)")
    given = (
        F.when(F.col("c") % 4 == 1, '"publishTime":"2026-01-01T00:00:00Z",')
        .when(F.col("c") % 4 == 2, '"publishTime":"",')
        .when(F.col("c") % 4 == 3, '"publishTime":5,')
        .otherwise("")
    )
    body = F.replace(F.col("body"), F.lit('"messageId"'), F.concat(given, F.lit('"messageId"')))
    too_long = F.rpad(body, energy.STAGED_EVENTS.max_body_bytes + 1, " ")
    sent = sound.select("headers", F.when(F.col("c") % 97 == 0, too_long).otherwise(body).alias("body"))
    decoded = envelopes.decode_messages(sent, energy.STAGED_EVENTS)
    return decoded.select("cloud_event_id", "publish_time", "reason")
