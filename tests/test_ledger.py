from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rowgate import energy
from rowgate.operators import ledger

NOW = datetime(2026, 7, 1, 12)
PREFIXES = (energy.STAGING_JOB_PREFIX, energy.ERRORS_JOB_PREFIX)
FILE = ("import-1", "event-1", "bucket", "energy.csv", "1", 100)
FILE_DDL = ", ".join(f"{n} {k}" for n, k in ledger.IDENTITY)


def as_of():
    return F.lit(NOW)


def runs(spark, *states):
    names = ledger.RUN_FIELDS
    data = [
        tuple({"import_id": "import-1", "version": 1, **state}.get(n) for n in names)
        for state in states
    ]
    return spark.createDataFrame(data, ledger.run_ddl())


def claim(spark, *states, **kwargs):
    files = spark.createDataFrame([FILE], FILE_DDL)
    known = runs(spark, *states)
    claims = ledger.claim(files, known, as_of(), PREFIXES, **kwargs)
    rows = ledger.claimed_runs(claims, known, F.lit("me"), as_of(), energy.LEASE_MINUTES)
    return claims.first(), rows.collect()


def test_first_claim(spark):
    decision, (run,) = claim(spark)
    assert (decision.decision, decision.attempt_number) == (ledger.CLAIMED, 1)
    assert decision.staging_job_id == "energy-staging-import-1-1"
    assert decision.validation_errors_job_id == "energy-validation-errors-import-1-1"
    assert not decision.staging_already_succeeded
    assert (run.status, run.owner_id, run.staging_job_status) == ("PROCESSING", "me", "PENDING")
    assert run.lease_expires_at == NOW + timedelta(minutes=10)
    assert (run.created_at, run.size_bytes, run.version) == (NOW, 100, 1)


def test_live_lease(spark):
    live = {"status": "PROCESSING", "lease_expires_at": NOW + timedelta(seconds=1), "owner_id": "you"}
    decision, rows = claim(spark, live)
    assert (decision.decision, rows) == (ledger.IN_PROGRESS, [])
    assert claim(spark, live, resuming_owner="me")[0].decision == ledger.IN_PROGRESS
    assert claim(spark, live, resuming_owner="you")[0].decision == ledger.CLAIMED


def test_expired_lease_keeps_the_attempt(spark):
    decision, _ = claim(
        spark, {"status": "PROCESSING", "lease_expires_at": NOW, "attempt_number": 3, "staging_job_id": "old"}
    )
    assert (decision.decision, decision.attempt_number, decision.staging_job_id) == ("claimed", 3, "old")


def test_retry_keeps_the_written_output_and_replaces_the_failed_one(spark):
    decision, (run,) = claim(
        spark,
        {
            "status": "FAILED_TECHNICAL",
            "attempt_number": 1,
            "staging_job_id": "old-staging",
            "staging_job_status": "SUCCEEDED",
            "validation_errors_job_id": "old-errors",
            "validation_errors_job_status": "FAILED",
            "technical_error": "boom",
            "staging_load": "load-0",
        },
    )
    assert decision.attempt_number == 2
    assert decision.staging_job_id == "old-staging" and decision.staging_already_succeeded
    assert decision.validation_errors_job_id == "energy-validation-errors-import-1-2"
    assert (run.staging_job_status, run.validation_errors_job_status) == ("SUCCEEDED", "PENDING")
    assert (run.technical_error, run.staging_load, run.version) == (None, "load-0", 2)


@pytest.mark.parametrize("status", ["STAGED", "COMPLETED", "REJECTED_DATA"])
def test_finished_imports_are_not_claimed(spark, status):
    decision, rows = claim(spark, {"status": status, "valid_row_count": 6})
    assert (decision.decision, decision.finished_status, decision.valid_row_count) == (
        ledger.ALREADY_FINISHED, status, 6,
    )
    assert (decision.row_count, decision.staged_event_published, rows) == (0, False, [])


def test_the_same_file_twice_in_a_batch_is_one_claim(spark):
    files = spark.createDataFrame([FILE, ("import-1", "event-2", *FILE[2:])], FILE_DDL)
    assert ledger.claim(files, runs(spark), as_of(), PREFIXES).count() == 1


def move(spark, state, change, **request):
    ddl = ", ".join(f"{n} {'bigint' if isinstance(v, int) else 'string'}" for n, v in request.items())
    asked = spark.createDataFrame(
        [("import-1", *request.values())], f"import_id string{', ' + ddl if ddl else ''}"
    )
    known = runs(spark, state) if state else runs(spark)
    (row,) = ledger.transition(asked, known, change).collect()
    return row


def test_staged_event_is_recorded_once_even_after_completion(spark):
    change = ledger.staged_event_published
    done = move(spark, {"status": "COMPLETED"}, change(as_of()), event_id="e-1")
    assert (done.outcome, done.staged_event_id, done.staged_event_published_at) == ("applied", "e-1", NOW)
    again = move(
        spark,
        {"status": "STAGED", "staged_event_id": "e-0", "staged_event_published_at": NOW},
        change(as_of()),
        event_id="e-1",
    )
    assert (again.outcome, again.staged_event_id) == ("noop", "e-0")
    early = move(spark, {"status": "PROCESSING"}, change(as_of()), event_id="e-1")
    assert (early.outcome, early.violation) == ("violation", ledger.NOT_STAGED_OR_COMPLETED)


def complete(spark, state, event="staged-event-1"):
    return move(spark, state, ledger.completed(as_of()), staged_event_id=event, merge_job_id="merge-1")


def test_completion(spark):
    row = complete(spark, {"status": "STAGED", "staged_event_id": "staged-event-1", "technical_error": "x"})
    assert (row.outcome, row.status, row.merge_job_id, row.merge_job_status) == (
        "applied", "COMPLETED", "merge-1", "SUCCEEDED",
    )
    assert (row.processed_staged_event_id, row.completed_at, row.technical_error) == ("staged-event-1", NOW, None)
    assert row.staged_event_published_at == NOW


def test_completion_repeats_and_violations(spark):
    assert complete(spark, {"status": "COMPLETED"}).outcome == "noop"
    assert complete(spark, {"status": "COMPLETED", "staged_event_id": "other"}).outcome == "noop"
    assert complete(spark, None).violation == ledger.NOT_FOUND
    assert complete(spark, {"status": "PROCESSING"}).violation == ledger.NOT_STAGED
    assert complete(spark, {"status": "STAGED", "staged_event_id": "e"}).violation == ledger.STAGED_EVENT_MISMATCH


def test_completed_event_publication(spark):
    change = ledger.completed_event_published
    row = move(spark, {"status": "COMPLETED"}, change(as_of()), event_id="c-1")
    assert (row.outcome, row.completed_event_id, row.completed_event_published_at) == ("applied", "c-1", NOW)
    published = {"status": "COMPLETED", "completed_event_id": "c-1", "completed_event_published_at": NOW}
    assert move(spark, published, change(as_of()), event_id="c-1").outcome == "noop"
    assert move(spark, published, change(as_of()), event_id="c-2").violation == ledger.COMPLETED_EVENT_MISMATCH
    assert move(spark, {"status": "STAGED"}, change(as_of()), event_id="c").violation == ledger.NOT_COMPLETED


def test_only_the_owner_moves_a_run(spark):
    ours = {"status": "PROCESSING", "owner_id": "me", "staging_job_status": "SUCCEEDED"}
    change = ledger.output_succeeded("validation_errors", "errors_load", as_of())
    row = move(spark, ours, change, owner_id="me", load="l")
    assert (row.outcome, row.validation_errors_job_status, row.errors_load) == ("applied", "SUCCEEDED", "l")
    assert move(spark, ours, change, owner_id="you", load="l").violation == ledger.NOT_OWNED
    counts = {"row_count": 7, "valid_row_count": 6, "invalid_row_count": 1}
    early = move(spark, ours, ledger.staged(as_of()), owner_id="me", **counts)
    assert early.violation == ledger.OUTPUTS_PENDING
    both = {**ours, "validation_errors_job_status": "SUCCEEDED"}
    staged = move(spark, both, ledger.staged(as_of()), owner_id="me", **counts)
    assert (staged.status, staged.row_count, staged.lease_expires_at) == ("STAGED", 7, NOW)


def test_technical_failure_marks_the_failed_output_only_when_named(spark):
    ours = {"status": "PROCESSING", "owner_id": "me", "staging_job_status": "SUCCEEDED",
            "validation_errors_job_status": "PENDING"}
    change = ledger.technical_failure(as_of())
    row = move(spark, ours, change, owner_id="me", technical_error="x", failed_output="validation_errors")
    assert (row.status, row.staging_job_status, row.validation_errors_job_status) == (
        "FAILED_TECHNICAL", "SUCCEEDED", "FAILED",
    )


def test_rejection(spark):
    request = dict(zip([n for n, _ in ledger.IDENTITY][1:], FILE[1:]))
    request.update(rejection_reason="FILE_TOO_LARGE", rejection_details="d")

    def reject(state, owner):
        asked = spark.createDataFrame(
            [("import-1", *request.values(), owner)],
            FILE_DDL + ", rejection_reason string, rejection_details string, owner_id string",
        )
        known = runs(spark, state) if state else runs(spark)
        return ledger.transition(asked, known, ledger.rejected(as_of())).first()

    new = reject(None, None)
    assert (new.outcome, new.status, new.rejection_reason, new.created_at) == (
        "applied", "REJECTED_DATA", "FILE_TOO_LARGE", NOW,
    )
    assert reject({"status": "STAGED"}, "me").outcome == "noop"
    assert reject({"status": "PROCESSING", "owner_id": "you"}, "me").violation == ledger.NOT_OWNED
    assert reject(None, "me").violation == ledger.NOT_OWNED


def test_current_runs_pick_the_newest_version(spark):
    log = runs(spark, {"version": 1, "status": "PROCESSING"}, {"version": 2, "status": "STAGED"},
               {"version": 2, "status": "STAGED"}, {"import_id": "other", "version": 9})
    named = spark.createDataFrame([("import-1",), ("import-1",)], "import_id string")
    assert [(r.import_id, r.status) for r in ledger.current_runs(log, named).collect()] == [("import-1", "STAGED")]
