"""The import ledger as set-based decisions.

A run is one row per import. Operators take many requests at once, join them to
the runs they name and return new run rows; nothing throws for a single row.
``outcome`` says what happened to each request: ``applied``, ``noop`` or
``violation`` (with the broken precondition in ``violation``).

Storage is append-only: every new row carries ``version``, one higher than the
row it replaces, and ``current_runs`` picks the newest. A replayed batch appends
equal rows again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.functions.ids import load_job_id
from rowgate.functions.values import integer_or_zero
from rowgate.operators.dedup import latest_per_key

# Run states and output states.
PROCESSING = "PROCESSING"
STAGED = "STAGED"
COMPLETED = "COMPLETED"
REJECTED_DATA = "REJECTED_DATA"
FAILED_TECHNICAL = "FAILED_TECHNICAL"
TERMINAL = (STAGED, COMPLETED, REJECTED_DATA)
PENDING = "PENDING"
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"

# Claim decisions.
ALREADY_FINISHED = "already-finished"
IN_PROGRESS = "in-progress"
CLAIMED = "claimed"

APPLIED = "applied"
NOOP = "noop"
VIOLATION = "violation"

# Preconditions a request can break.
NOT_OWNED = "LEASE_NOT_OWNED"
OUTPUTS_PENDING = "OUTPUTS_NOT_SUCCEEDED"
NOT_STAGED_OR_COMPLETED = "NOT_STAGED_OR_COMPLETED"
NOT_FOUND = "RUN_NOT_FOUND"
NOT_STAGED = "NOT_STAGED"
NOT_COMPLETED = "NOT_COMPLETED"
STAGED_EVENT_MISMATCH = "STAGED_EVENT_MISMATCH"
COMPLETED_EVENT_MISMATCH = "COMPLETED_EVENT_MISMATCH"

# The identity a run copies from its file event.
IDENTITY = (
    ("import_id", "string"),
    ("event_id", "string"),
    ("bucket_name", "string"),
    ("object_name", "string"),
    ("object_generation", "string"),
    ("size_bytes", "bigint"),
)
# All fields of a run.
RUN_COLUMNS = (
    *IDENTITY,
    ("status", "string"),
    ("attempt_number", "bigint"),
    ("owner_id", "string"),
    ("lease_expires_at", "timestamp"),
    ("staging_job_id", "string"),
    ("staging_job_status", "string"),
    ("validation_errors_job_id", "string"),
    ("validation_errors_job_status", "string"),
    ("technical_error", "string"),
    ("created_at", "timestamp"),
    ("updated_at", "timestamp"),
    ("row_count", "bigint"),
    ("valid_row_count", "bigint"),
    ("invalid_row_count", "bigint"),
    ("rejection_reason", "string"),
    ("rejection_details", "string"),
    ("staged_event_id", "string"),
    ("staged_event_published_at", "timestamp"),
    ("merge_job_id", "string"),
    ("merge_job_status", "string"),
    ("processed_staged_event_id", "string"),
    ("completed_at", "timestamp"),
    ("completed_event_id", "string"),
    ("completed_event_published_at", "timestamp"),
)
# Which load holds the rows of each output, and the row's place in the log.
LOG_COLUMNS = (
    *RUN_COLUMNS,
    ("staging_load", "string"),
    ("errors_load", "string"),
    ("version", "bigint"),
)
RUN_FIELDS = tuple(name for name, _ in LOG_COLUMNS)


def run_ddl() -> str:
    return ", ".join(f"{name} {kind}" for name, kind in LOG_COLUMNS)


def current_runs(log: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """The newest row per import, of the named imports only when given.

    The semi join comes first: the log holds every import ever seen, a batch
    names few of them.
    """
    if imports is not None:
        log = log.join(imports.select("import_id").distinct(), "import_id", "left_semi")
    return latest_per_key(log, ["import_id"], ["version", "updated_at"])


def _old(name: str) -> Column:
    return F.col(f"run.{name}")


def _new(name: str) -> Column:
    return F.col(f"req.{name}")


def _against_runs(requests: DataFrame, runs: DataFrame) -> DataFrame:
    return requests.alias("req").join(
        runs.alias("run"), F.col("req.import_id") == F.col("run.import_id"), "left"
    )


def _run_row(changes: dict[str, Column]) -> list[Column]:
    """A full run row: the changed fields, the rest as it was, the next version."""
    changes = {
        "version": F.coalesce(_old("version"), F.lit(0)) + 1,
        **changes,
    }
    return [
        changes.get(name, _old(name)).cast(kind).alias(name)
        for name, kind in LOG_COLUMNS
    ]


def claim(
    files: DataFrame,
    runs: DataFrame,
    as_of: Column,
    job_prefixes: tuple[str, str],
    resuming_owner: str | None = None,
) -> DataFrame:
    """What to do with each incoming file; one row per import.

    ``decision`` is ``already-finished``, ``in-progress`` (someone holds a live
    lease) or ``claimed`` with attempt number, job ids and which outputs an
    earlier attempt already wrote. ``resuming_owner`` is a writer that may take
    over its own live lease: a streaming query replaying its last batch.
    """
    once = latest_per_key(files, ["import_id"], ["event_id"])
    joined = _against_runs(once, runs)
    finished = F.coalesce(_old("status").isin(*TERMINAL), F.lit(False))
    leased = (_old("status") == PROCESSING) & (_old("lease_expires_at") > as_of)
    if resuming_owner is not None:
        leased = leased & ~F.coalesce(_old("owner_id") == resuming_owner, F.lit(False))
    decision = (
        F.when(finished, ALREADY_FINISHED)
        .when(F.coalesce(leased, F.lit(False)), IN_PROGRESS)
        .otherwise(CLAIMED)
    )
    previous = integer_or_zero(_old("attempt_number"))
    attempt = (
        F.when(previous == 0, F.lit(1).cast("bigint"))
        .when(_old("status") == FAILED_TECHNICAL, previous + 1)
        .otherwise(previous)
    )

    def job_id(output: str, prefix: str) -> Column:
        known = _old(f"{output}_job_id")
        keep = known.isNotNull() & ~_old(f"{output}_job_status").eqNullSafe(FAILED)
        return F.when(keep, known).otherwise(
            load_job_id(prefix, _new("import_id"), attempt)
        )

    def when_claimed(value: Column) -> Column:
        return F.when(decision == CLAIMED, value)

    def when_finished(value: Column) -> Column:
        return F.when(decision == ALREADY_FINISHED, value)

    staging_prefix, errors_prefix = job_prefixes
    return joined.select(
        *(_new(c).alias(c) for c in files.columns),
        decision.alias("decision"),
        when_finished(_old("status")).alias("finished_status"),
        when_finished(_old("staged_event_published_at").isNotNull()).alias(
            "staged_event_published"
        ),
        *(
            when_finished(integer_or_zero(_old(c))).alias(c)
            for c in ("row_count", "valid_row_count", "invalid_row_count")
        ),
        when_claimed(attempt).alias("attempt_number"),
        when_claimed(job_id("staging", staging_prefix)).alias("staging_job_id"),
        when_claimed(job_id("validation_errors", errors_prefix)).alias(
            "validation_errors_job_id"
        ),
        when_claimed(_old("staging_job_status").eqNullSafe(SUCCEEDED)).alias(
            "staging_already_succeeded"
        ),
        when_claimed(_old("validation_errors_job_status").eqNullSafe(SUCCEEDED)).alias(
            "validation_errors_already_succeeded"
        ),
    )


def claimed_runs(
    claims: DataFrame,
    runs: DataFrame,
    owner: Column,
    as_of: Column,
    lease_minutes: int,
    clock: Column | None = None,
) -> DataFrame:
    """The run rows a claim writes; the lease begins at ``clock``, by default ``as_of``."""
    leased_from = as_of if clock is None else clock
    claimed = claims.where(F.col("decision") == CLAIMED)

    def output_status(flag: str) -> Column:
        return F.when(_new(flag), SUCCEEDED).otherwise(PENDING)

    return _against_runs(claimed, runs).select(
        *_run_row(
            {
                **{name: _new(name) for name, _ in IDENTITY},
                "status": F.lit(PROCESSING),
                "attempt_number": _new("attempt_number"),
                "owner_id": owner,
                "lease_expires_at": leased_from + F.make_dt_interval(mins=F.lit(lease_minutes)),
                "staging_job_id": _new("staging_job_id"),
                "staging_job_status": output_status("staging_already_succeeded"),
                "validation_errors_job_id": _new("validation_errors_job_id"),
                "validation_errors_job_status": output_status(
                    "validation_errors_already_succeeded"
                ),
                "technical_error": F.lit(None),
                "created_at": F.coalesce(_old("created_at"), as_of),
                "updated_at": as_of,
            }
        )
    )


@dataclass(frozen=True)
class Transition:
    """A state change: what must hold, when nothing is left to do, what it writes.

    ``checks`` are (must hold, violation) pairs; the first broken one counts.
    ``settled`` is looked at after the first ``checks_before_settled`` checks.
    """

    checks: Sequence[tuple[Column, str]]
    changes: dict[str, Column]
    settled: Column = field(default_factory=lambda: F.lit(False))
    checks_before_settled: int = 0


def transition(requests: DataFrame, runs: DataFrame, change: Transition) -> DataFrame:
    """Apply one kind of change to many runs.

    Gives the full run row as it should be stored plus ``outcome`` and
    ``violation``; a ``noop`` or ``violation`` shows the run as it is.
    """

    def broken(checks) -> Column:
        return F.coalesce(
            *(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in checks),
            F.lit(None).cast("string"),
        )

    first, rest = (
        change.checks[: change.checks_before_settled],
        change.checks[change.checks_before_settled :],
    )
    settled = F.coalesce(change.settled, F.lit(False))
    violation = F.coalesce(broken(first), F.when(~settled, broken(rest)))
    outcome = (
        F.when(violation.isNotNull(), VIOLATION).when(settled, NOOP).otherwise(APPLIED)
    )
    judged = _against_runs(requests, runs).select(
        F.struct("req.*").alias("req"),
        F.struct("run.*").alias("run"),
        violation.alias("violation"),
        outcome.alias("outcome"),
    )
    applied = F.col("outcome") == APPLIED
    changes = {
        name: F.when(applied, value).otherwise(_old(name))
        for name, value in {
            "version": F.coalesce(_old("version"), F.lit(0)) + 1,
            **change.changes,
        }.items()
    }
    changes["import_id"] = _new("import_id")
    return judged.select(*_run_row(changes), "outcome", "violation")


def applied_runs(outcomes: DataFrame) -> DataFrame:
    """The run rows to append."""
    return outcomes.where(F.col("outcome") == APPLIED).select(*RUN_FIELDS)


def violations(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("outcome") == VIOLATION)


def _owned() -> tuple[Column, str]:
    """Only the holder of the lease may move a run on."""
    held = (_old("status") == PROCESSING) & (_old("owner_id") == _new("owner_id"))
    return held, NOT_OWNED


def output_succeeded(output: str, load_column: str, as_of: Column) -> Transition:
    """T7. Requests: import_id, owner_id, load."""
    return Transition(
        checks=[_owned()],
        changes={
            f"{output}_job_status": F.lit(SUCCEEDED),
            load_column: F.coalesce(_old(load_column), _new("load")),
            "updated_at": as_of,
        },
    )


def staged(as_of: Column) -> Transition:
    """T8. Requests: import_id, owner_id and the three counts."""
    both = (_old("staging_job_status") == SUCCEEDED) & (
        _old("validation_errors_job_status") == SUCCEEDED
    )
    return Transition(
        checks=[_owned(), (both, OUTPUTS_PENDING)],
        changes={
            "status": F.lit(STAGED),
            "row_count": _new("row_count"),
            "valid_row_count": _new("valid_row_count"),
            "invalid_row_count": _new("invalid_row_count"),
            "lease_expires_at": as_of,
            "updated_at": as_of,
        },
    )


def technical_failure(as_of: Column) -> Transition:
    """T9. Requests: import_id, owner_id, technical_error, failed_output (or null)."""

    def status(output: str) -> Column:
        return F.when(_new("failed_output") == output, FAILED).otherwise(
            _old(f"{output}_job_status")
        )

    return Transition(
        checks=[_owned()],
        changes={
            "status": F.lit(FAILED_TECHNICAL),
            "staging_job_status": status("staging"),
            "validation_errors_job_status": status("validation_errors"),
            "technical_error": _new("technical_error"),
            "lease_expires_at": as_of,
            "updated_at": as_of,
        },
    )


def rejected(as_of: Column) -> Transition:
    """T10. Requests: the identity, owner_id (or null), rejection_reason, rejection_details."""
    owner_agrees = _new("owner_id").isNull() | (_old("owner_id") == _new("owner_id"))
    return Transition(
        settled=_old("status").isin(*TERMINAL),
        checks=[(owner_agrees, NOT_OWNED)],
        changes={
            **{name: _new(name) for name, _ in IDENTITY},
            "status": F.lit(REJECTED_DATA),
            "rejection_reason": _new("rejection_reason"),
            "rejection_details": _new("rejection_details"),
            "lease_expires_at": as_of,
            "created_at": F.coalesce(_old("created_at"), as_of),
            "updated_at": as_of,
        },
    )


def staged_event_published(as_of: Column) -> Transition:
    """T12, first writer wins. Requests: import_id, event_id."""
    return Transition(
        checks=[(_old("status").isin(STAGED, COMPLETED), NOT_STAGED_OR_COMPLETED)],
        checks_before_settled=1,
        settled=_old("staged_event_published_at").isNotNull(),
        changes={
            "staged_event_id": _new("event_id"),
            "staged_event_published_at": as_of,
            "updated_at": as_of,
        },
    )


def completed(as_of: Column) -> Transition:
    """T13. Requests: import_id, staged_event_id, merge_job_id."""
    unpublished = _old("staged_event_published_at").isNull()
    same_event = _old("staged_event_id").isNull() | (
        _old("staged_event_id") == _new("staged_event_id")
    )
    return Transition(
        checks=[
            (_old("import_id").isNotNull(), NOT_FOUND),
            (_old("status") == STAGED, NOT_STAGED),
            (same_event, STAGED_EVENT_MISMATCH),
        ],
        checks_before_settled=1,
        settled=_old("status") == COMPLETED,
        changes={
            "status": F.lit(COMPLETED),
            "merge_job_id": _new("merge_job_id"),
            "merge_job_status": F.lit(SUCCEEDED),
            "processed_staged_event_id": _new("staged_event_id"),
            "staged_event_id": F.when(unpublished, _new("staged_event_id")).otherwise(
                _old("staged_event_id")
            ),
            "staged_event_published_at": F.coalesce(
                _old("staged_event_published_at"), as_of
            ),
            "completed_at": as_of,
            "technical_error": F.lit(None),
            "updated_at": as_of,
        },
    )


def completed_event_published(as_of: Column) -> Transition:
    """T14. Requests: import_id, event_id."""
    published = _old("completed_event_published_at").isNotNull()
    same_event = ~published | (_old("completed_event_id") == _new("event_id"))
    return Transition(
        checks=[
            (_old("status") == COMPLETED, NOT_COMPLETED),
            (same_event, COMPLETED_EVENT_MISMATCH),
        ],
        checks_before_settled=2,
        settled=published,
        changes={
            "completed_event_id": _new("event_id"),
            "completed_event_published_at": as_of,
            "updated_at": as_of,
        },
    )


def unpublished_staged(runs: DataFrame) -> DataFrame:
    """Staged runs whose event is not recorded as published."""
    return runs.where(
        (F.col("status") == STAGED) & F.col("staged_event_published_at").isNull()
    )


def unpublished_completed(runs: DataFrame) -> DataFrame:
    """Completed runs whose event is not recorded as published."""
    return runs.where(
        (F.col("status") == COMPLETED) & F.col("completed_event_published_at").isNull()
    )


def unfinished(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Files whose import has not reached a terminal state."""
    done = runs.where(F.col("status").isin(*TERMINAL)).select("import_id")
    return files.join(done, "import_id", "left_anti")
