"""Merge without a transactional table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowgate.operators.dedup import latest_per_key

INSERT = "insert"
UPDATE = "update"
KEEP = "keep"


def rows_of_imports(staging: DataFrame, imports: DataFrame) -> DataFrame:
    """Staging rows of the given imports (column ``source_import_id``)."""
    ids = imports.select("source_import_id").distinct()
    return staging.join(ids, "source_import_id", "left_semi")


def merge_source(
    staging: DataFrame,
    key: str = "record_id",
    arrival: Sequence[str] = (),
    row_number: str = "source_row_number",
) -> DataFrame:
    """W1 over one or many imports: exactly one row per key.

    With several imports, ``arrival`` orders them as if they were merged one
    after the other: the last import wins, inside it the last row.
    """
    return latest_per_key(staging, [key], [*arrival, row_number])


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update_columns: Sequence[str],
    as_of: Column,
) -> DataFrame:
    """The merged table plus ``action``.

    One full outer join, unique keys on both sides, so no key can be hot. A
    matched row takes every source value, nulls included, and keeps its
    ``created_at``; target rows without a match stay as they are.
    """
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_target = F.col(f"t.{key}").isNotNull()
    in_source = F.col(f"s.{key}").isNotNull()
    return joined.select(
        F.coalesce(f"s.{key}", f"t.{key}").alias(key),
        *(
            F.when(in_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in update_columns
        ),
        F.coalesce(F.col("t.created_at"), as_of).alias("created_at"),
        F.when(in_source, as_of).otherwise(F.col("t.updated_at")).alias("updated_at"),
        F.when(in_source & in_target, UPDATE)
        .when(in_source, INSERT)
        .otherwise(KEEP)
        .alias("action"),
    )


def affected_rows(merged: DataFrame) -> DataFrame:
    """A3: inserted, updated and affected row counts of a merge."""
    inserted = F.count_if(F.col("action") == INSERT)
    updated = F.count_if(F.col("action") == UPDATE)
    return merged.agg(
        inserted.alias("inserted"),
        updated.alias("updated"),
        (inserted + updated).alias("affected"),
    )


def observed(merged: DataFrame, observation: Observation) -> DataFrame:
    """``merged``, which tells ``observation`` its inserted, updated and affected rows while
    it is written: the counts take no pass of their own (A3).

    A stage that is run again, because an executor with its output was lost, is counted
    again, so these are figures for the log and decide nothing.
    """
    inserted = F.count_if(F.col("action") == INSERT)
    updated = F.count_if(F.col("action") == UPDATE)
    return merged.observe(
        observation,
        inserted.alias("inserted"),
        updated.alias("updated"),
        (inserted + updated).alias("affected"),
    )


def not_yet_merged(
    events: DataFrame, merged_jobs: DataFrame, merge_job_id: Column
) -> DataFrame:
    """M4: staged events, one per merge job, whose job has not run yet."""
    jobs = events.withColumn("merge_job_id", merge_job_id)
    once = latest_per_key(jobs, ["merge_job_id"], ["event_id"])
    return once.join(
        merged_jobs.select("merge_job_id").where("merge_job_id is not null").distinct(),
        "merge_job_id",
        "left_anti",
    )
