"""Declared against actual staging counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def staged_counts(staging: DataFrame) -> DataFrame:
    """Staged rows per import; counted on the map side first."""
    return staging.groupBy(F.col("source_import_id").alias("import_id")).agg(
        F.count("*").alias("staging_row_count")
    )


def reconcile(events: DataFrame, staging: DataFrame) -> DataFrame:
    """Staged events plus the actual count (0 when nothing is there) and ``matches``.

    Counted before joined: an import of any size reaches the join as one row.
    """
    actual = F.coalesce("staging_row_count", F.lit(0).cast("bigint"))
    return events.join(staged_counts(staging), "import_id", "left").select(
        *events.columns,
        actual.alias("staging_row_count"),
        (actual == F.col("valid_row_count")).alias("matches"),
    )
