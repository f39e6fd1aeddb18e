"""Content-derived identifiers (F1-F5). Equal input always gives the equal id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowgate.functions.text import blank_to_null


def digest(separator: str, *parts: Column) -> Column:
    """SHA-256 hex of the joined parts; null as soon as one part is null."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(separator), part)
    return F.sha2(joined, 256)


def import_id(bucket: Column, object_name: Column, generation: Column) -> Column:
    return digest("\n", bucket, object_name, generation)


def record_id(*identity: Column) -> Column:
    """Hash of the trimmed identity fields; null when any of them is blank."""
    return digest("\n", *(blank_to_null(part) for part in identity))


def event_id(event_type: str, import_id: Column) -> Column:
    """Stable over retries: the time of the event is not part of its id."""
    return digest("|", F.lit(event_type), import_id)


def merge_job_id(staged_event_id: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.sha2(staged_event_id, 256))


def load_job_id(prefix: str, import_id: Column, attempt: Column) -> Column:
    return F.concat_ws("-", F.lit(prefix), import_id, attempt.cast("string"))
