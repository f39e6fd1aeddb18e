"""Day-partition expiry of the staging table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_expired(day: Column, days: int, as_of: Column) -> Column:
    """A partition lives for ``days`` from the start of its day."""
    return F.date_add(day, days).cast("timestamp_ntz") <= as_of.cast("timestamp_ntz")


def expire_partitions(df: DataFrame, day: str, days: int, as_of: Column) -> DataFrame:
    """Rows whose day partition is still alive; prunes partitions when partitioned."""
    return df.where(~is_expired(F.col(day), days, as_of))


def expired_days(df: DataFrame, day: str, days: int, as_of: Column) -> DataFrame:
    """The day partitions to drop."""
    return df.select(day).distinct().where(is_expired(F.col(day), days, as_of))
