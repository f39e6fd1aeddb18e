"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A shard follows from a key and the number of shards alone: no ring table, no
state. When a shard is appended, a key either stays or moves to the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.llm.frames import read, text_of, written

# The generator of the published algorithm.
MULTIPLIER = 2862933555777941757
INCREMENT = 1

SHARDS = 24
# Rows of one shard that are numbered together by one task.
ROWS_PER_RANGE = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every unsigned 64-bit key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(active):
            shard[active] = target[active]
            state[active] = state[active] * np.uint64(MULTIPLIER) + np.uint64(INCREMENT)
            step = float(1 << 31) / ((state[active] >> np.uint64(33)).astype(np.float64) + 1.0)
            target[active] = ((shard[active] + 1) * step).astype(np.int64)
            active = active[target[active] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key: its text is hashed with MD5, then jumps.

    A null key is hashed as the empty text. Repeated keys share a shard.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))

    def half(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")

    @F.pandas_udf("int")
    def place(high: pd.Series, low: pd.Series) -> pd.Series:
        keys = (high.to_numpy(np.uint64) << np.uint64(32)) | low.to_numpy(np.uint64)
        return pd.Series(jump(keys, shards).astype(np.int32))

    return place(half(1), half(9))


def numbered(rows: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Gapless positions from 0 inside every shard, without one task a shard.

    A shard is cut into hash ranges of about ``ROWS_PER_RANGE`` rows; a range
    starts after the rows of the ranges before it. Rows are written with a number of
    their own first, which spreads equal ones over the ranges too.
    """
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ranges = rows.count() // ROWS_PER_RANGE + 1
    order = [*order, "_row"]
    part = F.pmod(F.xxhash64(*order), F.lit(ranges))
    rows = rows.withColumn("_range", part)
    before = W.partitionBy(shard).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy(shard, "_range").agg(F.count("*").alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inside = F.row_number().over(W.partitionBy(shard, "_range").orderBy(*order)) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(starts, [shard, "_range"])
        .withColumn(slot, (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_range", "_inside", "_start", "_row")
    )


def assign(docs: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    """``docs`` plus ``shard``; narrow, so nothing is shuffled.

    A column ``shard`` of the input gives way to the new one.
    """
    kept = [c for c in docs.columns if c.lower() != "shard"]
    return docs.withColumn("_shard", shard_of(F.col(f"`{key}`"), shards)).select(
        *(F.col(f"`{c}`") for c in kept), F.col("_shard").alias("shard")
    )


def op7_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard out of 24, and out of 25 after one is appended.

    Law ``key``. A null text has no bytes and the checksum of the empty text; a
    null doc_id is a key like any other; repeated rows share a shard and get
    slots of their own; an empty table gives no rows.
    """
    docs = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    placed = assign(docs, "doc_id").withColumn("grown_shard", shard_of(F.col("doc_id"), SHARDS + 1))
    return numbered(placed, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


QUERIES = {"op7_jump_sharding": op7_jump_sharding}
# CRC-32 is no function of the SQL engine; tests hold the query to brute force.
SQL: dict[str, str] = {}
