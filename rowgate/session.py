"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# The JVM does not compile methods above 8,000 bytes of code, and a rule set
# fused into one generated method is larger. Below this limit Spark keeps such a
# stage as separate projections whose code it splits into small methods.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Spark lists folders in up to 10,000 tasks, one a folder. Starting a task takes
    # longer than listing a folder, so few tasks list many folders each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
STARTUP_SETTINGS = {
    # Stream state, such as the ids of weeks of events, belongs on disk, not in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **RUNTIME_SETTINGS,
}


def build_session(
    app_name: str = "rowgate", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the library wants; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change on a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer splits than there are cores.

    For CPU-heavy work on a small table. A scan with enough splits, and so every
    large one, is left alone and nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    On a cluster this is storage every executor can reach. Only a session that runs
    in one process may go without the setting: it gets a temporary folder.
    """
    key = "spark.checkpoint.dir"
    root = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(
                f"{key} must name a folder that driver and executors share; a temporary "
                f"folder of one machine will not do on {master}"
            )
        root = tempfile.mkdtemp(prefix="rowgate-")
        spark.conf.set(key, root)
    return root.rstrip("/")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is; else they stay until the
    driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{checkpoint_root(spark)}/rowgate/{label}-{uuid.uuid4().hex}"
