"""What the operators share: reading tables, durable cuts, checked broadcasts."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.session import checkpoint_root, shuffles_dropped

# A row of the small frames joined here takes under 1 KB, so a broadcast stays
# below 20 MB. Larger frames are joined by shuffle.
BROADCAST_ROWS = 20_000


_SHIPPED: set[str] = set()
# Rows of an Arrow batch. Rows here hold whole texts or packed arrays, and a Python
# task has a few hundred megabytes.
BATCH_ROWS = "512"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, and bound batches.

    Python tasks import the operators' helpers by name. Spark copies the archive to
    every executor, so nothing has to be installed there.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rowgate-package-")) / "rowgate_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run(spark, ...)`` after ``ship(spark)``."""

    @functools.wraps(run)
    def start(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return run(spark, *rest)

    return start


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_root(spark)}/rowgate-llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut.

    Only committed task attempts are part of the table, so a lost executor costs
    the tasks it was running and nothing that is already written. The shuffle files
    behind the table are deleted with the end of the writing.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with shuffles_dropped(spark):
        df.write.option("compression", codec).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def drop_written(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned and that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def joined(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a broadcast only when ``right``, counted, is small.

    ``right`` should be written or cheap to count. Beyond the limit the join
    shuffles both sides, and Spark splits skewed partitions.
    """
    few = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if few else right, on, how)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the given columns; columns of these names in ``df`` give way."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *(c.alias(name) for name, c in columns.items()))
