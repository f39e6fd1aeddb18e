import time

from pyspark.sql import functions as F

from rowgate.llm.frames import written

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    rows = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("key"))
    both = rows.groupBy("key").agg(F.min("id").alias("first")).join(rows.hint("merge"), "key")
    table = written(both, "keys")
    for _ in range(100):  # Spark deletes them in the background.
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    # The frame can be used again, and other queries keep their files as they did.
    assert table.count() == both.count() == written(both, "again").count() == 5000
    assert spark.conf.get(CLEANUP) == setting
