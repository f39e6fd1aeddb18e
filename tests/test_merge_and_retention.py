from datetime import date, datetime

from pyspark.sql import functions as F

from rowgate.operators import reconcile, retention, upsert
from rowgate.sources import tables
from rowgate.session import scratch_path

T0, T1 = datetime(2026, 1, 1), datetime(2026, 2, 1)


def merged(spark, target, source):
    t = spark.createDataFrame(
        [(*row, T0, T0) for row in target],
        "record_id string, x string, source_row_number bigint, created_at timestamp, updated_at timestamp",
    )
    s = spark.createDataFrame(source, "record_id string, x string, source_row_number bigint")
    return upsert.upsert(t, s, "record_id", ["x", "source_row_number"], F.lit(T1))


def test_update_insert_keep(spark):
    out = merged(
        spark, [("a", "old", 1), ("b", "stay", 2)], [("a", None, 5), ("c", "new", 6)]
    )
    got = {r.record_id: tuple(r)[1:] for r in out.collect()}
    assert got == {
        "a": (None, 5, T0, T1, "update"),
        "b": ("stay", 2, T0, T0, "keep"),
        "c": ("new", 6, T1, T1, "insert"),
    }
    assert tuple(upsert.affected_rows(out).first()) == (1, 1, 2)


def test_last_row_of_an_import_then_last_import_wins(spark):
    staging = spark.createDataFrame(
        [("r", "i1", 9, 1), ("r", "i2", 2, 2), ("r", "i2", 3, 2), ("s", "i1", 4, 1)],
        "record_id string, source_import_id string, source_row_number bigint, arrival int",
    )
    got = upsert.merge_source(staging, arrival=["arrival"]).collect()
    assert {(r.record_id, r.source_import_id, r.source_row_number) for r in got} == {
        ("r", "i2", 3), ("s", "i1", 4),
    }
    one = upsert.rows_of_imports(staging, spark.createDataFrame([("i1",)], "source_import_id string"))
    assert one.count() == 2


def test_a_job_runs_once(spark):
    events = spark.createDataFrame([("i1", "e1"), ("i1", "e1"), ("i2", "e2")], "import_id string, event_id string")
    done = spark.createDataFrame([("job-e2",), (None,)], "merge_job_id string")
    job = F.concat(F.lit("job-"), "event_id")
    assert [r.event_id for r in upsert.not_yet_merged(events, done, job).collect()] == ["e1"]


def test_reconcile_counts_absent_imports_as_zero(spark):
    events = spark.createDataFrame([("i1", 2), ("i2", 0), ("i3", 1)], "import_id string, valid_row_count bigint")
    staging = spark.createDataFrame([("i1",), ("i1",), ("zz",)], "source_import_id string")
    got = {r.import_id: (r.staging_row_count, r.matches) for r in reconcile.reconcile(events, staging).collect()}
    assert got == {"i1": (2, True), "i2": (0, True), "i3": (0, False)}


def layout(spark):
    return tables.TableLayout(
        scratch_path(spark, "table"), "v int, k string", (("month", "string"),), ("k",)
    )


def put(spark, *rows):
    return spark.createDataFrame(rows, "v int, k string, month string")


def content(spark, table):
    return sorted((r.month, r.k, r.v) for r in tables.read_table(spark, table).collect())


def test_replacing_partitions_leaves_the_others_alone(spark):
    table = layout(spark)
    assert content(spark, table) == []
    tables.replace_load(put(spark, (1, "a", "2026-01"), (2, "b", "2026-02")), table)
    current = tables.read_table(spark, table)
    changed = current.where("month = '2026-02'").withColumn("v", F.col("v") + 10)
    tables.replace_partitions(changed, table, scratch_path(spark, "pending"))
    assert content(spark, table) == [("2026-01", "a", 1), ("2026-02", "b", 12)]


def test_a_lost_replacement_is_finished(spark):
    table, root = layout(spark), scratch_path(spark, "pending")
    tables.replace_load(put(spark, (1, "a", "2026-01"), (2, "b", "2026-02")), table)
    (put(spark, (9, "b", "2026-02")).write.partitionBy("month").parquet(f"{root}/complete"))
    (put(spark, (7, "a", "2026-01")).write.partitionBy("month").parquet(f"{root}/broken"))
    tables.drop_path(spark, f"{root}/broken/_SUCCESS")
    # The writer was lost after it had removed the old partition.
    tables.drop_path(spark, f"{table.path}/month=2026-02")
    tables.recover_partitions(spark, table, root)
    assert content(spark, table) == [("2026-01", "a", 1), ("2026-02", "b", 9)]
    assert not tables.exists(spark, f"{root}/complete") and not tables.exists(spark, f"{root}/broken")


def test_only_touched_partitions_are_read(spark):
    table = layout(spark)
    tables.replace_load(put(spark, (1, "a", "2026-01"), (2, "b", "2026-02")), table)
    changes = put(spark, (5, "z", "2026-02")).persist()  # as a merge batch has them
    touched = tables.touched_partitions(tables.read_table(spark, table), changes, "month")
    assert [r.k for r in touched.collect()] == ["b"]
    changes.unpersist()
    scan = touched._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numPartitions").value() == 1
    assert scan.metrics().apply("numFiles").value() == 1


def test_retention_boundary(spark):
    as_of = F.lit(datetime(2026, 1, 10)).cast("timestamp_ntz")
    days = spark.createDataFrame([(date(2026, 1, d),) for d in (2, 3, 4)], "day date")
    kept = retention.expire_partitions(days, "day", 7, as_of)
    assert [r.day.day for r in kept.collect()] == [4]
    assert sorted(r.day.day for r in retention.expired_days(days, "day", 7, as_of).collect()) == [2, 3]


def test_expired_day_partitions_are_dropped(spark):
    table = tables.TableLayout(
        scratch_path(spark, "table"), "v int", (("day", "date"), ("load", "string"))
    )
    rows = spark.createDataFrame(
        [(1, date(2026, 1, 1), "l"), (2, date(2026, 1, 9), "l")], "v int, day date, load string"
    )
    tables.append_log(rows, table)
    as_of = F.lit(datetime(2026, 1, 10))
    assert tables.drop_expired_days(spark, table, 7, as_of) == ["2026-01-01"]
    assert [r.v for r in tables.read_table(spark, table).collect()] == [2]
