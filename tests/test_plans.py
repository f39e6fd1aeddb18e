"""What the physical plans must and must not contain."""

import pytest

from rowgate import energy
from rowgate.operators import csv_records as csv
from rowgate.plans import fixtures
from rowgate.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
BATCH = [name for name in REGISTRY if not name.startswith(("stream_", "partitioned_"))]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_rows_no_cross_joins(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


@pytest.mark.parametrize(
    "name", ["validate_rows", "error_rows", "staging_rows", "normalize_rows", "decode_staged_events"]
)
def test_row_work_shuffles_nothing_but_a_small_input(spark, name):
    exchanges = [line for line in plan(REGISTRY[name](spark, SF)).splitlines() if "Exchange" in line]
    assert len(exchanges) <= 1 and all("RoundRobin" in line for line in exchanges)


def test_csv_parsing_is_one_narrow_stage(spark):
    files = spark.createDataFrame([("i", "a,b\n1,2")], "import_id string, text string")
    text = plan(csv.with_named_fields(csv.csv_records(files, ["a"]), ["a"]))
    assert "Exchange" not in text and "Window" not in text


@pytest.mark.parametrize("name", ["dedup_latest", "dedup_latest_events", "import_summary"])
def test_top_rows_are_limited_before_the_shuffle(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    limit = text.rindex("WindowGroupLimit")
    assert "Exchange" in text[text.index("WindowGroupLimit") : limit]
    assert text.count("WindowGroupLimit") >= 2


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(REGISTRY["error_code_counts"](spark, SF))
    assert "partial_count" in text


def test_merge_shuffles_each_side_once(spark):
    text = plan(REGISTRY["upsert_records"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 2
    assert "FullOuter" in text


def test_only_needed_columns_are_read(spark):
    text = plan(fixtures.readings(spark, SF).select("k", "meter_id"))
    schema = text[text.index("ReadSchema") :].splitlines()[0]
    assert "o_custkey" in schema and "o_totalprice" not in schema and "o_orderpriority" not in schema


def test_partition_filters_reach_the_scan(spark):
    text = plan(REGISTRY["partitioned_layout"](spark, SF).where("period_month >= '1996-01'"))
    filters = text[text.index("PartitionFilters") :].splitlines()[0]
    assert "1996-01" in filters
    assert "record_id" not in text[text.index("ReadSchema") :].splitlines()[0]


def test_rules_stay_out_of_the_filter(spark):
    from rowgate.operators import rules

    checked = rules.validate(fixtures.readings(spark, SF), energy.RULES)
    text = plan(rules.valid_rows(checked).select("k"))
    assert text.count("must use YYYY-MM-DD") == 2  # one message per date field
