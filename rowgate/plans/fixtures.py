"""Inputs the registered queries run on, derived by Spark from the given tables.

``readings`` turns every order into one line of a meter-reading file, some of
them damaged. Files hold at most 1,000 lines, so the number of imports grows
with the table while no import does. Order keys are dense from 0, which makes
the line number arithmetic: no window, one narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate import energy
from rowgate.session import spread

LINES_PER_FILE = 1000
FILES_PER_DROP = 4
BUCKET = "testdata"
GENERATION = "1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(cents: str) -> str:
    return f"concat({cents} div 100, '.', lpad(cast(({cents}) % 100 as string), 2, '0'))"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import identity, line number and the CSV fields as text."""
    drop = LINES_PER_FILE * FILES_PER_DROP
    base = spread(
        table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey as k",
            "o_custkey as c",
            "o_orderdate as d",
            "cast(round(o_totalprice * 100) as bigint) as cents",
        )
    )
    split = base.selectExpr(
        "*",
        "cents * 60 div 100 as g",
        "cents - cents * 60 div 100 as e",
        "k % 500 as u",
        f"concat('orders-', k div {drop}, '-', k % {FILES_PER_DROP}, '.csv') as object_name",
    )
    return split.selectExpr(
        "k",
        "object_name",
        f"sha2(concat('{BUCKET}', '\\n', object_name, '\\n', '{GENERATION}'), 256) as import_id",
        f"2 + k % {drop} div {FILES_PER_DROP} as source_row_number",
        "case when k % 101 = 0 then '   ' else concat(' c-', c, ' ') end as meter_id",
        """case when k % 103 = 0 then '2026-02-30' when k % 107 = 0 then '01/06/2026'
                when k % 109 = 0 then '' else date_format(trunc(d, 'MM'), 'yyyy-MM-dd')
           end as period_start""",
        """case when k % 113 = 0 then '1990-01-31'
                else date_format(last_day(d), 'yyyy-MM-dd') end as period_end""",
        "cast(k as string) as reading_start_kwh",
        "case when k % 137 = 0 then '0' else cast(k + u as string) end as reading_end_kwh",
        """case when k % 127 = 0 then cast(u + 1 as string) when k % 131 = 0 then 'abc'
                else concat(u, '.0') end as consumption_kwh""",
        "case when k % 3 = 0 then '' else cast(12 * u as string) end as estimated_annual_kwh",
        "case when k % 5 = 0 then '' else concat('SE', 1 + k % 4) end as grid_area",
        f"""case when k % 7 = 0 then '' else {_money('(g * 50 div 100)')}
            end as subscription_cost_sek""",
        f"{_money('(g * 20 div 100)')} as transmission_cost_sek",
        f"{_money('(g * 10 div 100)')} as energy_tax_sek",
        f"{_money('(g - g * 50 div 100 - g * 20 div 100 - g * 10 div 100)')} as grid_vat_sek",
        f"{_money('g')} as grid_total_sek",
        f"{_money('(e * 60 div 100)')} as electricity_cost_sek",
        f"{_money('(e * 20 div 100)')} as electricity_annual_fee_sek",
        f"{_money('(e - e * 60 div 100 - e * 20 div 100)')} as electricity_vat_sek",
        f"{_money('e')} as electricity_total_sek",
        f"""case when k % 151 = 0 then '-1' when k % 157 = 0 then '12.345'
                 when k % 149 = 0 then {_money('(cents + 2)')}
                 when k % 139 = 0 then {_money('(cents + 1)')}
                 else {_money('cents')} end as total_cost_sek""",
    )


def import_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file of ``readings``."""
    return (
        readings(spark, sf_dir)
        .select("import_id", "object_name")
        .distinct()
        .select(
            "import_id",
            F.lit(BUCKET).alias("bucket_name"),
            "object_name",
            F.lit(GENERATION).alias("object_generation"),
        )
    )


def csv_files(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    """Each file of ``readings`` as CSV text, one row per file.

    Gathering a file is bounded: at most ``LINES_PER_FILE`` lines share a name.
    With ``damaged``, some lines lose or gain a field, some hold quotes, commas
    and line breaks, and every fourth file has its columns in another order.
    """
    rows = readings(spark, sf_dir)
    fields = list(energy.CSV_FIELDS)
    swapped = list(reversed(fields))

    def line(order: list[str], area) -> Column:
        return F.concat_ws(
            ",", *(area if name == "grid_area" else F.col(name) for name in order)
        )

    area = F.col("grid_area")
    if damaged:
        area = F.when(
            F.col("k") % 173 == 0,
            F.concat(F.lit('"'), F.col("grid_area"), F.lit(', ""x""\r\nb"')),
        ).otherwise(area)
    backwards = F.col("object_name").endswith("-3.csv") & F.lit(damaged)

    def either(cut: int) -> Column:
        return F.when(backwards, line(swapped[:cut], area)).otherwise(
            line(fields[:cut], area)
        )

    text = either(len(fields))
    if damaged:
        text = (
            F.when(F.col("k") % 163 == 0, either(len(fields) - 1))
            .when(F.col("k") % 167 == 0, F.concat(text, F.lit(",surplus")))
            .otherwise(text)
        )
    header = F.when(backwards, F.lit(",".join(swapped))).otherwise(
        F.lit(",".join(fields))
    )
    lines = rows.select(
        "import_id", "object_name", "source_row_number", text.alias("line"),
        header.alias("header"),
    )
    return (
        lines.groupBy("import_id", "object_name")
        .agg(
            F.first("header").alias("header"),
            F.array_sort(F.collect_list(F.struct("source_row_number", "line"))).alias(
                "lines"
            ),
        )
        .select(
            "import_id",
            F.lit(BUCKET).alias("bucket_name"),
            "object_name",
            F.lit(GENERATION).alias("object_generation"),
            F.concat_ws("\n", "header", F.col("lines.line")).alias("text"),
        )
        .withColumn("size_bytes", F.octet_length("text").cast("bigint"))
    )


AS_OF = "2026-01-01 00:00:00"
MERGED_AT = "2026-02-01 00:00:00"
RUN_STATES = 12

# D2, one run per customer; the text runs in Spark and, for checking, elsewhere.
# {sha} is the engine's SHA-256 function call with an open bracket, {end} its end.
RUNS_SQL = """
select {sha}concat('testdata', chr(10), 'customer-', c_custkey, '.csv', chr(10), '1'){end} as import_id,
       concat('event-', c_custkey) as event_id,
       'testdata' as bucket_name,
       concat('customer-', c_custkey, '.csv') as object_name,
       '1' as object_generation,
       c_custkey * 1000 as size_bytes,
       case when s in (1, 2, 11) then 'PROCESSING' when s in (3, 4, 5) then 'FAILED_TECHNICAL'
            when s in (6, 7) then 'STAGED' when s in (8, 9) then 'COMPLETED'
            else 'REJECTED_DATA' end as status,
       c_custkey % 4 as attempt_number,
       concat('owner-', c_custkey % 2) as owner_id,
       case when s = 2 then timestamp '2025-12-31 23:55:00'
            when c_custkey % 7 = 0 then null
            else timestamp '2026-01-01 00:05:00' end as lease_expires_at,
       case when c_custkey % 5 = 0 then null else concat('old-staging-', c_custkey) end as staging_job_id,
       case when s in (3, 6, 7, 8, 9, 11) then 'SUCCEEDED' when s = 4 then 'FAILED'
            else 'PENDING' end as staging_job_status,
       case when c_custkey % 5 = 1 then null else concat('old-errors-', c_custkey) end
           as validation_errors_job_id,
       case when s in (6, 7, 8, 9, 11) then 'SUCCEEDED' when s = 3 then 'FAILED'
            else 'PENDING' end as validation_errors_job_status,
       case when s in (3, 4, 5) then 'boom' end as technical_error,
       timestamp '2025-12-01 00:00:00' as created_at,
       timestamp '2025-12-31 23:50:00' as updated_at,
       case when s in (6, 7, 8, 9) then c_custkey % 100 + c_custkey % 10 end as row_count,
       case when s in (6, 7, 8, 9) then c_custkey % 100 end as valid_row_count,
       case when s in (6, 7, 8, 9) then c_custkey % 10 end as invalid_row_count,
       case when s in (6, 8, 9) then concat('staged-', c_custkey) end as staged_event_id,
       case when s in (6, 8, 9) then timestamp '2025-12-31 23:51:00' end as staged_event_published_at,
       case when s in (8, 9) then concat('merge-', c_custkey) end as merge_job_id,
       case when s = 8 then concat('completed-', c_custkey) end as completed_event_id,
       case when s = 8 then timestamp '2025-12-31 23:52:00' end as completed_event_published_at,
       c_custkey as c,
       s
from (select c_custkey, c_custkey % 12 as s from {customer}) numbered
where s <> 0
"""


def import_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger before a request, all states and output combinations."""
    from rowgate.operators.ledger import LOG_COLUMNS

    runs = spark.sql(
        RUNS_SQL.replace("{sha}", "sha2(").replace("{end}", ", 256)"),
        customer=table(spark, sf_dir, "customer"),
    ).withColumn("version", F.lit(1))
    present = set(runs.columns)
    return runs.select(
        *(
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in LOG_COLUMNS
        ),
        "c",
        "s",
    )


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file event per customer; every tenth customer's event arrives twice."""
    events = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("c"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    ).where("copy = 0 or c % 10 = 0")
    return events.select(
        F.expr(
            "sha2(concat('testdata', chr(10), 'customer-', c, '.csv', chr(10), '1'), 256)"
        ).alias("import_id"),
        F.expr("concat('event-', c, '-', copy)").alias("event_id"),
        F.lit(BUCKET).alias("bucket_name"),
        F.expr("concat('customer-', c, '.csv')").alias("object_name"),
        F.lit(GENERATION).alias("object_generation"),
        (F.col("c") * 1000).alias("size_bytes"),
    )


# D3, one envelope per customer, damaged by key. First fitting damage counts.
DAMAGE_KINDS = 19


def message_envelopes(spark: SparkSession, sf_dir: str, completed: bool) -> DataFrame:
    """D3: bus messages; damage kind ``c % 19``, kinds above 16 are sound."""
    event_type = energy.COMPLETED_EVENT if completed else energy.STAGED_EVENT
    base = spread(
        table(spark, sf_dir, "customer").selectExpr("c_custkey as c", "c_custkey % 19 as d")
    )
    extra = (
        """'"stagedEventId":"s-', c, '","mergeJobId":"m-', c, '",',""" if completed else ""
    )
    payload = f"""
      case when d = 1 then '{{not json' when d = 2 then '[1,2]' else concat(
        '{{"eventId":', case when d = 3 then '7' else concat('"e-', c, '"') end,
        ',"eventType":"', case when d = 4 then 'OtherEvent' else '{event_type}' end,
        '","occurredAt":"2026-01-01T00:00:00.000Z",',
        case when d = 5 then '' else concat('"importId":"i-', c, '",') end,
        {extra}
        '"bucketName":"testdata","objectName":"', case when d = 6 then '' else concat('f-', c, '.csv') end,
        '","objectGeneration":"1","rowCount":',
        case when d = 7 then '"5"' when d = 8 then concat(c + 3, '.0') when d = 9 then '1.5' else cast(c + 3 as string) end,
        ',"validRowCount":', c + 1, ',"invalidRowCount":', case when d = 10 then '-1' else '2' end, '}}') end"""
    attributes = f"""
      case when d = 11 then '"attributes":{{"eventId":"other"}},'
           when d = 12 then '"attributes":{{"eventId":5}},'
           when d = 13 then '"attributes":null,'
           when d = 14 then '"attributes":{{"eventType":"OtherEvent"}},'
           when d = 17 then ''
           else concat('"attributes":{{"eventId":"e-', c, '","eventType":"{event_type}"}},') end"""
    whole = base.selectExpr("c", "d", f"{payload} as payload", f"{attributes} as attributes")
    return whole.selectExpr(
        f"""case when d = 15 then map('ce-type', '{energy.MESSAGE_TRANSPORT}')
                 when d = 16 then map('ce-id', concat('ce-', c), 'ce-type', 'other')
                 else map('ce-id', concat('ce-', c), 'ce-type', '{energy.MESSAGE_TRANSPORT}')
            end as headers""",
        """concat('{"message":{', attributes, '"messageId":"msg-', c, '","data":"',
                  replace(base64(cast(payload as binary)), '\\r\\n', ''), '"}}') as body""",
    )


def storage_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-finalised events, one per customer; damage kind ``c % 11``."""
    base = table(spark, sf_dir, "customer").selectExpr("c_custkey as c", "c_custkey % 11 as d")
    return base.selectExpr(
        f"""case when d = 1 then map('ce-id', concat('ce-', c), 'ce-type', 'other')
                 when d = 2 then map('ce-type', '{energy.STORAGE_EVENTS.transport_type}')
                 else map('ce-id', concat('ce-', c), 'ce-type', '{energy.STORAGE_EVENTS.transport_type}')
            end as headers""",
        """case when d = 3 then '{"name"' when d = 4 then '[]' else concat(
             '{"bucket":"testdata",',
             case when d = 5 then '' else concat('"name":"customer-', c, '.csv",') end,
             '"generation":', case when d = 6 then '1' else '"1"' end, ',"size":',
             case when d = 7 then '-1' when d = 8 then '"abc"' when d = 9 then concat('"', c * 1000, '"')
                  when d = 10 then '""' else cast(c * 1000 as string) end, '}') end as body""",
    )
