"""The registered queries as plain SQL for an independent engine.

Written from the rules, not from the Spark expressions; only the input fixtures
are shared in meaning. Every statement runs over whole tables.
"""

from __future__ import annotations

from rowgate import energy
from rowgate.plans.fixtures import DAMAGE_KINDS, RUNS_SQL

FIELDS = energy.CSV_FIELDS
T0 = "TIMESTAMP '2026-01-01 00:00:00'"
T1 = "TIMESTAMP '2026-02-01 00:00:00'"


def _money(x: str) -> str:
    return f"concat(({x}) // 100, '.', lpad(cast(({x}) % 100 as varchar), 2, '0'))"


READINGS = f"""
base as (
  select o_orderkey as k, o_custkey as c, o_orderdate as d,
         cast(round(o_totalprice * 100) as bigint) as cents from orders),
split as (
  select *, cents * 60 // 100 as g, cents - cents * 60 // 100 as e, k % 500 as u,
         concat('orders-', k // 4000, '-', k % 4, '.csv') as object_name from base),
readings as (
  select k, object_name,
    sha256(concat('testdata', chr(10), object_name, chr(10), '1')) as import_id,
    2 + (k % 4000) // 4 as source_row_number,
    case when k % 101 = 0 then '   ' else concat(' c-', c, ' ') end as meter_id,
    case when k % 103 = 0 then '2026-02-30' when k % 107 = 0 then '01/06/2026'
         when k % 109 = 0 then '' else strftime(date_trunc('month', d), '%Y-%m-%d') end as period_start,
    case when k % 113 = 0 then '1990-01-31' else strftime(last_day(d), '%Y-%m-%d') end as period_end,
    cast(k as varchar) as reading_start_kwh,
    case when k % 137 = 0 then '0' else cast(k + u as varchar) end as reading_end_kwh,
    case when k % 127 = 0 then cast(u + 1 as varchar) when k % 131 = 0 then 'abc'
         else concat(u, '.0') end as consumption_kwh,
    case when k % 3 = 0 then '' else cast(12 * u as varchar) end as estimated_annual_kwh,
    case when k % 5 = 0 then '' else concat('SE', 1 + k % 4) end as grid_area,
    case when k % 7 = 0 then '' else {_money('g * 50 // 100')} end as subscription_cost_sek,
    {_money('g * 20 // 100')} as transmission_cost_sek,
    {_money('g * 10 // 100')} as energy_tax_sek,
    {_money('g - g * 50 // 100 - g * 20 // 100 - g * 10 // 100')} as grid_vat_sek,
    {_money('g')} as grid_total_sek,
    {_money('e * 60 // 100')} as electricity_cost_sek,
    {_money('e * 20 // 100')} as electricity_annual_fee_sek,
    {_money('e - e * 60 // 100 - e * 20 // 100')} as electricity_vat_sek,
    {_money('e')} as electricity_total_sek,
    case when k % 151 = 0 then '-1' when k % 157 = 0 then '12.345'
         when k % 149 = 0 then {_money('cents + 2')} when k % 139 = 0 then {_money('cents + 1')}
         else {_money('cents')} end as total_cost_sek
  from split)"""

NORMAL = ",\nnormal as (select k, object_name, import_id, source_row_number, " + ", ".join(
    f"nullif(trim({f}, ' '), '') as {f}" for f in FIELDS
) + " from {rows})"


def _date(f: str) -> str:
    return (
        f"case when regexp_full_match({f}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"and year(try_cast({f} as date)) >= 100 then try_cast({f} as date) end"
    )


def _number(f: str) -> str:
    return (
        f"case when regexp_full_match({f}, '[0-9]+([.][0-9]+)?') "
        f"and isfinite(try_cast({f} as double)) then cast({f} as double) end"
    )


def _minor(f: str) -> str:
    return (
        f"case when regexp_full_match({f}, '[0-9]+([.][0-9]{{1,2}})?') "
        f"then cast(split_part({f}, '.', 1) as double) * 100 "
        f"+ cast(rpad(split_part({f}, '.', 2), 2, '0') as double) end"
    )


DATES = ("period_start", "period_end")
NUMBERS = ("reading_start_kwh", "reading_end_kwh", "consumption_kwh", "estimated_annual_kwh")
REQUIRED_MONEY = ("grid_total_sek", "electricity_total_sek", "total_cost_sek")
OPTIONAL_MONEY = (
    "subscription_cost_sek", "transmission_cost_sek", "energy_tax_sek", "grid_vat_sek",
    "electricity_cost_sek", "electricity_annual_fee_sek", "electricity_vat_sek",
)
TYPED = ",\ntyped as (select *, " + ", ".join(
    [f"{_date(f)} as v_{f}" for f in DATES]
    + [f"{_number(f)} as v_{f}" for f in NUMBERS]
    + [f"{_minor(f)} as v_{f}" for f in REQUIRED_MONEY + OPTIONAL_MONEY]
) + " from normal)"


def _messages() -> list[str]:
    out = ["case when meter_id is null then 'meter_id is required' end"]
    for f in DATES:
        out.append(
            f"case when {f} is null then '{f} is required' "
            f"when not regexp_full_match({f}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"then '{f} must use YYYY-MM-DD' "
            f"when v_{f} is null then '{f} must be a valid date' end"
        )
    out.append(
        "case when v_period_start > v_period_end "
        "then 'period_start must be on or before period_end' end"
    )
    for f in NUMBERS:
        required = f"'{f} is required'" if f != "estimated_annual_kwh" else "null"
        out.append(
            f"case when {f} is null then {required} "
            f"when not regexp_full_match({f}, '[0-9]+([.][0-9]+)?') "
            f"then '{f} must be a non-negative number' "
            f"when v_{f} is null then '{f} must be a finite number' end"
        )
    out.append(
        "case when v_reading_end_kwh < v_reading_start_kwh "
        "then 'reading_end_kwh must be at least reading_start_kwh' end"
    )
    out.append(
        "case when abs(v_reading_end_kwh - v_reading_start_kwh - v_consumption_kwh) > 0.001 "
        "then 'consumption_kwh must match the meter reading difference' end"
    )
    for f in REQUIRED_MONEY + OPTIONAL_MONEY:
        required = f"'{f} is required'" if f in REQUIRED_MONEY else "null"
        out.append(
            f"case when {f} is null then {required} when v_{f} is null "
            f"then '{f} must be a non-negative SEK amount with max 2 decimals' end"
        )
    for total, parts in (
        ("grid_total_sek", OPTIONAL_MONEY[:4]),
        ("electricity_total_sek", OPTIONAL_MONEY[4:]),
        ("total_cost_sek", ("grid_total_sek", "electricity_total_sek")),
    ):
        summed = " + ".join(f"v_{p}" for p in parts)
        out.append(
            f"case when abs(v_{total} - ({summed})) > 1 "
            f"then '{total} does not match its cost components' end"
        )
    return out


CHECKED = ",\nchecked as (select *, concat_ws('; ', " + ", ".join(_messages()) + ") as errors from typed)"


def _checked(rows: str = "readings", readings: str = READINGS) -> str:
    return f"with {readings}{NORMAL.replace('{rows}', rows)}{TYPED}{CHECKED}"


CODE = """case when error_message = 'INVALID_COLUMN_COUNT' then 'INVALID_COLUMN_COUNT'
  when error_message like '% is required' then 'REQUIRED_FIELD'
  when error_message like '%date%' or error_message like 'period\\_%' escape '\\' then 'INVALID_DATE'
  when error_message like '%cost components%' then 'TOTAL_MISMATCH'
  when error_message like '%meter reading difference%' then 'CONSUMPTION_MISMATCH'
  when error_message like '%SEK amount%' then 'INVALID_MONEY'
  when error_message like '%number%' or error_message like '%finite%' then 'INVALID_NUMBER'
  else 'INVALID_VALUE' end"""


def _errors(checked: str) -> str:
    return f"""{checked},
exploded as (
  select k, import_id, source_row_number, unnest(string_split(errors, '; ')) as error_message
  from checked where errors <> ''),
coded as (
  select *, nullif(regexp_extract(error_message, '^([a-z][a-z0-9_]*)\\s', 1), '') as field_name,
         {CODE} as error_code from exploded),
errs as (
  select *, sha256(concat(import_id, '|', source_row_number, '|', coalesce(field_name, ''), '|',
                          error_code, '|', error_message)) as error_id from coded)"""


STAGED = _checked() + ",\nstaged as (select sha256(concat(meter_id, chr(10), period_start, chr(10), period_end)) as record_id, " + ", ".join(
    f"try_cast({name} as {kind}) as {name}" for name, kind, _ in energy.BUSINESS_COLUMNS
) + f", import_id as source_import_id, source_row_number, {T0} as ingested_at, object_name from checked where errors = '')"


def _plain(prefix: str = "") -> str:
    return ", ".join(
        f"cast({prefix}{name} as double) as {name}"
        if kind.startswith("decimal")
        else f"{prefix}{name} as {name}"
        for name, kind, _ in energy.BUSINESS_COLUMNS
    )


IMPORTS = """
files as (select distinct import_id, object_name from readings),
counts as (
  select import_id, count(*) as row_count, count(*) filter (errors = '') as valid_row_count,
         count(*) filter (errors <> '') as invalid_row_count from checked group by import_id)"""

MERGED = STAGED + f""",
target as (
  select * exclude (rn) from (
    select *, row_number() over (partition by record_id
      order by source_import_id desc, source_row_number desc) as rn
    from staged where object_name not like '%-3.csv') where rn = 1),
source as (
  select * exclude (rn) from (
    select *, row_number() over (partition by record_id
      order by source_import_id desc, source_row_number desc) as rn
    from staged where object_name like '%-3.csv') where rn = 1),
merged as (
  select s.*, case when t.record_id is null then {T1} else {T0} end as created_at,
         {T1} as updated_at, case when t.record_id is null then 'insert' else 'update' end as action
  from source s left join target t on s.record_id = t.record_id
  union all
  select t.*, {T0}, {T0}, 'keep' from target t
  where not exists (select 1 from source s where s.record_id = t.record_id))"""

# Rendered CSV: where each order's record ends up in its file, and as what.
CSV = READINGS + """,
rendered as (
  select *, case when k % 173 = 0 then concat(grid_area, ', "x"', chr(13), chr(10), 'b')
                 else grid_area end as area,
         case when k % 163 = 0 then -1 when k % 167 = 0 then 1 else 0 end as off,
         object_name like '%-3.csv' as backwards,
         1 + sum(1 + case when k % 173 = 0 then 1 else 0 end)
               over (partition by object_name order by k) as row_number
  from readings),
csv_lines as (
  select *, case when k % 173 = 0 then concat('"', grid_area, ', ""x""', chr(13), chr(10), 'b"')
                 else grid_area end as quoted from rendered)"""


def _line(order) -> str:
    cells = ", ".join("quoted" if f == "grid_area" else f for f in order)
    return f"concat_ws(',', {cells})"


def _cut_line(order) -> str:
    """The line as rendered after losing its last field; that field is never the quoted one."""
    kept = ", ".join("quoted" if f == "grid_area" else f for f in order[:-1])
    return f"concat_ws(',', {kept})"


BACKWARDS = tuple(reversed(FIELDS))
CSV_ROWS = CSV + f""",
csv_rows as (
  select *, case when backwards and off = -1 then {_cut_line(BACKWARDS)}
                 when off = -1 then {_cut_line(FIELDS)}
                 when backwards then concat({_line(BACKWARDS)}, case when off = 1 then ',surplus' else '' end)
                 else concat({_line(FIELDS)}, case when off = 1 then ',surplus' else '' end) end as raw
  from csv_lines)"""

# The rendered rows in the shape the rule statements expect.
CSV_CHECKED = (
    "with " + CSV_ROWS + ",\nas_read as (select k, object_name, import_id, row_number as source_row_number, "
    + ", ".join("area as grid_area" if f == "grid_area" else f for f in FIELDS)
    + " from csv_rows where off = 0)"
    + NORMAL.replace("{rows}", "as_read") + TYPED + CHECKED.replace("checked as", "fully_checked as")
    + """,
checked as (
  select k, import_id, source_row_number, errors from fully_checked
  union all
  select k, import_id, row_number, 'INVALID_COLUMN_COUNT' from csv_rows where off <> 0)"""
)

RUNS = "runs as (" + RUNS_SQL.replace("{sha}", "sha256(").replace("{end}", ")").replace(
    "{customer}", "customer"
) + ")"
IMPORT_ID = "sha256(concat('testdata', chr(10), 'customer-', c_custkey, '.csv', chr(10), '1'))"
TERMINAL = "('STAGED', 'COMPLETED', 'REJECTED_DATA')"

CLAIMS = f"""with {RUNS},
incoming as (
  select {IMPORT_ID} as import_id, c_custkey as c,
         concat('event-', c_custkey, case when c_custkey % 10 = 0 then '-1' else '-0' end) as event_id,
         concat('customer-', c_custkey, '.csv') as object_name, c_custkey * 1000 as size_bytes
  from customer),
decided as (
  select i.*, r.status, r.staging_job_id as old_staging, r.staging_job_status,
         r.validation_errors_job_id as old_errors, r.validation_errors_job_status,
         r.created_at, r.staged_event_published_at, r.row_count, r.valid_row_count, r.invalid_row_count,
         case when r.status in {TERMINAL} then 'already-finished'
              when r.status = 'PROCESSING' and r.lease_expires_at > {T0} then 'in-progress'
              else 'claimed' end as decision,
         case when coalesce(r.attempt_number, 0) = 0 then 1
              when r.status = 'FAILED_TECHNICAL' then r.attempt_number + 1
              else r.attempt_number end as attempt
  from incoming i left join runs r on i.import_id = r.import_id)"""


def _request(columns: str, old: str = "r.*") -> str:
    return f"""with {RUNS},
req as (select {IMPORT_ID} as import_id, c_custkey as c, concat('event-', c_custkey, '-', n) as event_id,
               case when c_custkey // 12 % 4 = 0 then true else false end as other {columns}
        from customer, (values (0), (1)) copies(n) where n = 0 or c_custkey % 10 = 0),
joined as (select q.import_id as q_import_id, q.c as qc, q.event_id as q_event_id, q.other,
                  {old} from req q left join runs r on q.import_id = r.import_id)"""


OWNED = "coalesce(status = 'PROCESSING' and owner_id = 'owner-1', false)"


def _changed(columns: list[tuple[str, str]], verdict: str, status: str | None = None) -> str:
    """The outcome select: new values where applied, the old run elsewhere."""
    parts = [
        f"case when violation is null and not settled then {new} else {name} end as {name}"
        for name, new in columns
    ]
    new_status = (
        f"case when violation is null and not settled then '{status}' else status end"
        if status
        else "status"
    )
    return f""",
judged as (select *, {verdict} from joined)
select q_import_id as import_id, {new_status} as status, {', '.join(parts)},
       cast(case when violation is null and not settled then (case when import_id is null then 1 else 2 end)
                 when import_id is null then null else 1 end as bigint) as version,
       case when violation is not null then 'violation' when settled then 'noop' else 'applied' end as outcome,
       violation from judged"""


def _message_events(completed: bool) -> str:
    """Expected outcome per damage kind of the message envelopes."""
    name = energy.COMPLETED_EVENT if completed else energy.STAGED_EVENT
    type_checked = (
        "when d = 14 then 'Pub/Sub eventType attribute does not match the event payload'"
        if completed
        else ""
    )
    return f"""
  select c_custkey as c, c_custkey % {DAMAGE_KINDS} as d from customer), outcome as (
  select *, case when d = 15 then null else concat('ce-', c) end as cloud_event_id, case
    when d in (15, 16) then 'Unsupported or malformed CloudEvent'
    when d = 12 then 'attributes values must be strings'
    when d = 13 then 'attributes must be an object'
    when d = 1 then 'Invalid {name} payload'
    when d = 2 then '{name} event must be an object'
    when d = 4 then 'Unsupported domain event type'
    when d = 3 then 'eventId is required'
    when d = 5 then 'importId is required'
    when d = 6 then 'objectName is required'
    when d in (7, 9) then 'rowCount must be a non-negative integer'
    when d = 10 then 'invalidRowCount must be a non-negative integer'
    when d = 11 then 'Pub/Sub eventId attribute does not match the event payload'
    {type_checked} end as reason from kinds)"""


def _accepted_events(completed: bool) -> str:
    name = energy.COMPLETED_EVENT if completed else energy.STAGED_EVENT
    extra = (
        "concat('s-', c) as staged_event_id, concat('m-', c) as merge_job_id,"
        if completed
        else ""
    )
    return f"""with kinds as ({_message_events(completed)}
select cloud_event_id, concat('msg-', c) as message_id, cast(null as varchar) as publish_time,
  case when d in (14, 17) then '' else concat('e-', c) end as attributes, '{name}' as event_type,
  concat('e-', c) as event_id, '2026-01-01T00:00:00.000Z' as occurred_at,
  concat('i-', c) as import_id, {extra} 'testdata' as bucket_name,
  concat('f-', c, '.csv') as object_name, '1' as object_generation,
  c + 3 as row_count, c + 1 as valid_row_count, cast(2 as bigint) as invalid_row_count
from outcome where reason is null"""


STORAGE = """with kinds as (select c_custkey as c, c_custkey % 11 as d from customer), outcome as (
  select *, case when d = 2 then null else concat('ce-', c) end as cloud_event_id,
    case when d in (1, 2) then 'Unsupported or malformed CloudEvent'
         when d = 3 then 'Invalid Storage event data'
         when d = 4 then 'Storage event data must be a JSON object'
         when d = 5 then 'Missing required Storage event field: name'
         when d = 6 then 'Missing required Storage event field: generation'
         when d in (7, 8) then 'Missing or invalid Storage event field: size' end as reason from kinds)"""

EVENT_ROWS = _checked() + "," + IMPORTS + f""",
runs as (select f.import_id, f.object_name, c.* exclude (import_id),
                sha256(concat('EnergyImportStaged|', f.import_id)) as staged_id
         from files f join counts c on f.import_id = c.import_id),
tails as (select *, concat('"bucketName":"testdata","objectName":"', object_name,
    '","objectGeneration":"1","rowCount":', row_count, ',"validRowCount":', valid_row_count,
    ',"invalidRowCount":', invalid_row_count, '}}') as tail,
    concat('","occurredAt":"2026-01-01T00:00:00.000Z","importId":"', import_id, '",') as middle from runs),
both_events as (
  select staged_id as event_id, import_id, 'EnergyImportStaged' as event_type,
    concat('{{"eventId":"', staged_id, '","eventType":"EnergyImportStaged', middle, tail) as data from tails
  union all
  select sha256(concat('EnergyImportCompleted|', import_id)), import_id, 'EnergyImportCompleted',
    concat('{{"eventId":"', sha256(concat('EnergyImportCompleted|', import_id)),
      '","eventType":"EnergyImportCompleted', middle, '"stagedEventId":"', staged_id,
      '","mergeJobId":"energy_merge_', sha256(staged_id), '",', tail) from tails)
select event_id, import_id, data, event_type, concat('energy-staging-', import_id, '-1') as staging_job_id
from both_events""".replace("}}'", "}'").replace("'{{", "'{")


def oracle_sql() -> dict[str, str]:
    checked = _checked()
    errors = _errors(checked)
    parsed = ", ".join(f"{f} := r.{f}" for f in FIELDS)
    sql = {
        "normalize_rows": f"with {READINGS}{NORMAL.replace('{rows}', 'readings')} "
        f"select import_id, source_row_number, {', '.join(FIELDS)} from normal",
        "validate_rows": f"{checked} select import_id, source_row_number, errors = '' as valid, errors from checked",
        "error_rows": f"{errors} select error_id, import_id, source_row_number, field_name, error_code, "
        f"error_message, {T0} as created_at from errs",
        "error_raw_json": f"{errors} select error_id, cast(to_json(struct_pack(parsed := struct_pack({parsed}))) "
        "as varchar) as raw_row from errs e join readings r on e.k = r.k",
        "error_code_counts": f"{errors} select import_id, error_code, count(*) as error_count from errs "
        "group by import_id, error_code",
        "staging_rows": f"{STAGED} select record_id, {_plain()}, source_import_id, source_row_number, "
        "ingested_at from staged",
        "import_summary": f"""{checked},{IMPORTS},
numbered as (select *, sha256(concat(meter_id, chr(10), period_start, chr(10), period_end)) as record_id,
    row_number() over (partition by import_id, errors = '' order by source_row_number) as rn from checked),
samples as (select import_id,
    string_agg(concat(source_row_number, ':', errors), ' | ' order by source_row_number)
      filter (errors <> '') as invalid_row_sample,
    string_agg(record_id, ',' order by source_row_number) filter (errors = '') as record_id_sample
  from numbered where rn <= 10 group by import_id)
select f.import_id, f.object_name, row_count, valid_row_count, invalid_row_count,
  coalesce(invalid_row_sample, '') as invalid_row_sample, invalid_row_count > 10 as invalid_rows_truncated,
  coalesce(record_id_sample, '') as record_id_sample, valid_row_count > 10 as record_ids_truncated
from files f join counts c on f.import_id = c.import_id left join samples s on f.import_id = s.import_id""",
        "invalid_sample": f"""{checked} select import_id, source_row_number from checked where errors <> ''
qualify row_number() over (partition by import_id order by source_row_number) <= 10""",
        "record_id_sample": f"""{STAGED} select source_import_id as import_id, source_row_number, record_id from staged
qualify row_number() over (partition by source_import_id order by source_row_number) <= 10""",
        "dedup_latest": f"""{STAGED} select source_import_id, record_id, source_row_number, meter_id, period_start
from staged qualify row_number() over (partition by source_import_id, record_id
  order by source_row_number desc) = 1""",
        "dedup_latest_events": """select * from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
        "import_rows": f"""{STAGED} select source_import_id, source_row_number, record_id from staged
where object_name like '%-1.csv'""",
        "upsert_records": f"{MERGED} select record_id, {_plain()}, source_import_id, source_row_number, "
        "created_at, updated_at, action from merged",
        "merge_affected": f"""{MERGED} select count(*) filter (action = 'insert') as inserted,
  count(*) filter (action = 'update') as updated, count(*) filter (action <> 'keep') as affected from merged""",
        "merge_counts": f"""{MERGED} select count(*) filter (action = 'insert') as inserted,
  count(*) filter (action = 'update') as updated, count(*) filter (action <> 'keep') as affected,
  count(*) as stored from merged""",
        "merge_once": f"""with {READINGS}, runs as (select distinct import_id,
  sha256(concat('EnergyImportStaged|', import_id)) as event_id from readings)
select import_id, event_id, concat('energy_merge_', sha256(event_id)) as merge_job_id from runs
where substr(import_id, 1, 1) not in ('0', '3', '6', '9', 'c')""",
        "reconcile_counts": f"""{checked},{IMPORTS}, declared as (select import_id, valid_row_count as actual,
  valid_row_count + case when substr(import_id, 1, 1) in ('1', '5', 'a') then 1 else 0 end as valid_row_count,
  substr(import_id, 1, 1) in ('2', '7') as never from counts)
select import_id, valid_row_count, case when never then 0 else actual end as staging_row_count,
  valid_row_count = case when never then 0 else actual end as matches from declared""",
        "append_union": f"""{STAGED} select record_id, {_plain()}, source_import_id, source_row_number, ingested_at
from staged where object_name not like '%-3.csv' union all
select record_id, {_plain()}, source_import_id, source_row_number, ingested_at
from staged where object_name like '%-3.csv'""",
        "csv_records": f"with {CSV_ROWS} select import_id, cast(row_number as bigint) as row_number, "
        "off = 0 as column_count_ok, cast(18 + off as bigint) as field_count, raw, "
        + ", ".join(
            "case when off = 0 then area end as grid_area"
            if f == "grid_area"
            else f"case when off = 0 then trim({f}, ' ') end as {f}"
            for f in FIELDS
        )
        + " from csv_rows",
        "csv_short_long": f"with {CSV_ROWS} select import_id, cast(row_number as bigint) as source_row_number, "
        "raw, 'INVALID_COLUMN_COUNT' as errors from csv_rows where off <> 0",
        "csv_errors": f"""{_errors(CSV_CHECKED)} select error_code, count(*) as error_count,
  count(distinct concat(import_id, source_row_number)) as row_count from errs group by error_code""",
        "csv_reject_file": f"""with {READINGS} select import_id, object_name,
  case when object_name like '%-2.csv' then 'INVALID_CSV' else '' end as reason,
  case when object_name like '%-2.csv' then 0 else count(*) end as record_count
from readings group by import_id, object_name""",
        "rejection_details": f"""with {READINGS}, files as (select import_id, object_name, count(*) + 2 as last_line
  from readings group by import_id, object_name), wrong as (select *, case
  when object_name like '%-0.csv' then 'a quote is never closed'
  when object_name like '%-1.csv' then 'a quote inside an unquoted field'
  when object_name like '%-2.csv' then 'text behind a closing quote' end as error from files)
select import_id, object_name, error is null as well_formed, error,
  case when error is not null then last_line end as line,
  error || ', line ' || last_line as rejection_details from wrong""",
        "file_gate": """with files as (select doc_id, concat('doc-', doc_id, case doc_id % 4 when 0 then '.csv'
  when 1 then '.CSV' when 2 then '.csv.txt' else '.Csv' end) as object_name, cast(strlen(text) as bigint) as size_bytes
  from documents)
select *, case when lower(object_name) not like '%.csv' then 'ignore'
  when size_bytes > 2000 then 'FILE_TOO_LARGE' else 'accept' end as decision from files""",
        "decode_storage_events": f"""{STORAGE} select cloud_event_id,
  sha256(concat('testdata', chr(10), 'customer-', c, '.csv', chr(10), '1')) as import_id,
  'testdata' as bucket_name, concat('customer-', c, '.csv') as object_name, '1' as object_generation,
  case when d = 10 then 0 else c * 1000 end as size_bytes from outcome where reason is null""",
        "rejected_storage_events": f"{STORAGE} select cloud_event_id, reason from outcome where reason is not null",
        "decode_staged_events": _accepted_events(False),
        "decode_completed_events": _accepted_events(True),
        "rejected_events": " union all ".join(
            f"select * from (with kinds as ({_message_events(completed)} select '{name}' as consumer, "
            "cloud_event_id, concat('msg-', c) as message_id, reason from outcome where reason is not null)"
            for name, completed in (("staged", False), ("completed", True))
        ),
        "audit_log": f"""select 'energy_import_completed_received' as event, cloud_event_id, message_id, event_id,
  import_id, row_count, valid_row_count, invalid_row_count, {T0} as logged_at from ({_accepted_events(True)})""",
        "event_ids": EVENT_ROWS,
        "claim_decisions": f"""{CLAIMS}
select import_id, event_id, object_name, size_bytes, decision,
  case when decision = 'already-finished' then status end as finished_status,
  case when decision = 'already-finished' then staged_event_published_at is not null end as staged_event_published,
  case when decision = 'already-finished' then coalesce(row_count, 0) end as row_count,
  case when decision = 'already-finished' then coalesce(valid_row_count, 0) end as valid_row_count,
  case when decision = 'already-finished' then coalesce(invalid_row_count, 0) end as invalid_row_count,
  case when decision = 'claimed' then attempt end as attempt_number,
  case when decision <> 'claimed' then null when old_staging is null or staging_job_status = 'FAILED'
       then concat('energy-staging-', import_id, '-', attempt) else old_staging end as staging_job_id,
  case when decision <> 'claimed' then null when old_errors is null or validation_errors_job_status = 'FAILED'
       then concat('energy-validation-errors-', import_id, '-', attempt) else old_errors end
       as validation_errors_job_id,
  case when decision = 'claimed' then coalesce(staging_job_status = 'SUCCEEDED', false) end
       as staging_already_succeeded,
  case when decision = 'claimed' then coalesce(validation_errors_job_status = 'SUCCEEDED', false) end
       as validation_errors_already_succeeded
from decided""",
        "claimed_runs": f"""{CLAIMS}
select import_id, 'PROCESSING' as status, attempt as attempt_number, 'me' as owner_id,
  TIMESTAMP '2026-01-01 00:10:00' as lease_expires_at,
  case when staging_job_status = 'SUCCEEDED' then 'SUCCEEDED' else 'PENDING' end as staging_job_status,
  case when validation_errors_job_status = 'SUCCEEDED' then 'SUCCEEDED' else 'PENDING' end
    as validation_errors_job_status,
  coalesce(created_at, {T0}) as created_at, {T0} as updated_at,
  cast(case when status is null then 1 else 2 end as bigint) as version
from decided where decision = 'claimed'""",
        "unfinished_files": f"""with {RUNS}, incoming as (
  select {IMPORT_ID} as import_id, concat('event-', c_custkey, '-', n) as event_id, c_custkey, n
  from customer, (values (0), (1)) copies(n) where n = 0 or c_custkey % 10 = 0)
select import_id, event_id from incoming i where not exists (
  select 1 from runs r where r.import_id = i.import_id and r.status in {TERMINAL})""",
        "ledger_output": _request("")
        + _changed(
            [("staging_job_status", "'SUCCEEDED'"), ("staging_load", "'load-1'"), ("updated_at", T0)],
            f"cast(null as varchar) as staging_load, false as settled, "
            f"case when not {OWNED} then 'LEASE_NOT_OWNED' end as violation",
        ),
        "ledger_stage": _request("")
        + _changed(
            [("row_count", "qc + 3"), ("valid_row_count", "qc + 1"), ("invalid_row_count", "2"),
             ("lease_expires_at", T0), ("updated_at", T0)],
            f"false as settled, case when not {OWNED} then 'LEASE_NOT_OWNED' "
            "when not (staging_job_status = 'SUCCEEDED' and validation_errors_job_status = 'SUCCEEDED') "
            "then 'OUTPUTS_NOT_SUCCEEDED' end as violation",
            "STAGED",
        ),
        "ledger_fail": _request("")
        + _changed(
            [("staging_job_status", "case when qc % 3 = 0 then 'FAILED' else staging_job_status end"),
             ("validation_errors_job_status", "validation_errors_job_status"),
             ("technical_error", "'disk full'"), ("lease_expires_at", T0), ("updated_at", T0)],
            f"false as settled, case when not {OWNED} then 'LEASE_NOT_OWNED' end as violation",
            "FAILED_TECHNICAL",
        ),
        "ledger_reject": _request("")
        + _changed(
            [("event_id", "q_event_id"), ("rejection_reason", "'INVALID_CSV'"), ("lease_expires_at", T0),
             ("created_at", f"coalesce(created_at, {T0})"), ("updated_at", T0)],
            f"cast(null as varchar) as rejection_reason, coalesce(status in {TERMINAL}, false) as settled, "
            f"case when not coalesce(status in {TERMINAL}, false) and qc % 5 <> 0 "
            "and coalesce(owner_id, '') <> 'owner-1' then 'LEASE_NOT_OWNED' end as violation",
            "REJECTED_DATA",
        ),
        "ledger_publish_staged": _request("")
        + _changed(
            [("staged_event_id", "concat('new-', qc)"), ("staged_event_published_at", T0), ("updated_at", T0)],
            "staged_event_published_at is not null as settled, "
            "case when coalesce(status, '') not in ('STAGED', 'COMPLETED') then 'NOT_STAGED_OR_COMPLETED' end "
            "as violation",
        ),
        "ledger_complete": _request("")
        + _changed(
            [("staged_event_id", "case when staged_event_published_at is null then requested else staged_event_id end"),
             ("staged_event_published_at", f"coalesce(staged_event_published_at, {T0})"),
             ("merge_job_id", "concat('merge-', qc)"), ("merge_job_status", "'SUCCEEDED'"),
             ("processed_staged_event_id", "requested"), ("completed_at", T0), ("updated_at", T0)],
            "cast(null as varchar) as merge_job_status, cast(null as varchar) as processed_staged_event_id, "
            "cast(null as timestamp) as completed_at, "
            "concat(case when other then 'other-' else 'staged-' end, qc) as requested, "
            "coalesce(status = 'COMPLETED', false) as settled, "
            "case when import_id is null then 'RUN_NOT_FOUND' when status = 'COMPLETED' then null "
            "when status <> 'STAGED' then 'NOT_STAGED' "
            "when staged_event_id <> concat(case when other then 'other-' else 'staged-' end, qc) "
            "then 'STAGED_EVENT_MISMATCH' end as violation",
            "COMPLETED",
        ),
        "ledger_publish_completed": _request("")
        + _changed(
            [("completed_event_id", "requested"), ("completed_event_published_at", T0), ("updated_at", T0)],
            "concat(case when other then 'other-' else 'completed-' end, qc) as requested, "
            "completed_event_published_at is not null as settled, "
            "case when coalesce(status, '') <> 'COMPLETED' then 'NOT_COMPLETED' "
            "when completed_event_published_at is not null and completed_event_id <> "
            "concat(case when other then 'other-' else 'completed-' end, qc) "
            "then 'COMPLETED_EVENT_MISMATCH' end as violation",
        ),
        "outbox_repair": f"""with {RUNS}
select sha256(concat(kind, '|', import_id)) as event_id, kind as event_type,
  '2026-01-01T00:00:00.000Z' as occurred_at, import_id, row_count from (
  select 'EnergyImportStaged' as kind, import_id, row_count from runs
  where status = 'STAGED' and staged_event_published_at is null
  union all
  select 'EnergyImportCompleted', import_id, row_count from runs
  where status = 'COMPLETED' and completed_event_published_at is null)""",
        "expire_staging": f"""{STAGED} select source_import_id, source_row_number, record_id,
  cast(ingested_at - source_row_number % 10 * interval 1 day as date) as ingested_date from staged
where source_row_number % 10 < 7""",
        "expired_days": f"""{STAGED} select distinct
  cast(ingested_at - source_row_number % 10 * interval 1 day as date) as ingested_date from staged
where source_row_number % 10 >= 7""",
        "partitioned_layout": f"""{STAGED} select strftime(period_start, '%Y-%m') as period_month,
  count(*) as record_count, count(distinct meter_id) as meter_count from staged group by 1""",
        "stream_ingest": f"""{errors},{IMPORTS}
select 'run/STAGED/true' as kind, import_id,
  concat(row_count, '/', valid_row_count, '/', invalid_row_count) as item from counts
union all
select concat('row/', source_row_number), import_id,
  sha256(concat(meter_id, chr(10), period_start, chr(10), period_end)) from checked where errors = ''
union all
select concat('error/', source_row_number), import_id, error_id from errs""",
        "stream_merge": f"""{STAGED} select record_id, {_plain()}, source_import_id, source_row_number,
  strftime(period_start, '%Y-%m') as period_month from staged
qualify row_number() over (partition by record_id
  order by sha256(concat('EnergyImportStaged|', source_import_id)) desc, source_row_number desc) = 1""",
        "stream_merge_twice": f"""{STAGED} select record_id, {_plain()}, source_import_id, source_row_number,
  strftime(period_start, '%Y-%m') as period_month from staged
qualify row_number() over (partition by record_id order by object_name like '%-3.csv' desc,
  sha256(concat('EnergyImportStaged|', source_import_id)) desc, source_row_number desc) = 1""",
        "stream_reupload": f"""{checked},{IMPORTS},
names as (select distinct object_name, import_id from readings)
select object_name, 'STAGED' as status, 2 as versions, 2 * row_count as row_count,
  2 * valid_row_count as valid_row_count from counts join names using (import_id)""",
        "csv_edge_records": f"""with {READINGS} select import_id,
  2 * source_row_number - 1 as row_number, true as column_count_ok, trim(meter_id, ' ') as meter_id,
  trim(period_start, ' ') as period_start from readings""",
        "safe_counts": """with said as (select c_custkey, case c_custkey % 9
    when 1 then concat(c_custkey, '.0') when 2 then concat(c_custkey, '.5') when 3 then concat('-', c_custkey)
    when 4 then 'many' when 5 then '9007199254740992' when 6 then concat(' ', c_custkey, chr(9))
    when 7 then null else concat(c_custkey) end as reported from customer)
select c_custkey, reported, case when c_custkey % 9 in (0, 1, 6, 8) then c_custkey end as row_count from said""",
        "optional_event_fields": """select concat('ce-', c_custkey) as cloud_event_id,
  case when c_custkey % 97 <> 0 and c_custkey % 4 = 1 then '2026-01-01T00:00:00Z' end as publish_time,
  case when c_custkey % 97 = 0 then 'Invalid Pub/Sub event body'
       when c_custkey % 4 in (2, 3) then 'publishTime is required' end as reason
from customer where c_custkey % 19 in (0, 17, 18)""",
        "stream_dedup": "select event_id, user_id, event_type, ts from events",
    }
    return sql
