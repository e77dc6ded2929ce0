"""DuckDB SQL equal in result to each registered query (the correctness
gate).  The swipe projection of ``events`` is the FIXTURES §4 definition.
Times are text, counts BIGINT, every column aliased like the Spark side."""

from __future__ import annotations

from ..schemas import WEEK_BASE_DAY, WEEK_GROUPS
from ..sources.fixture import FIXTURE_PERIOD as P

COLS = "service_date, time, lineID, stationID, deviceID, status, userID, payType"

RAW = r"""
g as (
  select event_id, strftime(ts, '%Y-%m-%d') as service_date,
    case when event_id % 71 = 0 then '2024-01-32 00:00:00'
         else strftime(ts, '%Y-%m-%d %H:%M:%S') end as time,
    case when event_id % 89 = 0 then 'D'
         else substr('ABC', cast(event_id % 3 + 1 as int), 1) end as lineID,
    case when event_id % 83 = 0 then '99' when event_id % 79 = 0 then 'x'
         else cast(user_id % 81 as varchar) end as stationID,
    cast(event_id % 500 as varchar) as deviceID,
    case when event_id % 73 = 0 then '7' else cast(event_id % 2 as varchar) end as status,
    concat('U', cast(user_id as varchar)) as userID,
    case when event_id % 97 = 0 then null
         else cast((event_id // 2) % 4 as varchar) end as payType
  from events),
raw as (select COLS from g
        union all select COLS from g where event_id % 50 = 0)
""".replace("COLS", COLS)

RULES = r"""
  (not regexp_full_match(time, 'MONTH-\d{2} (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d')) as bad_time,
  lineID not in ('A', 'B', 'C') as bad_line,
  not coalesce(try_cast(stationID as int) between 0 and 80, false) as bad_station,
  status not in ('0', '1') as bad_status,
  payType not in ('0', '1', '2', '3') as bad_pay_type
""".replace("MONTH", P.month)

CLS = RAW + f""",
grp as (select {COLS}, count(*) as copies from raw group by all),
ruled as (select *, {RULES} from grp),
cls as (select *,
  case when time is null or lineID is null or stationID is null or deviceID is null
            or status is null or userID is null or payType is null then 'null'
       when bad_time or bad_line or bad_station or bad_status or bad_pay_type then 'abnormal'
       when time < '{P.lower_bound}' or time > '{P.upper_bound}' then 'out_of_range'
       else 'clean' end as stage
  from ruled),
clean as (select {COLS} from cls where stage = 'clean'),
typed as (select service_date, strptime(time, '%Y-%m-%d %H:%M:%S') as ts, lineID,
                 cast(stationID as int) as stationID, cast(status as int) as status,
                 payType from clean)
"""

SLOT = "strftime(time_bucket(interval '30 minutes', ts), '%H:%M')"
MID = "strftime(time_bucket(interval '30 minutes', ts) + interval '15 minutes', '%H:%M')"

LINES = RAW + r""",
lines as (select concat_ws(',', coalesce(time, ''), coalesce(lineID, ''), coalesce(stationID, ''),
                 coalesce(deviceID, ''), coalesce(status, ''), coalesce(userID, ''),
                 coalesce(payType, '')) as value from raw),
sp as (select value, string_split(regexp_replace(value, ',+$', ''), ',') as f from lines),
st as (select value as raw, trim(f[1]) as time, trim(f[2]) as lineID,
              try_cast(trim(f[3]) as integer) as stationID, try_cast(trim(f[4]) as integer) as deviceID,
              try_cast(trim(f[5]) as integer) as status, trim(f[6]) as userID,
              try_cast(trim(f[7]) as integer) as payType,
              try_cast(trim(f[1]) as timestamp) as ts, len(f) as n
       from sp),
strict as (select *, case when raw is null then 'null_message'
                          when n <> 7 then 'field_count'
                          when stationID is null or deviceID is null or status is null
                               or payType is null then 'not_an_int'
                          when ts is null then 'bad_time' end as reject_reason
           from st),
sv as (select * from strict where reject_reason is null),
lx as (select value as raw, trim(f[1]) as time,
              case when length(trim(f[1])) >= 16 then substr(trim(f[1]), 1, 16) end as minute,
              trim(f[2]) as lineID, trim(f[3]) as stationID, trim(f[5]) as status, len(f) as n
       from sp),
lax as (select *, case when raw is null then 'null_message'
                       when n < 7 then 'field_count'
                       when minute is null then 'short_time' end as reject_reason
        from lx),
lv as (select * from lax where reject_reason is null),
mfl as (select strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as minute, lineID,
               count(*) as total_flow, count(*) filter (where status = 0) as exit_count,
               count(*) filter (where status = 1) as entry_count
        from sv group by all),
mfs as (select strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as minute, lineID, stationID,
               count(*) as total_flow, count(*) filter (where status = 0) as exit_count,
               count(*) filter (where status = 1) as entry_count
        from sv group by all),
mml as (select minute, lineID, count(*) filter (where status = '1') as in_count,
               count(*) filter (where status = '0') as out_count,
               count(*) filter (where status = '1') + count(*) filter (where status = '0') as total_count
        from lv group by minute, lineID),
mms as (select minute, lineID, stationID, lineID || '-' || stationID as station_key,
               count(*) filter (where status = '1') as in_count,
               count(*) filter (where status = '0') as out_count,
               count(*) filter (where status = '1') + count(*) filter (where status = '0') as total_count
        from lv group by minute, lineID, stationID)
"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


def _week_values() -> str:
    rows = []
    for first, last in WEEK_GROUPS:
        gid = f"{first:02d}_to_{last:02d}"
        days = [WEEK_BASE_DAY] + [d for d in range(first, last + 1) if d != WEEK_BASE_DAY]
        rows.extend(f"('{gid}', '{P.day(d)}')" for d in days)
    return ", ".join(rows)


_NULL_COLS = ["time", "lineID", "stationID", "deviceID", "status", "userID", "payType"]

_REPORT = ("select service_date, cast(sum(copies) as bigint) as total, "
           + ", ".join(f"cast(coalesce(sum(case when {c} is null then copies end), 0) as bigint) as null_{c}"
                       for c in _NULL_COLS)
           + ", cast(coalesce(sum(case when stage = 'null' then copies end), 0) as bigint) as null_rows"
           + ", cast(coalesce(sum(case when stage <> 'null' then copies - 1 end), 0) as bigint) as duplicates"
           + ", count(*) filter (where stage = 'abnormal') as abnormal"
           + ", count(*) filter (where stage = 'out_of_range') as out_of_range"
           + ", count(*) filter (where stage = 'clean') as final"
           + " from cls group by service_date")

_REPORT_TEXT = r"""
select service_date, concat_ws(chr(10),
  'File: record_' || service_date || '.csv',
  'Total number of records: ' || cast(total as varchar),
  'Missing value counts per column:',
  '[' || concat_ws(',', NULLS) || ']',
  'Number of duplicate records: ' || cast(duplicates as varchar),
  'Number of abnormal records: ' || cast(abnormal as varchar),
  'Number of records with time out of expected range: ' || cast(out_of_range as varchar),
  'Final total number of records: ' || cast(final as varchar)) as text
from rep
""".replace("NULLS", ", ".join(f"cast(null_{c} as varchar)" for c in _NULL_COLS))

_DETAIL = ("concat_ws(',', case when bad_time then 'bad_time' end, case when bad_line then 'bad_line' end, "
           "case when bad_station then 'bad_station' end, case when bad_status then 'bad_status' end, "
           "case when bad_pay_type then 'bad_pay_type' end)")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["swipe_scan"] = _with(RAW, f"select {COLS} from raw")
    q["raw_csv_roundtrip"] = q["swipe_scan"]
    q["quality_null_counts"] = _with(RAW, "select service_date, count(*) as total, "
                                     + ", ".join(f"count(*) filter (where {c} is null) as null_{c}"
                                                 for c in _NULL_COLS)
                                     + " from raw group by service_date")
    q["quality_report"] = _with(CLS, _REPORT)
    q["quality_report_text"] = _with(CLS + f", rep as ({_REPORT})", _REPORT_TEXT)
    q["clean_records"] = _with(CLS, "select * from clean")
    q["rejected_records"] = _with(CLS, f"""
select {COLS}, stage as reason, case when stage = 'abnormal' then {_DETAIL} end as detail,
       cast(case when stage = 'null' then copies else 1 end as bigint) as n
from cls where stage <> 'clean'
union all
select {COLS}, 'duplicate' as reason, null as detail, cast(copies - 1 as bigint) as n
from cls where stage <> 'null' and copies > 1""")
    q["clean_roundtrip"] = q["clean_records"]

    q["halfhour_flow"] = _with(CLS, f"""
select service_date, {SLOT} as time_slot, count(*) as traffic_count from typed group by all""")
    q["halfhour_flow_by_line"] = _with(CLS, f"""
select service_date, {SLOT} as time_slot, lineID,
       case status when 1 then 'In' when 0 then 'Out' end as status, count(*) as traffic_count
from typed where status in (0, 1) group by all""")
    q["line_direction_series"] = _with(CLS, f"""
select service_date, 'Line ' || lineID || ' - ' || case status when 1 then 'In' when 0 then 'Out' end as series,
       {SLOT} as time_slot, {MID} as x, count(*) as y
from typed where status in (0, 1) group by all""")
    q["week_comparison"] = _with(CLS + f", wk(group_id, service_date) as (values {_week_values()})", f"""
select w.group_id, t.service_date, substr(t.service_date, 6, 5) as series,
       {SLOT} as time_slot, {MID} as x, count(*) as y
from typed t join wk w on t.service_date = w.service_date group by all""")
    stations = "sa as (select service_date, lineID, stationID, status, count(*) as traffic_count from typed group by all)"
    rank = ("row_number() over (partition by service_date, status "
            "order by traffic_count desc, stationID, lineID)")
    q["station_flow_daily"] = _with(CLS + ", " + stations, f"""
select service_date, lineID, stationID,
       case when status = 1 then 'Inflow' else 'Outflow' end as status, traffic_count,
       coalesce(case when status in (0, 1) then {rank} end <= 10, false) as is_top10
from sa""")
    q["station_top10"] = _with(CLS + ", " + stations, f"""
select service_date, case when status = 1 then 'Inflow' else 'Outflow' end as status,
       cast(rk as bigint) as rank, lineID, stationID, traffic_count,
       lineID || '-' || cast(stationID as varchar) as station_key
from (select *, {rank} as rk from sa where status in (0, 1)) where rk <= 10""")
    per_line = "pl as (select service_date, lineID, count(*) as n from typed group by all)"
    q["line_flow_daily_with_total"] = _with(CLS + ", " + per_line, """
select service_date, case when grouping(lineID) = 1 then 'total' else lineID end as lineID,
       cast(sum(n) as bigint) as passenger_flow
from pl group by grouping sets ((service_date, lineID), (service_date))""")
    q["line_flow_pivot"] = _with(CLS + ", " + per_line, """
select service_date,
       cast(coalesce(sum(case when lineID = 'A' then n end), 0) as bigint) as A,
       cast(coalesce(sum(case when lineID = 'B' then n end), 0) as bigint) as B,
       cast(coalesce(sum(case when lineID = 'C' then n end), 0) as bigint) as C,
       cast(sum(n) as bigint) as total
from pl group by service_date""")
    q["paytype_distribution"] = _with(CLS + """,
pt as (select payType as pay_type, count(*) as total_count from typed group by 1),
dim(pay_type, pay_label) as (values ('0', 'ordinary'), ('1', 'student'), ('2', 'senior'), ('3', 'other'))""", """
select pt.pay_type, dim.pay_label, pt.total_count,
       cast(pt.total_count as double) / cast(sum(pt.total_count) over () as double) as share
from pt left join dim on pt.pay_type = dim.pay_type""")
    q["decoded_records"] = _with(CLS, """
select c.service_date, strftime(strptime(c.time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as event_ts,
       c.lineID, cast(c.stationID as int) as stationID, cast(c.deviceID as int) as deviceID,
       cast(c.status as int) as status, c.userID, cast(c.payType as int) as payType,
       s.status_label, p.pay_label
from clean c
left join (values ('0', 'exit'), ('1', 'entry')) s(code, status_label) on c.status = s.code
left join (values ('0', 'ordinary'), ('1', 'student'), ('2', 'senior'), ('3', 'other')) p(code, pay_label)
  on c.payType = p.code""")
    q["service_day_span"] = _with(CLS, """
select min(service_date) as first_day, max(service_date) as last_day,
       count(distinct service_date) as days from typed""")

    q["parse_lines_strict"] = _with(LINES, """
select raw, time, lineID, stationID, deviceID, status, userID, payType,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as event_ts, reject_reason is null as is_valid, reject_reason
from strict""")
    q["parse_lines_lax"] = _with(LINES, """
select raw, time, minute, lineID, stationID, status, reject_reason is null as is_valid, reject_reason
from lax""")
    q["minute_flow_line"] = _with(LINES, "select * from mfl")
    q["minute_flow_station"] = _with(LINES, "select * from mfs")
    q["inout_minute_line"] = _with(LINES, "select * from mml")
    q["inout_minute_station"] = _with(LINES, "select * from mms")
    q["ingest_profile"] = _with(RAW + r""",
a as (select service_date, substr(trim(time), 1, 16) as minute, count(*) as records
      from raw where length(trim(time)) >= 16
        and try_strptime(substr(trim(time), 1, 16) || ':00', '%Y-%m-%d %H:%M:%S') is not null
      group by all),
b as (select *, strptime(minute || ':00', '%Y-%m-%d %H:%M:%S') as ts from a),
c as (select *, lag(ts) over w as prev,
             sum(records) over (w rows between unbounded preceding and current row) as sent
      from b window w as (partition by service_date order by minute))""", """
select service_date, minute, records, cast(sent as bigint) as sent_total,
       coalesce((epoch_us(ts) - epoch_us(prev)) // 1000, 0) as gap_ms
from c""")
    q["live_series_line"] = _with(LINES, """
select 'Line ' || lineID as series, minute as x, total_flow as y from mfl where lineID in ('A', 'B', 'C')
union all
select 'Line ' || lineID || ' Entry', minute, entry_count from mfl where lineID in ('A', 'B', 'C')
union all
select 'Line ' || lineID || ' Exit', minute, exit_count from mfl where lineID in ('A', 'B', 'C')""")
    q["live_series_station"] = _with(LINES, """
select station_key, 'in' as type, station_key || ' (in)' as series, minute as x, in_count as y from mms
union all
select station_key, 'out', station_key || ' (out)', minute, out_count from mms
union all
select station_key, 'total', station_key || ' (total)', minute, total_count from mms""")
    ts = "(minute || '.0')"
    q["rowkey_cells_line"] = _with(LINES, f"""
select {ts} || '_' || lineID as row_key, 'time' as qualifier, {ts} as value from mfl
union all select {ts} || '_' || lineID, 'line_id', lineID from mfl
union all select {ts} || '_' || lineID, 'total_flow', cast(total_flow as varchar) from mfl
union all select {ts} || '_' || lineID, 'exit_count', cast(exit_count as varchar) from mfl
union all select {ts} || '_' || lineID, 'entry_count', cast(entry_count as varchar) from mfl""")
    key = f"{ts} || '_' || lineID || '_' || cast(stationID as varchar)"
    q["rowkey_cells_station"] = _with(LINES, f"""
select {key} as row_key, 'time' as qualifier, {ts} as value from mfs
union all select {key}, 'line_id', lineID from mfs
union all select {key}, 'station_id', cast(stationID as varchar) from mfs
union all select {key}, 'total_flow', cast(total_flow as varchar) from mfs
union all select {key}, 'exit_count', cast(exit_count as varchar) from mfs
union all select {key}, 'entry_count', cast(entry_count as varchar) from mfs""")
    q["inout_cells_line"] = _with(LINES, """
select minute || '-' || lineID as row_key, 'in_count' as qualifier, cast(in_count as varchar) as value from mml
union all select minute || '-' || lineID, 'out_count', cast(out_count as varchar) from mml
union all select minute || '-' || lineID, 'total_count', cast(total_count as varchar) from mml""")
    q["inout_cells_station"] = _with(LINES, """
select minute || '-' || station_key as row_key, 'in_count' as qualifier, cast(in_count as varchar) as value from mms
union all select minute || '-' || station_key, 'out_count', cast(out_count as varchar) from mms
union all select minute || '-' || station_key, 'total_count', cast(total_count as varchar) from mms""")
    q["upsert_latest_wins"] = _with(CLS + r""",
rt as (select service_date, try_strptime(time, '%Y-%m-%d %H:%M:%S') as ts from raw),
v1 as (select service_date, SLOT as time_slot, count(*) as traffic_count
       from rt where ts is not null group by all),
v2 as (select service_date, SLOT as time_slot, count(*) as traffic_count from typed group by all)
""".replace("SLOT", SLOT), """
select * from v2
union all
select * from v1 where not exists
  (select 1 from v2 where v2.service_date = v1.service_date and v2.time_slot = v1.time_slot)""")
    q["stream_minute_line_update"] = q["minute_flow_line"]
    q["stream_minute_station_update"] = q["minute_flow_station"]
    q["stream_line_rollup"] = q["minute_flow_line"]
    q["stream_minute_line_append"] = _with(LINES, """
select * from mfl
where strptime(minute, '%Y-%m-%d %H:%M:%S') + interval '2 minutes'
      <= (select max(date_trunc('minute', ts)) from sv)""")
    q["stream_inout_line_append"] = _with(LINES + """,
lvt as (select *, try_strptime(minute || ':00', '%Y-%m-%d %H:%M:%S') as mts from lv)""", """
select minute, lineID, count(*) filter (where status = '1') as in_count,
       count(*) filter (where status = '0') as out_count,
       count(*) filter (where status = '1') + count(*) filter (where status = '0') as total_count
from lvt
where mts < (select max(mts) from lvt)
group by minute, lineID""")
    q["stream_rejects"] = _with(LINES, "select raw, reject_reason from strict where reject_reason is not null")
    q["stream_inout_rejects"] = _with(LINES + """,
lxt as (select raw, minute, try_strptime(minute || ':00', '%Y-%m-%d %H:%M:%S') as mts, reject_reason from lax)""", """
select raw, coalesce(reject_reason, 'bad_minute') as reject_reason
from lxt where reject_reason is not null or mts is null""")
    q["stream_multi_batch_update"] = q["minute_flow_line"]
    q["stream_late_rows"] = q["minute_flow_line"]
    q["clean_rerun"] = _with(CLS, "select * from clean where service_date <> '2024-01-05'")
    q["daily_files_scan"] = _with(RAW, f"""
select 'folder' as scan, {COLS} from raw
union all
select 'days', {COLS} from raw where service_date in ('2024-01-02', '2024-01-09', '2024-01-31')""")
    q["halfhour_flow_in_order"] = q["halfhour_flow"]
    q["station_flow_in_order"] = q["station_flow_daily"]
    q["live_series_station_selected"] = _with(LINES, """
select station_key, 'in' as type, station_key || ' (in)' as series, minute as x, in_count as y
from mms where station_key in ('A-1', 'A-7', 'A-40')
union all
select station_key, 'out', station_key || ' (out)', minute, out_count
from mms where station_key in ('A-1', 'A-7', 'A-40')""")
    q["upsert_new_writer"] = q["upsert_latest_wins"]
    q["stream_chained_rollup"] = q["stream_minute_line_append"]
    q["upsert_compacted_live"] = q["minute_flow_line"]
    q["clean_incremental"] = q["clean_records"]
    q["week_comparison_pruned"] = q["week_comparison"]
    q["cells_in_key_order"] = q["rowkey_cells_station"]
    q["stream_shared_parse"] = _with(LINES, """
select 'flow' as kind, minute, lineID, null as reason, total_flow as n from mfl
union all
select 'reject', null, null, reject_reason, count(*) from strict where reject_reason is not null group by reject_reason""")
    q["stream_state_left"] = _with(LINES, """
select * from mfl
where strptime(minute, '%Y-%m-%d %H:%M:%S') + interval '2 minutes'
      > (select max(date_trunc('minute', ts)) from sv)""")
    counts = ["total", *(f"null_{c}" for c in _NULL_COLS), "null_rows", "duplicates", "abnormal", "out_of_range", "final"]
    q["quality_observed"] = _with(CLS + f", rep as ({_REPORT})", "select "
                                  + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in counts) + " from rep")
    # Of the rows with a field too few or too many only the text is known.
    told = RAW.replace("raw as (", "every as (") + f""",
raw as (select {COLS} from every where cast(deviceID as int) % 50 not in (7, 9)),
six as (select *, concat_ws(',', coalesce(time, ''), coalesce(lineID, ''), coalesce(stationID, ''),
               coalesce(deviceID, ''), coalesce(status, ''), coalesce(userID, '')) as line from every),
malformed as (
  select service_date, line as detail from six where cast(deviceID as int) % 50 = 7
  union all
  select service_date, line || ',' || coalesce(payType, '') || ',extra' from six where cast(deviceID as int) % 50 = 9)
"""
    q["daily_files_malformed"] = q["rejected_records"].replace(RAW, told) + f"""
union all
select service_date, {', '.join(f'null as {c}' for c in _NULL_COLS)}, 'malformed' as reason, detail, count(*) as n
from malformed group by service_date, detail"""
    return q
