"""The same answers in plain SQL, over the tables ``orders``, ``lineitem`` and ``events``."""

from __future__ import annotations

from sendgate.fixtures import BUSINESS, FILE_NAME, RUN_ID, STAMP, STEP

_DUE = """
due as (
  select o_orderkey as "APPL_ID",
         case when o_custkey % 10 <> 0 then cast(o_custkey % 300 as varchar) end as "IMEI",
         o_orderpriority as "Notification_Code"
  from orders),
overdue as (
  select l_orderkey as "APPL_ID" from lineitem
  where l_returnflag = 'R' and l_quantity > 40),
history as (
  select cast(user_id as varchar) as "IMEI", event_type as business
  from events where cast(ts as date) = date '2024-01-02')"""


def _hit(table: str, column: str) -> str:
    return f'"{column}" in (select "{column}" from {table} where "{column}" is not null)'


_BIZ = f"""biz as (select distinct "IMEI" from history where business = '{BUSINESS}')"""
_CAPPED = 'capped as (select "IMEI" from history group by 1 having count(*) >= 3)'
_CAPPED_WITH_AUDIT = """capped as (
  select "IMEI" from (select "IMEI" from history union all select "IMEI" from due)
  group by 1 having count(*) >= 3)"""


def _status(rows: str = "due", levels: int = 3) -> str:
    """CASE over the first ``levels`` steps; the last step names its misses."""
    whens = [
        ('"IMEI" is null', "NULL", "NOT_NULL"),
        (f"coalesce({_hit('overdue', 'APPL_ID')}, false)", "DELINQUENT", "NOT_DELINQUENT"),
        (_hit("biz", "IMEI"), "DUPLICATE_BIZ", "UNIQUE_BIZ"),
        (_hit("capped", "IMEI"), "DUPLICATE_GLOBAL", "UNIQUE_GLOBAL"),
    ][: levels + 1]
    case = " ".join(f"when {test} then '{hit}'" for test, hit, _ in whens)
    return f"""select *, case {case} else '{whens[-1][2]}' end as "FILTER_STATUS" from {rows}"""


def _with(select: str, *more: str, capped: str = _CAPPED, levels: int = 3) -> str:
    status = f"status as ({_status(levels=levels)})"
    return "with " + ",\n".join([_DUE, _BIZ, capped, status, *more]) + "\n" + select


def _funnel(capped: str = _CAPPED) -> str:
    return _with(
        'select "FILTER_STATUS", count(*) as "count" from status group by 1', capped=capped
    )


_NO_HISTORY = _funnel().replace("date '2024-01-02'", "date '1900-01-01'")
_LOANS = 'loans as (select "APPL_ID" as loan, count(*) as n from overdue group by 1)'
_WITH_COPIES = 'status left join loans on loan = "APPL_ID"'
_FANNED = """fanned as (
  select status.* from status left join overdue on status."APPL_ID" = overdue."APPL_ID")"""

_TRANSFORMATIONS = """
  '{' || string_agg('"' || k || '":' || n, ',' order by k) || '}'"""
_PER_STATUS = (
    'per_status as (select "FILTER_STATUS" as k, count(*) as n from status group by 1)'
)
_ELIGIBLE = """eligible as (
  select "APPL_ID", "IMEI", "Notification_Code" from status
  where "FILTER_STATUS" = 'UNIQUE_GLOBAL')"""
_NUMBERED = f"""batches as (
  select *, (row_no - 1) // {STEP} as batch_no from (
    select *, row_number() over (
      partition by "Notification_Code"
      order by "APPL_ID" nulls first, "IMEI" nulls first) as row_no
    from eligible))"""
_NAMED = f"""named as (
  select *,
    md5('{RUN_ID}' || '|' || row_no || '|' || coalesce("Notification_Code", '') || '|'
        || coalesce(cast("APPL_ID" as varchar), '') || '|' || coalesce("IMEI", ''))
      as "TriggerID",
    '/2024/01/02/{BUSINESS}/DCNOTIF_{STAMP}_' || batch_no || '_REQ.csv' as "DATA_C_FILENAME"
  from batches)"""
_LINES = """lines as (
  select "DATA_C_FILENAME", "Notification_Code", row_no,
    "IMEI" || ',' || "Notification_Code" || ',' || "TriggerID" as line
  from named)"""


def _batched(select: str, *more: str) -> str:
    return _with(select, _ELIGIBLE, _NUMBERED, _NAMED, *more)


def _init(run_id: str) -> str:
    return f"""select '{FILE_NAME}' as "CG_FILENAME", '{run_id}' as "TRANSACTION_ID",
      cast(sum(n) as bigint) as "CG_COUNT", {_TRANSFORMATIONS} as "TRANSFORMATIONS",
      cast(sum(case when k = 'UNIQUE_GLOBAL' then n else 0 end) as bigint) as "ELIGIBLE_COUNT"
    from per_status"""


_ATTEMPTS = """attempts as (
  select 'user_' || user_id as filename, ts, event_id,
    case event_type when 'view' then 200 when 'purchase' then 201 when 'click' then 302
      when 'signup' then 401 when 'error' then 500 end as code,
    case event_type when 'click' then 'moved' else props end as api_response
  from events),
classed as (
  select *, cast(code as varchar) as status_code,
    case when code is null then 'failed' when code between 200 and 399 then 'success'
      when code = 401 then 'auth_retry' when code >= 400 then 'error' else 'unknown' end as status
  from attempts),
latest as (
  select * from (
    select *, row_number() over (partition by filename order by ts desc, event_id desc) as rn
    from classed) where rn = 1),
report as (
  select m."DATA_C_FILENAME", coalesce(status, 'not_sent') as status, status_code, api_response
  from (select distinct 'user_' || o_custkey as "DATA_C_FILENAME" from orders) m
  left join latest on filename = m."DATA_C_FILENAME")"""


def _answers(select: str) -> str:
    return f"with {_ATTEMPTS}\n{select}"


_IST = "ts + interval 330 minute"
_TIME = "%Y-%m-%dT%H:%M:%S.%f"
_MANIFEST = """select batch_no, "DATA_C_FILENAME", count(*) as "BATCH_FILE_COUNT"
  from named group by 1, 2"""

_ANSWER = '''format('{{"rows": {}, "bytes": {}, "md5": "{}"}}', count(*),
  length('IMEI,Notification_Code,TriggerID') + 1 + sum(length(line) + 1),
  md5('IMEI,Notification_Code,TriggerID' || chr(10)
      || string_agg(line || chr(10), '' order by "Notification_Code", row_no)))
    as api_response'''

_STAGED = f"""select '{RUN_ID}' as "TRANSACTION_ID", '{FILE_NAME}' as "CG_FILENAME",
  "DATA_C_FILENAME", count(*) as "BATCH_FILE_COUNT" from named group by 3"""
_OUTCOMES = f"""select "DATA_C_FILENAME", 'success' as status, '200' as status_code, {_ANSWER}
  from lines group by 1"""

ORACLES: dict[str, str] = {
    "due_normalised": f"with {_DUE} select * from due",
    "due_from_csv": f"with {_DUE} select * from due",
    "due_from_odd_csv": f'with {_DUE} select * from due where "IMEI" is not null',
    "overdue_keys": f"with {_DUE} select * from overdue",
    "overdue_from_table": f"with {_DUE} select * from overdue",
    "null_key_flag": _with("select * from status", levels=0),
    "step_overdue": _with("select * from status", levels=1),
    "step_overdue_fanout": _with(
        f"select status.*, coalesce(n, 1) as copies from {_WITH_COPIES}", _LOANS, levels=1
    ),
    "business_keys": f"with {_DUE}, {_BIZ} select * from biz",
    "step_business": _with("select * from status", levels=2),
    "capped_keys": f"""with {_DUE}
      select "IMEI", count(*) as "count" from history group by 1 having count(*) >= 3""",
    "step_global_cap": _with("select * from status"),
    "cascade_status": _with("select * from status"),
    "cascade_shuffled": _with("select * from status"),
    "cascade_fanout": _with(
        f"select status.*, coalesce(n, 1) as copies from {_WITH_COPIES}", _LOANS
    ),
    "funnel_fanout": _with(
        'select "FILTER_STATUS", count(*) as "count" from fanned group by 1', _FANNED
    ),
    "cap_with_audit": _with("select * from status", capped=_CAPPED_WITH_AUDIT),
    "empty_history_cascade": _NO_HISTORY,
    "absent_history_cascade": _NO_HISTORY,
    "cascade_rerun": _funnel().replace(
        "date '2024-01-02')", f"date '2024-01-02' and event_type <> '{BUSINESS}')"
    ),
    "eligible": _with("select * from eligible", _ELIGIBLE),
    "eligible_only": _with("select * from eligible", _ELIGIBLE),
    "eligible_only_shuffled": _with("select * from eligible", _ELIGIBLE),
    "funnel_counts": _funnel(),
    "funnel_json": _with(
        f'select {_TRANSFORMATIONS} as "TRANSFORMATIONS" from per_status', _PER_STATUS
    ),
    "funnel_conservation": _with(
        """select (select count(*) from orders) as rows_in, count(*) as rows_labelled,
          count(*) filter ("FILTER_STATUS" = 'UNIQUE_GLOBAL') as rows_eligible,
          (select count(*) from orders) = count(*) as conserved from status"""
    ),
    "batch_assign": _batched("select * from batches"),
    "batch_slice": _batched(
        f"select * from batches where row_no >= {STEP + 1} and row_no < {2 * STEP + 1}"
    ),
    "batch_manifest": _batched(_MANIFEST),
    "batch_balanced": _with(
        f"""select *, (row_no - 1) // {STEP} as batch_no from (
          select *, row_number() over (order by "APPL_ID" nulls first, "IMEI" nulls first,
            "Notification_Code" nulls first) as row_no from eligible)""",
        _ELIGIBLE,
    ),
    "trigger_ids": _batched('select * exclude ("DATA_C_FILENAME") from named'),
    "batch_file_names": _batched(
        """select batch_no, "DATA_C_FILENAME", min(row_no) as first_row, max(row_no) as last_row
          from named group by 1, 2"""
    ),
    "status_roundtrip": _with(
        f"""select *, '2024-01-02' as run_date, '{BUSINESS}' as business,
          '{RUN_ID}' as transaction_id from status"""
    ),
    "batches_roundtrip": _batched(
        f"""select "APPL_ID", "IMEI", "Notification_Code", batch_no, '{BUSINESS}' as business,
          '{RUN_ID}' as transaction_id from named"""
    ),
    "read_batch": _batched(
        f"""select "IMEI", "Notification_Code", "TriggerID" from named where row_no <= {STEP}"""
    ),
    "batch_csv": _batched(
        f"""select "IMEI", "Notification_Code", "TriggerID" from named where row_no <= {STEP}"""
    ),
    "init_log": _with(_init(RUN_ID), _PER_STATUS),
    "init_log_appended": _with(f"{_init(RUN_ID)} union all {_init('RUN-2')}", _PER_STATUS),
    "staging_log": _batched(_STAGED),
    "manifest_for_run": f"""
      select distinct 'user_' || user_id || '.csv' as "DATA_C_FILENAME"
      from events where event_type = '{BUSINESS}'""",
    "kpi_log": f"""
      select 'user_' || user_id as "TRANSACTION_ID", 'FILE_' || event_type as "CG_FILENAME",
        case event_type when 'view' then 'BulkNotification' else 'Primary' end as "ITEM_TYPE",
        strftime(min({_IST}), '{_TIME}') as "START_TIME",
        strftime(max({_IST}), '{_TIME}') as "END_TIME",
        date_diff('microsecond', min(ts), max(ts)) as "DURATION_US"
      from events group by user_id, event_type""",
    "failed_runs": """
      select '/runs/' || event_id as path, 'ERROR: ' || event_type as result, 1 as retries
      from events where event_type = 'error'""",
    "run_date_ist": f"""
      select strftime({_IST}, '%Y/%m/%d') as run_date, count(*) as n,
        min(strftime({_IST}, '{_TIME}')) as first_time,
        max(strftime({_IST}, '{_TIME}')) as last_time
      from events group by 1""",
    "business_of_file": """
      select event_id, case when event_type <> 'error' then event_type end as business
      from events""",
    "payload_lines": _batched("select * from lines", _LINES),
    "payload_digest": _batched(
        """select "DATA_C_FILENAME", "Notification_Code", (row_no - 1) // 100 as part_no,
          count(*) as n_rows, md5(string_agg(line, chr(10) order by row_no)) as digest
          from lines group by 1, 2, 3""",
        _LINES,
    ),
    "response_classes": _answers("select event_id, status, status_code from classed"),
    "latest_attempt": _answers(
        "select filename, event_id, status, status_code, api_response from latest"
    ),
    "dispatch_report": _answers("select * from report"),
    "response_log": _answers(
        f"""select '{RUN_ID}' as "TRANSACTION_ID", "DATA_C_FILENAME",
          '{{"status":"' || status || '","status_code":'
          || coalesce('"' || status_code || '"', 'null') || ',"api_response":'
          || case when api_response is null then 'null'
                  when api_response like '{{%' then replace(api_response, ' ', '')
                  else '{{"raw":"' || api_response || '"}}' end || '}}'
            as "DATA_C_RESPONSE" from report"""
    ),
    "response_log_parsed": _answers(
        f"""select '{RUN_ID}' as "TRANSACTION_ID", "DATA_C_FILENAME", status, status_code
          from report"""
    ),
    "dispatch_fake_transport": _batched(
        f"""select "DATA_C_FILENAME" as filename, 'success' as status, '200' as status_code,
          {_ANSWER}
          from lines group by 1""",
        _LINES,
    ),
    "dispatch_retried": _batched(
        f"""select "DATA_C_FILENAME" as filename, 3 as attempt, 'success' as status,
          '200' as status_code, {_ANSWER}
          from lines group by 1""",
        _LINES,
    ),
    "primary_run": _batched(_MANIFEST),
    "primary_status": _with(
        'select "APPL_ID", "IMEI", "Notification_Code", "FILTER_STATUS" from status'
    ),
    "primary_init_log": _with(_init(RUN_ID), _PER_STATUS),
    "primary_run_twice": _batched(_STAGED),
    "bulk_run": _batched(_OUTCOMES, _LINES),
    "bulk_after_rerun": _batched(_OUTCOMES, _LINES),
    "run_log_written": f"""
      select * from (values ('{FILE_NAME}', false, 0, (select count(*) from orders)),
        ('noname.csv', true, 1, null), ('X_view_1.csv', true, 1, null),
        ('X_error_2.csv', false, 0, (select count(*) from orders)))
        as t(path, failed, retries, "CG_COUNT")""",
}

# The rival's run, then the other with the rival's rows in its history.
_RIVAL = ("click", "RUN-2")


def _labelled(name: str, business: str, history: str) -> str:
    return f"""{name} as (
  select *, case when "IMEI" is null then 'NULL'
    when coalesce("APPL_ID" in (select "APPL_ID" from overdue), false) then 'DELINQUENT'
    when "IMEI" in (select "IMEI" from {history} where business = '{business}') then 'DUPLICATE_BIZ'
    when "IMEI" in (select "IMEI" from {history} group by 1 having count(*) >= 3)
    then 'DUPLICATE_GLOBAL' else 'UNIQUE_GLOBAL' end as "FILTER_STATUS" from due)"""


_SERIAL = f"""with {_DUE},
{_labelled("rival", _RIVAL[0], "history")},
later as (select * from history union all
  select "IMEI", '{_RIVAL[0]}' from rival where "FILTER_STATUS" = 'UNIQUE_GLOBAL'),
{_labelled("mine", BUSINESS, "later")},
both_runs as (
  select *, '{_RIVAL[0]}' as business, '{_RIVAL[1]}' as transaction_id from rival
  union all select *, '{BUSINESS}', '{RUN_ID}' from mine)
"""

ORACLES |= {
    "race_status": _SERIAL + "select * from both_runs",
    "race_batches": _SERIAL + f"""
      select *, (row_no - 1) // {STEP} as batch_no from (
        select "APPL_ID", "IMEI", "Notification_Code", transaction_id, row_number() over (
          partition by transaction_id, "Notification_Code"
          order by "APPL_ID" nulls first, "IMEI" nulls first) as row_no
        from both_runs where "FILTER_STATUS" = 'UNIQUE_GLOBAL')""",
    "killed_before_commit": _batched(_STAGED),
    "bulk_after_loss": _batched(
        f"""select "DATA_C_FILENAME", case when lost then 'unresolved' else status end as status,
          case when not lost then status_code end as status_code,
          case when not lost then api_response end as api_response
        from (select *, "DATA_C_FILENAME" like '%\\_1\\_REQ.csv' escape '\\' as lost from ({_OUTCOMES}))""",
        _LINES,
    ),
}

_WITHIN_FILE = _with(
    """select "APPL_ID", "IMEI", "Notification_Code",
      case when "FILTER_STATUS" = 'UNIQUE_GLOBAL' and coalesce(n, 0) + place > 3
        then 'DUPLICATE_GLOBAL' else "FILTER_STATUS" end as "FILTER_STATUS"
    from (select *, row_number() over (
        partition by "IMEI", "FILTER_STATUS"
        order by "APPL_ID" nulls first, "Notification_Code" nulls first) as place from status)
    left join sent using ("IMEI")""",
    'sent as (select "IMEI", count(*) as n from history group by 1)',
)
ORACLES |= {"cap_within_file": _WITHIN_FILE, "cap_within_file_shuffled": _WITHIN_FILE}

ORACLES |= {
    "overdue_from_log": 'select l_orderkey as "APPL_ID" from lineitem where l_quantity > 40',
    "overdue_from_log_as_of": """select l_orderkey as "APPL_ID" from lineitem
      where l_quantity > 40 and l_returnflag <> 'A'""",
    "loans_from_log": """select l_orderkey as "APPL_ID",
      cast(l_quantity - 40 as double) as "INSTALLMENT_OVERDUE",
      case when l_returnflag = 'R' then 1 else 0 end as "BUCKET" from lineitem""",
}

ORACLES |= {
    "cascade_compacted": ORACLES["cascade_status"],
    "cascade_compacted_shuffled": ORACLES["cascade_status"],
    "compacted_day": f"""with {_DUE}
      select "IMEI", business, count(*) as sent from history where "IMEI" is not null group by 1, 2""",
}
