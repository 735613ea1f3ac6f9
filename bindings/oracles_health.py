"""Checking SQL for the queries in ``queries_health``."""

from __future__ import annotations

from bindings.sql_base import AS_OF, LEDGER_AS_OF, with_ctes

ORACLES: dict[str, str] = {}


ORACLES["dq_not_null"] = with_ctes(
    "select opportunity_id, account_id, cast(amount as double) as amount from fct_sales_pipeline where account_sk is null"
)
ORACLES["dq_unique"] = with_ctes(
    "select email, count(*) as n_records from stg_users where email is not null group by email having count(*) > 1"
)
ORACLES["dq_accepted_values"] = with_ctes(
    "select lead_id, status from stg_leads where status not in "
    "('Open - Not Contacted', 'Working - Contacted', 'Closed - Not Converted', 'Closed - Converted', 'Nurturing')"
)
ORACLES["dq_accepted_range"] = with_ctes(
    "select opportunity_id, cast(amount as double) as amount from stg_opportunities where amount < 0 or amount > 400000"
)
ORACLES["dq_not_negative"] = with_ctes(
    "select cast(amount as double) as amount, count(*) as failure_count from stg_opportunities where amount < 0 group by amount"
)
ORACLES["dq_amount_no_close"] = with_ctes(
    """select opportunity_id, opportunity_name, cast(amount as double) as amount, cast(close_date_id as varchar) as close_date_id
    from fct_sales_pipeline where close_date_id is null and amount > 0"""
)
ORACLES["dq_won_in_pipeline"] = with_ctes(
    """select b.opportunity_id from fct_bookings b join opp_history h on b.opportunity_id = h.id
    where not h.is_closed and h.valid_from <= timestamp '2024-03-31 00:00:00'
      and (h.valid_to is null or h.valid_to > timestamp '2024-03-31 00:00:00')"""
)
ORACLES["dq_booking_missing_winrate"] = with_ctes(
    """select b.opportunity_id from fct_bookings b
    left join (select opportunity_id from fct_win_rate where close_date < date '2025-01-01') as w on b.opportunity_id = w.opportunity_id
    where w.opportunity_id is null"""
)
_FRESH = {
    "account": "stg_accounts", "contact": "stg_contacts", "lead": "stg_leads", "opportunity": "stg_opportunities",
    "campaign": "stg_campaigns", "user": "stg_users",
}
_AGE = f"date_diff('second', latest_load, cast({AS_OF} as timestamp))"
ORACLES["dq_freshness"] = with_ctes(
    f"""select source_name, latest_load, date_diff('hour', latest_load, cast({AS_OF} as timestamp)) as age_hours,
        case when {_AGE} > 31536000 then 'error' when {_AGE} > 5184000 then 'warn' else 'pass' end as status
    from ({" union all ".join(f"select '{n}' as source_name, max(updated_at) as latest_load from {t}" for n, t in _FRESH.items())})"""
)


# The standing checks as the data contracts state them: table, column, kinds; "?" marks a warning.
_KEYED = """
    src_account id; src_contact id; src_lead id; src_opportunity id; src_opportunity_line_item id; src_campaign id;
    src_campaign_member id; src_task id; src_event id; src_user id; opportunity_enriched opportunity_id; lead_enriched lead_id;
    stage_order stage_name; bookings_targets fiscal_quarter_label;
    stg_accounts account_id; stg_contacts contact_id; stg_leads lead_id; stg_opportunities opportunity_id;
    stg_line_items opportunity_line_item_id; stg_campaigns campaign_id; stg_campaign_members campaign_member_id; stg_tasks task_id;
    stg_events event_id; stg_users user_id; dim_account account_sk; dim_account account_id; dim_contact contact_sk;
    dim_contact contact_id; dim_lead lead_sk; dim_lead lead_id; dim_user user_sk; dim_user user_id; dim_campaign campaign_sk;
    dim_campaign campaign_id; fct_sales_pipeline pipeline_id; fct_sales_pipeline opportunity_id; fct_bookings booking_id;
    fct_bookings opportunity_id; fct_win_rate win_rate_id; fct_win_rate opportunity_id;
    fct_campaign_performance campaign_performance_id; fct_campaign_performance campaign_id; fct_demand_generation demand_gen_id;
    fct_demand_generation campaign_member_id"""
_FILLED = """
    stage_order stage_order; stg_accounts account_name owner_id updated_at; stg_contacts account_id updated_at; stg_leads updated_at;
    stg_opportunities account_id close_date stage_name; stg_line_items opportunity_id; stg_campaign_members campaign_id;
    stg_users email; dim_account account_name; dim_user email; fct_sales_pipeline account_sk close_date_id;
    fct_bookings booking_amount booking_date_id; fct_win_rate is_won is_lost; fct_campaign_performance campaign_name;
    fct_demand_generation campaign_id is_mql is_sql is_customer"""
_SEGMENTS = "('SMB', 'Mid-Market', 'Enterprise', 'Strategic', 'Unknown')"
# Accepted texts and ranges.
_STATUSES = "('Open - Not Contacted', 'Working - Contacted', 'Closed - Not Converted', 'Closed - Converted', 'Nurturing')"
_ACCEPTED = [
    ("stg_leads", "status", "warn", _STATUSES),
    ("dim_account", "employee_segment", "error", _SEGMENTS),
    ("dim_account", "revenue_segment", "error", _SEGMENTS),
    ("fct_bookings", "booking_category", "error", "('New Logo', 'Renewal', 'Expansion', 'Other')"),
    ("fct_win_rate", "deal_size_band", "error", "('Small  (< $10K)', 'Mid    ($10K–$50K)', 'Large  ($50K–$250K)', 'Enterprise ($250K+)', 'Unknown')"),
    ("fct_demand_generation", "member_type", "error", "('Lead', 'Contact')"),
]
_RANGES = [
    ("stg_opportunities", "amount", "warn", "{c} < 0"),
    ("fct_sales_pipeline", "amount", "warn", "{c} < 0"),
    ("fct_sales_pipeline", "probability_pct", "error", "{c} < 0 or {c} > 100"),
    ("fct_bookings", "booking_amount", "error", "{c} < 0"),
    ("fct_campaign_performance", "response_rate_pct", "warn", "{c} < 0 or {c} > 100"),
]
# Names of the checked tables that are no named subquery themselves.
_TABLES = {
    **{f"src_{n}": f"v_{v}" for n, v in {"account": "Account", "contact": "Contact", "lead": "Lead", "opportunity": "Opportunity", "campaign": "Campaign", "campaign_member": "CampaignMember", "task": "Task", "event": "Event", "user": "User"}.items()},
    "src_opportunity_line_item": "v_LineItemLatest", "opportunity_enriched": "enriched", "lead_enriched": "leads_enriched",
    "stage_order": "stage_seed", "bookings_targets": "target_seed",
}


def _words(text: str) -> list[list[str]]:
    return [part.split() for part in text.split(";")]


def _check(table: str, column: str, kind: str, severity: str, condition: str) -> str:
    source = _TABLES.get(table, table)
    failing = f"select {column} from {source} where {column} is not null group by 1 having count(*) > 1" if kind == "unique" else f"select 1 from {source} where {condition}"
    return f"select '{table}' as table_name, '{column}' as column_name, '{kind}' as check_name, '{severity}' as severity, (select count(*) from ({failing})) as failures"


_CHECKED = [
    *[_check(t, c, kind, "error", f"{c} is null") for t, c in _words(_KEYED) for kind in ("not_null", "unique")],
    *[_check(t, c, "not_null", "error", f"{c} is null") for t, *cs in _words(_FILLED) for c in cs],
    *[_check(t, "email", "unique", "warn", "") for t in ("stg_users", "dim_user")],
    *[_check(t, c, "accepted_values", sev, f"{c} not in {values}") for t, c, sev, values in _ACCEPTED],
    *[_check(t, c, "accepted_range", sev, cond.format(c=c)) for t, c, sev, cond in _RANGES],
]
ORACLES["dq_run"] = with_ctes(f"select *, case when failures = 0 then 'pass' else severity end as status from ({' union all '.join(_CHECKED)})")
ORACLES["dq_failing_rows"] = with_ctes(
    f"""select 'stg_opportunities' as table_name, concat_ws(',', case when amount < 0 then 'accepted_range(amount)' end,
            case when account_id is null then 'not_null(account_id)' end, case when close_date is null then 'not_null(close_date)' end,
            case when opportunity_id is null then 'not_null(opportunity_id)' end, case when stage_name is null then 'not_null(stage_name)' end) as checks,
        cast(opportunity_id as varchar) as row_key from stg_opportunities
    where amount < 0 or account_id is null or close_date is null or opportunity_id is null or stage_name is null
    union all select 'stg_leads', 'accepted_values(status)', cast(lead_id as varchar) from stg_leads where status not in {_STATUSES}
    union all select 'stg_users', 'not_null(email)', cast(user_id as varchar) from stg_users where email is null
    union all select 'stg_users', 'unique(email)', email from stg_users where email is not null group by email having count(*) > 1"""
)
_PAIRS = {
    "leads": ("lead_members", "sf_number_of_leads"),
    "contacts": ("contact_members", "sf_number_of_contacts"),
    "responses": ("responded_members", "sf_number_of_responses"),
    "opportunities": ("total_opportunities", "sf_opportunities"),
    "won_opportunities": ("won_opportunities", "sf_won_opportunities"),
}
ORACLES["campaign_reconcile"] = with_ctes(
    " union all ".join(
        f"select campaign_id, '{m}' as measure, {a} as derived, {b} as reported from fct_campaign_performance where {a} is distinct from {b}"
        for m, (a, b) in _PAIRS.items()
    )
)

_WEEK = f"{LEDGER_AS_OF} - interval 7 days"
_MONTH = f"{LEDGER_AS_OF} - interval 30 days"
ORACLES["files_per_pipe_day"] = with_ctes(
    f"""select pipe_name, cast(cast(last_load_time as date) as varchar) as load_date, count(*) as files_loaded,
        cast(sum(row_count) as bigint) as rows_loaded, cast(sum(error_count) as bigint) as errors,
        avg(date_diff('second', first_error_timestamp, last_load_time)) as avg_file_lag_seconds
    from v_LoadHistory where last_load_time >= {_WEEK} group by 1, 2"""
)
ORACLES["failed_files"] = with_ctes(
    f"""select pipe_name, last_load_time, file_name, row_count, error_count, first_error_message, first_error_line_number,
        first_error_column_name from v_LoadHistory where error_count > 0 and last_load_time >= {_WEEK}
    order by last_load_time desc, file_name limit 100"""
)
ORACLES["pipe_cost"] = with_ctes(
    f"""select pipe_name, cast(sum(credits_used) as double) as total_credits,
        cast(sum(credits_used) * cast(3 as decimal(5,2)) as double) as estimated_cost_usd
    from v_UsageHistory where start_time >= {_MONTH} group by 1"""
)
ORACLES["compute_cost_daily"] = with_ctes(
    f"""select warehouse_name, cast(cast(start_time as date) as varchar) as usage_date, cast(sum(credits_used) as double) as credits_used,
        cast(sum(credits_used) * cast(3 as decimal(5,2)) as double) as estimated_cost_usd
    from v_UsageHistory where start_time >= {_MONTH} group by 1, 2"""
)
ORACLES["query_stats"] = with_ctes(
    f"""select warehouse_name, query_type, count(*) as query_count,
        cast(sum(credits_used_cloud_services) as double) as cloud_service_credits,
        avg(execution_time) / 1000 as avg_execution_sec, max(execution_time) / 1000 as max_execution_sec
    from v_QueryHistory where start_time >= {_WEEK} and query_tag like 'build%' and execution_status = 'SUCCESS'
    group by 1, 2 order by 3 desc, 1, 2 limit 50"""
)
ORACLES["slowest_20"] = with_ctes(
    f"""select query_tag, query_text, warehouse_name, cast((execution_time + 50) // 100 as double) / 10 as execution_sec,
        cast((200 * cast(bytes_scanned as hugeint) + 1073741824) // 2147483648 as double) / 100 as gb_scanned, rows_produced, start_time
    from v_QueryHistory where start_time >= {_WEEK} and query_tag like 'build%' and query_type = 'SELECT'
    order by execution_time desc, query_text limit 20"""
)
ORACLES["latency_percentiles"] = with_ctes(
    f"""select cast(cast(start_time as date) as varchar) as run_date, count(*) as queries_run, median(execution_time / 1000) as p50_sec,
        quantile_cont(execution_time / 1000, 0.95) as p95_sec, max(execution_time / 1000) as max_sec
    from v_QueryHistory where start_time >= {_MONTH} and query_tag like 'build%' group by 1"""
)
ORACLES["freshness_report"] = with_ctes(
    " union all ".join(
        f"select '{n}' as view_name, max(updated_at) as latest_load, "
        f"date_diff('minute', max(updated_at), cast({AS_OF} as timestamp)) as minutes_ago from {t}"
        for n, t in _FRESH.items()
    )
)
ORACLES["duplicate_report"] = with_ctes(
    " union all ".join(
        f"select '{n}' as object_name, count(*) as total_rows, count(distinct id) as distinct_ids, "
        f"count(*) - count(distinct id) as duplicate_rows from {v}"
        for n, v in {"OPPORTUNITY_LINE_ITEM": "v_OpportunityLineItem", "ACCOUNT": "v_Account", "LEAD": "v_Lead"}.items()
    )
)
ORACLES["dedup_run_history"] = with_ctes(
    f"""select *, date_diff('second', scheduled_time, completed_time) as duration_sec from v_TaskRun
    where scheduled_time >= {LEDGER_AS_OF} - interval 48 hours and name like 'TASK_DEDUP_%'"""
)
ORACLES["stale_alert"] = with_ctes(
    f"""select * from (select max(last_load_time) as latest_load, date_diff('hour', max(last_load_time), {LEDGER_AS_OF}) as hours_old
        from v_LoadHistory) where hours_old >= 3"""
)
_LOADS = """(select * replace (case when pipe_name = 'purchase' and row_count % 16 < 9 then 2 else error_count end as error_count)
    from v_LoadHistory where pipe_name <> 'view' or last_load_time < date '2024-01-28')"""
_RUNS = f"""(select pipe_name, run, any_value(failed) as failed, count(*) as loads, min(t) as first_load, max(t) as last_load
    from (select *, sum(change) over (partition by pipe_name order by t, file_name) as run from (
            select pipe_name, file_name, last_load_time as t, error_count > 0 as failed,
                   case when failed <> lag(failed) over (partition by pipe_name order by last_load_time, file_name) then 1 else 0 end as change
            from {_LOADS} as loads))
    group by 1, 2)"""
ORACLES["pipe_runs"] = with_ctes(f"select pipe_name, cast(failed as varchar) as failed, loads, first_load, last_load from {_RUNS}")
_STATES = f"""(select *, case when trailing_errors >= 3 then 'ERROR'
        when epoch_us({LEDGER_AS_OF}) - epoch_us(last_load_time) > 5 * usual_gap * 1000000 then 'STALLED' else 'RUNNING' end as state
    from (select pipe_name, case when max_by(failed, run) then max_by(loads, run) else 0 end as trailing_errors, max(last_load) as last_load_time,
                 count(*) filter (where failed) as error_runs, coalesce(max(loads) filter (where failed), 0) as longest_error_run
          from {_RUNS} group by 1)
    left join (select pipe_name, median(gap) / 1000000 as usual_gap from (
            select pipe_name, epoch_us(t) - epoch_us(lag(t) over (partition by pipe_name order by t)) as gap
            from (select distinct pipe_name, last_load_time as t from {_LOADS})) where gap is not null group by 1) using (pipe_name))"""
ORACLES["pipe_states"] = with_ctes(
    f"select pipe_name, state, trailing_errors, error_runs, longest_error_run, usual_gap, last_load_time from {_STATES}"
)
_STATUS = f"""(select l.pipe_name, coalesce(any_value(s.state), 'IDLE') as state, count(*) filter (where d.file_name is null) as pending,
        count(*) filter (where d.error_count > 0) as failed
    from v_LoadHistory l left join (select * from {_LOADS} where pipe_name <> 'signup') as d
      on l.pipe_name = d.pipe_name and l.file_name = d.file_name
    left join (select * from {_STATES} where pipe_name <> 'signup') as s on l.pipe_name = s.pipe_name group by 1)"""
ORACLES["pipe_status"] = with_ctes(f"select * from {_STATUS}")
ORACLES["ingest_health"] = with_ctes(
    f"""select cast(max(pending) as bigint) as max_pending, cast(bool_or(state = 'ERROR') as varchar) as any_pipe_errors,
        cast(max(failed) > 0 as varchar) as any_failed_files, cast(bool_and(state = 'RUNNING') filter (where state <> 'ERROR') as varchar) as all_running,
        count(*) as pipe_count, cast(max(pending) = 0 and not bool_or(state = 'ERROR') as varchar) as all_pipes_ready from {_STATUS}"""
)
