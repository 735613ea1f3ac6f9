"""Checking SQL for the queries in ``queries_ingest``."""

from __future__ import annotations

from bindings.sql_base import with_ctes

ORACLES: dict[str, str] = {}
_DEAL = """cast(id as varchar) as id, name, type, cast(accountid as varchar) as accountid, stagename,
    {amount} as amount, cast(probability as double) as probability, {closedate} as closedate, fiscalquarter,
    cast(isclosed as varchar) as isclosed, {iswon} as iswon, leadsource, createddate, systemmodstamp"""
_PLAIN = {
    "amount": "cast(amount as double)",
    "closedate": "cast(closedate as varchar)",
    "iswon": "cast(iswon as varchar)",
}
ORACLES["scan_ndjson"] = with_ctes(f"select {_DEAL.format(**_PLAIN)} from v_Opportunity")
ORACLES["scan_csv_pages"] = ORACLES["scan_ndjson"]
ORACLES["land_partition_scan"] = ORACLES["scan_ndjson"] + " where systemmodstamp >= date '2023-01-01'"
_SPOILT = {
    "amount": "case when id % 50 in (7, 9) then null else cast(amount as double) end",
    "closedate": "case when id % 70 = 3 then null else cast(closedate as varchar) end",
    "iswon": "case when id % 90 = 4 then null else cast(iswon as varchar) end",
}
ORACLES["load_typed"] = with_ctes(f"select {_DEAL.format(**_SPOILT)} from v_Opportunity")
ORACLES["quarantine_bad_rows"] = with_ctes(
    f"""select cast(id as varchar) as id, {_SPOILT["amount"]} as amount,
        concat_ws(',', case when id % 50 = 7 then 'Amount' end, case when id % 70 = 3 then 'CloseDate' end,
                  case when id % 90 = 4 then 'IsWon' end) as bad_fields
    from v_Opportunity where id % 50 = 7 or id % 70 = 3 or id % 90 = 4"""
)
ORACLES["good_rows"] = with_ctes(
    f"""select cast(id as varchar) as id, {_SPOILT["amount"]} as amount, cast(closedate as varchar) as closedate
    from v_Opportunity where not (id % 50 = 7 or id % 70 = 3 or id % 90 = 4)"""
)
ORACLES["load_metadata"] = with_ctes(
    """select 'Opportunity' as source_object,
        case when systemmodstamp < date '2023-01-01' then timestamp '2026-08-01 06:00:00' else timestamp '2026-08-02 07:30:00' end as extract_timestamp,
        timestamp '2026-08-02 00:00:00' as load_timestamp, count(*) as rows_loaded, count(*) as rows_with_file, 1 as first_row_number
    from v_Opportunity group by 1, 2, 3"""
)
ORACLES["variant_extract"] = """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, json_extract_string(props, '$.new_field') as new_field
    from events"""
ORACLES["append_raw"] = with_ctes(
    "select id, cast(amount as double) as amount, systemmodstamp from v_Opportunity where systemmodstamp >= timestamp '2024-06-10 00:00:00'"
)
ORACLES["auto_ingest"] = with_ctes(
    """select cast(id as varchar) as id, cast(campaignid as varchar) as campaignid, cast(leadid as varchar) as leadid,
        cast(contactid as varchar) as contactid, status, cast(hasresponded as varchar) as hasresponded,
        cast(firstrespondeddate as varchar) as firstrespondeddate, cast(isdeleted as varchar) as isdeleted, createddate
    from v_CampaignMember"""
)
ORACLES["stream_upsert"] = with_ctes(
    "select cast(id as varchar) as id, stagename, cast(amount as double) as amount, systemmodstamp from v_OpportunityVersion where version = 3"
)
ORACLES["scan_csv_headers"] = with_ctes(
    "select * replace (case when cast(id as bigint) % 3 = 1 then null else amount end as amount, "
    f"case when cast(id as bigint) % 3 = 1 then null else leadsource end as leadsource) from (select {_DEAL.format(**_PLAIN)} from v_Opportunity)"
)
ORACLES["ingest_ledger"] = with_ctes(
    """select 'Opportunity' as pipe_name, 0 as pending, count(*) as rows_loaded, n as errors, n as errors_of_failed_files,
        0 as files_without_line, n as bad_rows
    from (select *, count(*) filter (where id % 50 = 7 or id % 70 = 3 or id % 90 = 4) over () as n from v_Opportunity) group by n"""
)
ORACLES["fold_months"] = with_ctes(
    """select cast(cast(date_trunc('month', systemmodstamp) as date) as varchar) as mod_month, count(*) as deals,
        cast(sum(amount) as double) as amount, 'true' as clustered
    from v_Opportunity group by 1"""
)
_SNAKE = {
    "Account": "account", "Contact": "contact", "Lead": "lead", "Opportunity": "opportunity", "OpportunityLineItem": "opportunity_line_item",
    "Campaign": "campaign", "CampaignMember": "campaign_member", "Task": "task", "Event": "event", "User": "user",
}
ORACLES["table_growth"] = with_ctes(
    " union all ".join(f"select '{n}' as table_name, count(*) as row_count, 'true' as sized, 'true' as listed from v_{o}" for o, n in _SNAKE.items())
)
_FOUR = ("Account", "Opportunity", "Campaign", "User")


def _log(status: str, records: str, used: str, watermark: str) -> str:
    return with_ctes(
        " union all ".join(
            f"select '{o}' as object, '{status}' as status, {records.format(o=o)} as records, '{used}' as watermark_used, '{watermark}' as watermark" for o in _FOUR
        )
    )


_SINCE = "(select count(*) from v_{{o}} where systemmodstamp >= timestamp '{}')"
ORACLES["extract_backfill"] = _log("success", _SINCE.format("2021-06-01 00:00:00"), "2021-06-01T00:00:00+00:00", "2022-01-01T00:00:00+00:00")
ORACLES["extract_dry_run"] = _log("dry_run", "0", "2021-12-31T23:30:00+00:00", "2022-01-01T00:00:00+00:00")
ORACLES["extract_incremental"] = _log("success", _SINCE.format("2021-12-31 23:30:00"), "2021-12-31T23:30:00+00:00", "2026-08-01T06:00:00+00:00")
