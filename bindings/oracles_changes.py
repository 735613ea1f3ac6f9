"""Checking SQL for the queries in ``queries_changes``."""

from __future__ import annotations

from bindings.oracles_marts import SPECS
from bindings.sql_base import STG, out, with_ctes

ORACLES: dict[str, str] = {}
_LINE = "id opportunityid product2id pricebookentryid quantity:m totalprice:m systemmodstamp"
ORACLES["dedup_latest"] = with_ctes(out("v_LineItemLatest", _LINE))
ORACLES["dedup_latest_since"] = with_ctes(
    out("v_LineItemLatest", _LINE) + " where systemmodstamp >= timestamp '2024-03-01 00:20:00'"
)
ORACLES["compact_dedup"] = ORACLES["dedup_latest"]
ORACLES["exclude_deleted"] = with_ctes(
    out("v_Opportunity", "id name amount:m") + " where not coalesce(isdeleted, false)"
)
ORACLES["incremental_extract"] = with_ctes(
    """select id as "Id", stagename as "StageName", cast(amount as double) as "Amount", cast(closedate as varchar) as "CloseDate",
        cast(iswon as varchar) as "IsWon", leadsource as "LeadSource", systemmodstamp as "SystemModstamp",
        cast(null as varchar) as "NextStep"
    from v_Opportunity where systemmodstamp >= timestamp '2024-02-29 23:50:00'"""
)
ORACLES["incremental_filter"] = with_ctes(
    """select id, systemmodstamp from v_Opportunity where systemmodstamp >= (
        select max(systemmodstamp) - interval 3 days from v_Opportunity
        where systemmodstamp < date '2025-01-01' and not coalesce(isdeleted, false))"""
)
ORACLES["watermark_get_all"] = with_ctes(
    " union all ".join(
        f"select '{o}' as object, strftime(cast(max(systemmodstamp) as timestamp), '%Y-%m-%dT%H:%M:%S+00:00') as watermark from v_{o}"
        for o in STG
        if o != "User"
    )
    + " union all select 'User', '2020-01-01T00:00:00+00:00'"
)
ORACLES["run_log"] = with_ctes(
    " union all ".join(
        f"select '{o}' as object, 'success' as status, count(*) as records, '2019-12-31T23:30:00+00:00' as watermark_used, "
        f"1 as attempts from v_{o} where systemmodstamp >= timestamp '2019-12-31 23:30:00'"
        for o in STG
    )
)
_MERGED = """
    select {cols} from v_OpportunityVersion a
    left join (select * from v_OpportunityVersion where version = 3 and systemmodstamp >= date '2023-01-01') b on a.id = b.id
    where a.version = 1 {where}"""
_NEW_OR_OLD = ", ".join(
    f"case when b.id is null then a.{c} else b.{c} end as {c}" for c in "id version stagename amount isclosed systemmodstamp".split()
)
ORACLES["merge_upsert"] = with_ctes(
    out(
        f"({_MERGED.format(cols=_NEW_OR_OLD, where='and not coalesce(b.isdeleted, false)')}) as m",
        "id version stagename amount:m isclosed:b systemmodstamp",
    )
)
ORACLES["upsert_table"] = ORACLES["merge_upsert"]
_LIVE = "(b.id is not null and not b.isdeleted)"
_SYNCED = (
    f"a.id, case when {_LIVE} then b.version else a.version end as version, case when {_LIVE} then b.amount else a.amount end as amount, "
    f"case when {_LIVE} then b.isclosed else a.isclosed end as isclosed, "
    f"case when {_LIVE} then b.systemmodstamp else a.systemmodstamp end as systemmodstamp, "
    f"case when {_LIVE} then 'R' || cast(a.id % 3 as varchar) end as region"
)
ORACLES["sync_columns"] = with_ctes(
    out(f"({_MERGED.format(cols=_SYNCED, where='')}) as m", "id version amount:m isclosed:b systemmodstamp region")
)

# Versions each of the three runs sees; a deal deleted by the last run is closed at its time.
_SEEN = " union ".join(
    f"""select id, stagename, amount, systemmodstamp, isdeleted from (
        select *, row_number() over (partition by id order by systemmodstamp desc) as rn from v_OpportunityVersion
        where systemmodstamp <= timestamp '{run}') where rn = 1"""
    for run in ("2022-01-01 00:00:00", "2024-01-01 00:00:00", "2027-01-01 00:00:00")
)
ORACLES["scd2_snapshot"] = with_ctes(
    f"""select id as opportunity_id, stagename as stage_name, cast(amount as double) as amount, systemmodstamp as updated_at,
        md5(cast(id as varchar) || '|' || cast(systemmodstamp as varchar)) as scd_id, systemmodstamp as valid_from,
        case when next_deleted then gone_at else next_at end as valid_to, systemmodstamp as source_updated_at
    from (select *, lead(systemmodstamp) over w as next_at, lead(isdeleted) over w as next_deleted,
            case when lead(systemmodstamp) over w <= timestamp '2022-01-01 00:00:00' then timestamp '2022-01-01 00:00:00'
                 when lead(systemmodstamp) over w <= timestamp '2024-01-01 00:00:00' then timestamp '2024-01-01 00:00:00'
                 else timestamp '2027-01-01 00:00:00' end as gone_at
          from ({_SEEN}) as seen window w as (partition by id order by systemmodstamp))
    where not isdeleted"""
)
ORACLES["scd2_snapshot_table"] = ORACLES["scd2_snapshot"]
ORACLES["scd2_build"] = with_ctes(
    "select id as opportunity_id, stage_name, cast(amount as double) as amount, cast(probability_pct as double) as probability_pct, "
    "cast(close_date as varchar) as close_date, scd_id, valid_from, valid_to from opp_history"
)
ORACLES["history_late_versions"] = ORACLES["scd2_build"]
ORACLES["as_of"] = with_ctes(
    """select id as opportunity_id, stage_name, cast(amount as double) as amount, valid_from, valid_to from opp_history
    where valid_from <= timestamp '2025-06-15 12:00:00' and (valid_to is null or valid_to > timestamp '2025-06-15 12:00:00')"""
)
ORACLES["as_of_join"] = with_ctes(
    """select o.opportunity_id, o.account_id, o.created_at, cast(o.amount as double) as amount, h.industry as industry_then,
        h.ownerid as owner_then
    from stg_opportunities o left join acct_history h
      on o.account_id = h.id and h.valid_from <= o.created_at and (h.valid_to is null or o.created_at < h.valid_to)"""
)


def fingerprint(name: str, spec: str, source: str) -> str:
    """Rows and the sum of 48 bits of every row's digest; amounts are compared to the cent."""
    names = sorted(w.split(":")[0] for w in spec.split() if w != "built_at")
    amount = lambda n: f"typeof({n}) = 'DOUBLE' or typeof({n}) like 'DECIMAL%'"
    text = [f"coalesce(case when {amount(n)} then cast(try_cast({n} as decimal(38,2)) as varchar) else cast({n} as varchar) end, '~')" for n in names]
    bits = f"cast('0x' || md5(concat_ws('|', {', '.join(text)}))[1:12] as bigint)"
    return f"select '{name}' as table_name, count(*) as row_count, cast(coalesce(sum({bits}), 0) as varchar) as fingerprint from {source}"


_FACTS = ["fct_sales_pipeline", "fct_bookings", "fct_win_rate", "fct_campaign_performance", "fct_demand_generation"]
_MARTS = [*STG.values(), "dim_account", "dim_contact", "dim_lead", "dim_user", "dim_campaign", *_FACTS]
# Each raw row has one version here, so history holds every staged row once, open since its modification.
_HISTORY = {"history_accounts": "account_id", "history_contacts": "contact_id", "history_leads": "lead_id", "history_opportunities": "opportunity_id"}
_CALENDAR = "(select cast(d as date) as date_id from generate_series(date '2020-01-01', date '2030-12-31', interval 1 day) as t(d))"
ORACLES["build_marts"] = with_ctes(
    " union all ".join(fingerprint(t, SPECS[t], t) for t in _MARTS)
    + " union all "
    + " union all ".join(
        fingerprint(
            h, f"{SPECS[f'stg_{h[8:]}']} scd_id valid_from valid_to source_updated_at",
            f"""(select *, md5(cast({k} as varchar) || '|' || cast(updated_at as varchar)) as scd_id, updated_at as valid_from,
                 cast(null as timestamp) as valid_to, updated_at as source_updated_at from stg_{h[8:]})""",
        )
        for h, k in _HISTORY.items()
    )
    + " union all " + fingerprint("dim_date", "date_id:d", _CALENDAR)
)
ORACLES["incremental_facts"] = with_ctes(" union all ".join(fingerprint(t, SPECS[t], t) for t in _FACTS))
_STAGED = "select opportunity_id, cast(amount as double) as amount, updated_at from stg_opportunities"
ORACLES["staging_full_refresh"] = with_ctes(_STAGED + " where updated_at >= timestamp '2024-01-01 00:00:00'")
ORACLES["staging_connector"] = with_ctes(_STAGED)
ORACLES["project_keeps_deleted"] = with_ctes(
    "select id as account_id, name as account_name, cast(isdeleted as varchar) as is_deleted, "
    "cast(annualrevenue as double) as annual_revenue from v_Account"
)
