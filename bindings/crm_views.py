"""The shared test tables seen as CRM objects.

Each view is portable SQL over whole tables, so the same text feeds the Spark jobs and the checks.
Order dates run 1995-01-01..2001-08-01; they are moved forward by 9,131 days to 2020-01-01..2026-08-01
so that the fixed calendar and the target table apply. The clock is fixed at ``AS_OF``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(2026, 8, 2)
LEDGER_AS_OF = datetime(2024, 1, 31)

TABLES = "region nation customer supplier part orders lineitem events".split()

# Stage names in order.
STAGES = [
    "Prospecting",
    "Qualification",
    "Needs Analysis",
    "Value Proposition",
    "Id. Decision Makers",
    "Perception Analysis",
    "Proposal/Price Quote",
    "Negotiation/Review",
    "Closed Won",
    "Closed Lost",
]


def _pick(expr: str, names: list[str]) -> str:
    whens = " ".join(f"when {i} then '{n}'" for i, n in enumerate(names))
    return f"case {expr} {whens} end"


_OPEN = STAGES[:8]
_STATUS = ["Open - Not Contacted", "Working - Contacted", "Closed - Not Converted", "Closed - Converted", "Recycled"]
_FINAL_STAGE = (
    "case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost' else "
    + _pick("(o_orderkey * 5) % 8", _OPEN)
    + " end"
)

VIEWS: dict[str, str] = {
    "User": """
        select s_suppkey as id, s_name as name,
               case when s_suppkey % 17 = 0 then null else 'u' || cast(s_suppkey % 90 as string) || '@example.com' end as email,
               case when s_suppkey % 10 = 0 then null else cast(floor(s_suppkey / 10.0) as bigint) end as managerid,
               n_name as department, s_suppkey % 7 <> 0 as isactive,
               date '2019-01-01' + cast(s_suppkey % 365 as int) as createddate,
               date '2019-06-01' + cast(s_suppkey % 700 as int) as systemmodstamp
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "Account": """
        select c_custkey as id, c_name as name, c_mktsegment as industry,
               case when c_custkey % 3 = 0 then 'Customer' else 'Prospect' end as type,
               cast(cast(c_acctbal as decimal(18,2)) * 200000 as decimal(38,2)) as annualrevenue,
               case when c_custkey % 11 = 0 then null else cast((c_custkey * 37) % 7000 as int) end as numberofemployees,
               n_name as billingcountry, 'R' || cast(n_regionkey as string) as billingstate,
               case when c_custkey % 5 = 0 then null else cast(floor(c_custkey / 5.0) as bigint) end as parentid,
               c_custkey % 10 as ownerid, c_custkey % 97 = 13 as isdeleted,
               date '2019-06-01' + cast(c_custkey % 200 as int) as createddate,
               date '2019-12-01' + cast(c_custkey % 900 as int) as systemmodstamp
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "Contact": """
        select c_custkey as id, c_custkey as accountid, c_name as name, c_custkey % 10 as ownerid,
               case when c_custkey % 23 = 0 then null else 'c' || cast(c_custkey as string) || '@example.com' end as email,
               case when c_custkey % 2 = 0 then 'Manager' else 'Analyst' end as title,
               case when c_custkey % 6 = 0 then null when c_custkey % 2 = 0 then 'Web' else 'Referral' end as leadsource,
               c_custkey % 71 = 5 as isdeleted,
               date '2019-06-01' + cast(c_custkey % 300 as int) as createddate,
               date '2020-01-01' + cast(c_custkey % 900 as int) as systemmodstamp
        from {customer}""",
    "Lead": f"""
        select c_custkey as id, c_name as name, c_mktsegment as industry, c_custkey % 10 as ownerid,
               'Company ' || cast(c_custkey % 500 as string) as company,
               case when c_custkey % 19 = 0 then null else 'l' || cast(c_custkey as string) || '@example.com' end as email,
               {_pick("c_custkey % 5", _STATUS)} as status,
               case when c_custkey % 6 = 0 then null when c_custkey % 2 = 0 then 'Web' else 'Event' end as leadsource,
               case when c_custkey % 13 = 0 then null else cast((c_custkey * 53) % 8000 as int) end as numberofemployees,
               cast(cast(c_acctbal as decimal(18,2)) * 1000 as decimal(38,2)) as annualrevenue,
               c_custkey % 4 = 0 as isconverted,
               case when c_custkey % 4 = 0 then date '2026-02-10' + cast(c_custkey % 90 as int) end as converteddate,
               case when c_custkey % 4 = 0 then c_custkey end as convertedaccountid,
               case when c_custkey % 4 = 0 then c_custkey * 7 end as convertedopportunityid,
               c_custkey % 61 = 7 as isdeleted,
               date '2025-11-01' + cast(c_custkey % 60 as int) as createddate,
               date '2026-02-01' + cast(c_custkey % 150 as int) as systemmodstamp
        from {{customer}}""",
    "Opportunity": f"""
        select *, cast(quarter(closedate) as int) as fiscalquarter,
               cast(year(closedate) as int) as fiscalyear
        from (
          select o_orderkey as id, 'Deal ' || cast(o_orderkey as string) as name,
               case o_orderpriority when '1-URGENT' then 'New Business' when '2-HIGH' then 'Renewal'
                    when '3-MEDIUM' then 'Upsell' when '5-LOW' then 'Cross-Sell' else 'Existing' end as type,
               o_custkey as accountid, o_orderkey % 10 as ownerid,
               case when o_orderkey % 4 = 0 then null else o_orderkey % 200 end as campaignid,
               {_FINAL_STAGE} as stagename,
               case o_orderstatus when 'F' then 'Closed' when 'P' then 'Omitted' else 'Pipeline' end as forecastcategory,
               case when o_orderstatus = 'O' and o_orderkey % 307 = 11 then -cast(o_totalprice as decimal(18,2))
                    else cast(o_totalprice as decimal(18,2)) end as amount,
               case when o_orderkey % 3 = 0 then cast(o_totalprice as decimal(18,2)) end as expectedrevenue,
               cast((o_orderkey * 7) % 101 as decimal(5,2)) as probability,
               cast(o_orderkey % 40 as decimal(18,4)) as totalopportunityquantity,
               case when o_orderkey % 101 = 3 then null else cast(o_orderdate + interval 9176 days as date) end as closedate,
               case when o_orderkey % 211 = 7 then null else o_orderstatus in ('F','P') end as isclosed,
               case when o_orderkey % 211 = 7 then null else o_orderstatus = 'F' end as iswon,
               case when o_orderkey % 6 = 0 then null when o_orderkey % 2 = 0 then 'Web' else 'Partner' end as leadsource,
               o_orderkey % 89 = 5 as isdeleted,
               o_orderdate + interval 9131 days as createddate,
               o_orderdate + interval 9181 days as systemmodstamp
          from {{orders}}) as o""",
    "OpportunityLineItem": """
        select l_orderkey * 10 + l_linenumber as id, l_orderkey as opportunityid, l_partkey as product2id,
               l_suppkey as pricebookentryid, p_name as name, p_brand as productcode,
               cast(l_quantity as decimal(18,4)) as quantity, cast(p_retailprice as decimal(18,2)) as listprice,
               cast(l_extendedprice as decimal(18,2)) as totalprice, l_linenumber as sortorder,
               l_shipdate + interval 9131 days as systemmodstamp
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "Campaign": """
        select p_partkey as id, p_name as name, p_type as type,
               case when p_partkey % 2 = 0 then 'Completed' else 'In Progress' end as status,
               case when p_partkey % 4 = 0 then null else cast(floor(p_partkey / 4.0) as bigint) end as parentid,
               p_partkey % 10 as ownerid,
               date '2025-06-01' + cast(p_partkey % 100 as int) as startdate,
               case when p_partkey % 9 = 0 then null else date '2025-12-01' + cast(p_partkey % 60 as int) end as enddate,
               cast(p_retailprice as decimal(18,2)) as budgetedcost,
               case when p_partkey % 13 = 0 then cast(0 as decimal(18,2)) else cast(p_retailprice as decimal(18,2)) - 1.5 end as actualcost,
               p_partkey % 50 as numberofleads, p_partkey % 40 as numberofcontacts, p_partkey % 30 as numberofresponses,
               p_partkey % 70 as numberofopportunities, p_partkey % 20 as numberofwonopportunities,
               p_partkey % 5 <> 0 as isactive,
               date '2025-05-01' + cast(p_partkey % 30 as int) as createddate,
               date '2025-06-01' + cast(p_partkey % 200 as int) as systemmodstamp
        from {part}""",
    "CampaignMember": """
        select event_id as id, event_id % 200 as campaignid,
               case when user_id % 2 = 0 then user_id end as leadid,
               case when user_id % 2 = 1 then user_id end as contactid,
               event_type as status,
               case when event_type = 'error' then null else event_type in ('click','purchase','signup') end as hasresponded,
               case when event_type in ('click','purchase','signup') then cast(ts + interval 741 days as date) end as firstrespondeddate,
               event_id % 97 = 2 as isdeleted,
               ts + interval 731 days as createddate, ts + interval 735 days as systemmodstamp
        from {events}""",
    "Task": """
        select event_id as id, event_type as subject,
               case when event_id % 3 = 0 then 'Completed' else 'Not Started' end as status,
               case when event_id % 5 = 0 then 'High' else 'Normal' end as priority,
               user_id as whoid, user_id as whatid, event_id % 10 as ownerid,
               cast(ts + interval 731 days as date) as activitydate, event_id % 5 = 0 as ishighpriority,
               event_id % 83 = 1 as isdeleted,
               ts + interval 731 days as createddate, ts + interval 732 days as systemmodstamp
        from {events}""",
    "Event": """
        select event_id as id, event_type as subject, user_id as whoid, user_id as whatid, event_id % 10 as ownerid,
               ts + interval 900 days as activitydatetime, ts + interval 900 days + interval 45 minutes as enddatetime,
               45 as durationinminutes, event_id % 50 = 0 as isalldayevent, event_id % 7 = 0 as isprivate,
               event_id % 79 = 3 as isdeleted,
               ts + interval 899 days as createddate, ts + interval 901 days as systemmodstamp
        from {events}""",
    # Three versions per deal: created, 20 days later, 50 days later.
    "OpportunityVersion": f"""
        select o_orderkey as id, 1 as version, {_pick("o_orderkey % 3", STAGES[:3])} as stagename,
               cast(o_totalprice as decimal(18,2)) - 10 as amount, cast(10 + o_orderkey % 30 as decimal(5,2)) as probability,
               cast(o_orderdate + interval 9191 days as date) as closedate, false as isclosed, false as iswon,
               o_orderkey % 10 as ownerid, false as isdeleted, o_orderdate + interval 9131 days as systemmodstamp from {{orders}}
        union all
        select o_orderkey as id, 2 as version, {_pick("o_orderkey % 8", _OPEN)} as stagename,
               cast(o_totalprice as decimal(18,2)) + 5 as amount, cast(20 + o_orderkey % 60 as decimal(5,2)) as probability,
               cast(o_orderdate + interval 9176 days as date) as closedate, false as isclosed, false as iswon,
               o_orderkey % 10 as ownerid, false as isdeleted, o_orderdate + interval 9151 days as systemmodstamp from {{orders}}
        union all
        select o_orderkey as id, 3 as version, {_FINAL_STAGE} as stagename,
               cast(o_totalprice as decimal(18,2)) as amount, cast((o_orderkey * 7) % 101 as decimal(5,2)) as probability,
               cast(o_orderdate + interval 9176 days as date) as closedate,
               o_orderstatus in ('F','P') as isclosed, o_orderstatus = 'F' as iswon,
               o_orderkey % 10 as ownerid, o_orderkey % 89 = 5 as isdeleted, o_orderdate + interval 9181 days as systemmodstamp
        from {{orders}}""",
    # Two versions per account.
    "AccountVersion": """
        select c_custkey as id, 1 as version, c_mktsegment as industry, c_custkey % 10 as ownerid,
               date '2019-06-01' + cast(c_custkey % 400 as int) as systemmodstamp from {customer}
        union all
        select c_custkey as id, 2 as version, 'MOVED ' || c_mktsegment as industry, (c_custkey + 3) % 10 as ownerid,
               date '2022-01-01' + cast(c_custkey % 900 as int) as systemmodstamp from {customer}""",
    # The events table as load, usage and query history.
    "LoadHistory": """
        select event_type as pipe_name, 'file_' || cast(event_id as string) as file_name, ts as last_load_time,
               case when event_id % 2 = 0 then ts - interval 90 seconds else ts - interval 15 seconds end as first_error_timestamp,
               event_id % 1000 as row_count,
               case when event_type = 'error' then 1 + event_id % 3 else 0 end as error_count,
               case when event_type = 'error' then 'bad value' end as first_error_message,
               case when event_type = 'error' then event_id % 77 end as first_error_line_number,
               case when event_type = 'error' then 'AMOUNT' end as first_error_column_name
        from {events}""",
    "UsageHistory": """
        select event_type as pipe_name, 'WH_' || cast(user_id % 4 as string) as warehouse_name, ts as start_time,
               cast(value as decimal(18,4)) as credits_used
        from {events}""",
    "QueryHistory": """
        select event_id as query_id, case when event_id % 3 = 0 then 'adhoc' else 'build_' || event_type end as query_tag,
               'select ' || cast(event_id as string) as query_text, 'WH_' || cast(user_id % 4 as string) as warehouse_name,
               case when event_id % 2 = 0 then 'SELECT' else 'MERGE' end as query_type,
               case when event_type = 'error' then 'FAIL' else 'SUCCESS' end as execution_status,
               cast(floor(value * 1000) as bigint) as execution_time, event_id * 7919 * 65536 as bytes_scanned,
               event_id % 5000 as rows_produced, cast(value as decimal(18,4)) as credits_used_cloud_services,
               ts as start_time
        from {events}""",
    "TaskRun": """
        select case when event_id % 2 = 0 then 'TASK_DEDUP_' else 'TASK_LOAD_' end || upper(event_type) as name,
               case when event_type = 'error' then 'FAILED' else 'SUCCEEDED' end as state, event_id as run_id,
               ts as scheduled_time,
               case when event_id % 3 = 0 then ts + interval 75 seconds else ts + interval 3600 seconds end as completed_time
        from {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, opened: dict[str, DataFrame] | None = None) -> DataFrame:
    """The named CRM view over the tables in ``sf_dir``; ``opened`` keeps tables already looked up."""
    text, opened = VIEWS[name], {} if opened is None else opened
    used = [t for t in TABLES if "{" + t + "}" in text]
    for t in used:
        if t not in opened:
            opened[t] = table(spark, sf_dir, t)
    return spark.sql(text, **{t: opened[t] for t in used})


def view_sql(name: str) -> str:
    return VIEWS[name].format(**{t: t for t in TABLES})
