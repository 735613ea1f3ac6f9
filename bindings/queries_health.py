"""Registered queries: data-quality checks and load health."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from bindings.crm import LINE_ITEM_ORDER, Crm, show
from bindings.crm_views import AS_OF, LEDGER_AS_OF
from revstream.catalog import OBJECTS, source_name
from revstream.operators import quality
from revstream.operators.dedup import dedup_latest, newest_first
from revstream.operators.scd import as_of
from revstream.plans import facts, monitor
from revstream.plans.staging import stage
from revstream.session import Scratch, scratch, scratch_dir, shuffles_released
from revstream.sources import seeds
from revstream.sources.tables import Table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: show(fn(Crm(spark, sf_dir)))
    return fn


@query
def dq_not_null(c: Crm):
    return quality.not_null(c.pipeline, "account_sk").select("opportunity_id", "account_id", "amount")


@query
def dq_unique(c: Crm):
    return quality.unique(c.users, "email")


@query
def dq_accepted_values(c: Crm):
    return quality.accepted_values(c.leads, "status", list(quality.LEAD_STATUSES)).select("lead_id", "status")


@query
def dq_accepted_range(c: Crm):
    return quality.accepted_range(c.opportunities, "amount", low=0, high=400_000).select("opportunity_id", "amount")


@query
def dq_not_negative(c: Crm):
    return quality.not_negative(c.opportunities, "amount")


@query
def dq_amount_no_close(c: Crm):
    return quality.amount_without_close_date(c.pipeline)


@query
def dq_won_in_pipeline(c: Crm):
    """Won deals still in a pipeline table last refreshed on 2024-03-31."""
    stale = as_of(c.opportunity_history, date(2024, 3, 31)).filter("not is_closed")
    return quality.won_in_pipeline(c.bookings, stale)


@query
def dq_booking_missing_winrate(c: Crm):
    """Bookings absent from a win-rate table last refreshed at the end of 2024."""
    stale = c.win_rate.filter("close_date < date '2025-01-01'")
    return quality.booking_missing_in_win_rate(c.bookings, stale)


def _staged(c: Crm) -> dict:
    return {
        "account": c.accounts,
        "contact": c.contacts,
        "lead": c.leads,
        "opportunity": c.opportunities,
        "campaign": c.campaigns,
        "user": c.users,
    }


@query
def dq_freshness(c: Crm):
    return quality.freshness(_staged(c), AS_OF, column="updated_at", warn_hours=24 * 60, error_hours=24 * 365)


def _checked(c: Crm, store: Scratch | None = None) -> dict:
    """Every table with standing checks.

    Line items are deduplicated and stored once for three of them, enriched deals joined and stored once for four, and
    so are other joined frames with several checks.
    """
    store = store or Scratch(c.spark)
    lines = store(dedup_latest(c.raw("OpportunityLineItem"), "id", newest_first(*LINE_ITEM_ORDER)), "lines")
    c.line_items = stage(lines, "OpportunityLineItem")
    deals = store(c.enriched(store=store), "enriched")
    sources = {f"src_{source_name(o)}": c.raw(o) for o in OBJECTS if o != "OpportunityLineItem"}
    return {
        **{name: df.select("id") for name, df in sources.items()}, "src_opportunity_line_item": lines.select("id"),
        "stg_accounts": c.accounts, "stg_contacts": c.contacts, "stg_leads": c.leads, "stg_line_items": c.line_items,
        "stg_opportunities": c.opportunities, "stg_campaigns": c.campaigns, "stg_campaign_members": c.members,
        "stg_tasks": c.tasks, "stg_events": c.events, "stg_users": c.users,
        "opportunity_enriched": deals, "lead_enriched": store(c.lead_enriched, "leads"),
        "stage_order": seeds.stage_order(c.spark), "bookings_targets": seeds.bookings_targets(c.spark),
        "dim_account": c.dim_account, "dim_contact": c.dim_contact, "dim_lead": c.dim_lead, "dim_user": c.dim_user,
        "dim_campaign": c.dim_campaign,
        "fct_sales_pipeline": facts.fct_sales_pipeline(deals, AS_OF), "fct_bookings": facts.fct_bookings(deals, AS_OF),
        "fct_win_rate": facts.fct_win_rate(deals, AS_OF), "fct_campaign_performance": store(c.campaign_performance, "performance"),
        "fct_demand_generation": store(c.demand, "demand"),
    }


@query
def dq_run(c: Crm):
    """Every standing check over sources, staging, enriched frames, seeds, dimensions and facts."""
    with shuffles_released(c.spark), scratch(c.spark) as store:
        return quality.run_checks(_checked(c, store))


@query
def dq_failing_rows(c: Crm):
    """Deals and leads kept with the checks they fail, once the results were counted from the kept rows."""
    table = Table(c.spark, scratch_dir(c.spark, "failures"))
    quality.run_checks({"stg_opportunities": c.opportunities, "stg_leads": c.leads, "stg_users": c.users}, failures=table)
    row = lambda field: F.get_json_object("failing_row", f"$.{field}")
    return table.read().select(
        "table_name",
        F.array_join(F.array_sort("checks"), ",").alias("checks"),
        F.coalesce(row("opportunity_id"), row("lead_id"), row("user_id"), row("email")).alias("row_key"),
    )


@query
def campaign_reconcile(c: Crm):
    return quality.campaign_reconcile(c.campaign_performance)


@query
def files_per_pipe_day(c: Crm):
    return monitor.files_per_pipe_day(c.raw("LoadHistory"), LEDGER_AS_OF)


@query
def failed_files(c: Crm):
    return monitor.failed_files(c.raw("LoadHistory"), LEDGER_AS_OF)


@query
def pipe_cost(c: Crm):
    return monitor.pipe_cost(c.raw("UsageHistory"), LEDGER_AS_OF)


@query
def compute_cost_daily(c: Crm):
    return monitor.compute_cost_daily(c.raw("UsageHistory"), LEDGER_AS_OF)


@query
def query_stats(c: Crm):
    return monitor.query_stats(c.raw("QueryHistory"), LEDGER_AS_OF)


@query
def slowest_20(c: Crm):
    return monitor.slowest_queries(c.raw("QueryHistory"), LEDGER_AS_OF)


@query
def latency_percentiles(c: Crm):
    return monitor.latency_percentiles(c.raw("QueryHistory"), LEDGER_AS_OF)


@query
def freshness_report(c: Crm):
    return monitor.freshness_report(_staged(c), AS_OF, column="updated_at")


@query
def duplicate_report(c: Crm):
    tables = {"OPPORTUNITY_LINE_ITEM": c.raw("OpportunityLineItem"), "ACCOUNT": c.raw("Account"), "LEAD": c.raw("Lead")}
    return monitor.duplicate_report(tables)


@query
def dedup_run_history(c: Crm):
    return monitor.dedup_run_history(c.raw("TaskRun"), LEDGER_AS_OF)


@query
def stale_alert(c: Crm):
    """The newest of all loads, when it is three hours old or older at the end of the month."""
    return monitor.stale_alert(c.raw("LoadHistory"), LEDGER_AS_OF, column="last_load_time")


def _loads(c: Crm):
    """Load events: purchases fail in streaks, views stop on the 28th, clicks and sign-ups go on without errors."""
    failed = F.when((F.col("pipe_name") == "purchase") & (F.col("row_count") % 16 < 9), F.lit(2)).otherwise(F.col("error_count"))
    loads = c.raw("LoadHistory").withColumn("error_count", failed.cast("long"))
    return loads.filter("pipe_name <> 'view' or last_load_time < date '2024-01-28'")


@query
def pipe_runs(c: Crm):
    """Runs of failed and clean loads per pipe."""
    return monitor.outcome_runs(_loads(c)).select("pipe_name", "failed", "loads", "first_load", "last_load")


@query
def pipe_states(c: Crm):
    return monitor.pipe_states(_loads(c), LEDGER_AS_OF)


def _pipe_status(c: Crm):
    """Landed files against those loaded; sign-ups have not been loaded at all."""
    landed = c.raw("LoadHistory").select("pipe_name", "file_name")
    return monitor.pipe_status(landed, _loads(c).filter("pipe_name <> 'signup'"), LEDGER_AS_OF)


@query
def pipe_status(c: Crm):
    return _pipe_status(c)


@query
def ingest_health(c: Crm):
    return monitor.ingest_health(_pipe_status(c))
