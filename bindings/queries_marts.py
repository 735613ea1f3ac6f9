"""Registered queries: staging, enrichment, dimensions, facts and reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from bindings.crm import Crm, show
from bindings.crm_views import AS_OF
from revstream.functions.scalars import fiscal_label
from revstream.plans import analytics, dims, enrich
from revstream.sources import seeds

QUERIES = {}


def query(fn):
    """Register ``fn(crm) -> DataFrame`` under its name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: show(fn(Crm(spark, sf_dir)))
    return fn


def _attr(name: str, attribute: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: show(getattr(Crm(spark, sf_dir), attribute))


for _name, _attribute in {
    "stg_accounts": "accounts",
    "stg_contacts": "contacts",
    "stg_leads": "leads",
    "stg_opportunities": "opportunities",
    "stg_line_items": "line_items",
    "stg_campaigns": "campaigns",
    "stg_campaign_members": "members",
    "stg_tasks": "tasks",
    "stg_events": "events",
    "stg_users": "users",
    "lead_enriched": "lead_enriched",
    "dim_account": "dim_account",
    "dim_contact": "dim_contact",
    "dim_lead": "dim_lead",
    "dim_user": "dim_user",
    "dim_campaign": "dim_campaign",
    "fct_sales_pipeline": "pipeline",
    "fct_bookings": "bookings",
    "fct_win_rate": "win_rate",
    "fct_campaign_performance": "campaign_performance",
    "fct_demand_generation": "demand",
}.items():
    _attr(_name, _attribute)


@query
def line_item_rollup(c: Crm):
    return enrich.line_item_rollup(c.line_items)


@query
def opportunity_enriched(c: Crm):
    return c.enriched(keys=False)


@query
def latest_campaign_touch(c: Crm):
    return enrich.latest_campaign_touch(c.members)


@query
def dim_date(c: Crm):
    """The calendar over the fixed range, with the deals created and due on each day."""
    calendar = dims.dim_date(c.spark, AS_OF)
    created = c.opportunities.groupBy(F.col("created_at").cast("date").alias("date_id")).agg(
        F.count(F.lit(1)).alias("deals_created")
    )
    due = c.opportunities.groupBy(F.col("close_date").alias("date_id")).agg(F.count(F.lit(1)).alias("deals_due"))
    df = calendar.join(created, "date_id", "left").join(due, "date_id", "left")
    return df.fillna(0, ["deals_created", "deals_due"])


@query
def pipeline_coverage(c: Crm):
    pipeline, bookings, _ = c.measures
    return analytics.pipeline_coverage(pipeline, bookings)


@query
def win_rate_by(c: Crm):
    return analytics.win_rate_by(c.win_rate, "owner_name", "deal_size_band")


@query
def win_rate_by_segment(c: Crm):
    return analytics.win_rate_by(c.win_rate, "industry", "employee_segment", "fiscal_quarter_label")


@query
def stage_progression(c: Crm):
    return analytics.stage_progression(c.pipeline, seeds.stage_order(c.spark))


@query
def bookings_attainment(c: Crm):
    return analytics.bookings_attainment(c.bookings, seeds.bookings_targets(c.spark))


@query
def seed_stage_order(c: Crm):
    """The stage seed with the number of staged deals in each stage."""
    deals = c.opportunities.groupBy("stage_name").agg(F.count(F.lit(1)).alias("deals"))
    return seeds.stage_order(c.spark).join(deals, "stage_name", "left").fillna(0, ["deals"])


@query
def seed_bookings_targets(c: Crm):
    """The target seed with the number of deals won in each quarter."""
    label = fiscal_label(F.col("fiscal_year"), F.col("fiscal_quarter")).alias("fiscal_quarter_label")
    won = c.opportunities.filter("is_won").groupBy(label).agg(F.count(F.lit(1)).alias("won_deals"))
    return seeds.bookings_targets(c.spark).join(won, "fiscal_quarter_label", "left").fillna(0, ["won_deals"])


@query
def attribution_first(c: Crm):
    return analytics.attribution(c.demand, c.bookings, "first")


@query
def attribution_last(c: Crm):
    return analytics.attribution(c.demand, c.bookings, "last")


@query
def attribution_linear(c: Crm):
    return analytics.attribution(c.demand, c.bookings, "linear")


@query
def funnel_conversion(c: Crm):
    return analytics.funnel_conversion(c.demand, "campaign_type", "lead_source", "owner_id")


@query
def rep_scorecard(c: Crm):
    return analytics.rep_scorecard(c.dim_user, *c.measures, c.tasks, c.events, quota=5_000_000)


@query
def account_health(c: Crm):
    pipeline, bookings, _ = c.measures
    return analytics.account_health(
        c.dim_account, pipeline, bookings, c.contacts, c.tasks, c.events, AS_OF, recent_days=200
    )


@query
def crm_data_quality(c: Crm):
    return analytics.crm_data_quality(c.opportunities, c.contacts, c.leads, c.accounts)


@query
def pipeline_waterfall(c: Crm):
    return analytics.pipeline_waterfall(c.opportunity_history, date(2024, 3, 31))


@query
def stage_velocity(c: Crm):
    return analytics.stage_velocity(c.opportunity_history, datetime(2026, 12, 31))


@query
def stage_regression(c: Crm):
    return analytics.stage_regression(c.opportunity_history, seeds.stage_order(c.spark), "opportunity_id", counted=c.deal_versions)


@query
def forecast_accuracy(c: Crm):
    return analytics.forecast_accuracy(c.opportunity_history)
