"""Facts. The three sales facts are filters and projections of one enriched frame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstream.functions.scalars import (
    booking_category,
    days_between,
    deal_size_band,
    fiscal_label,
    null_of,
    percent,
    ratio,
    surrogate_key,
)
from revstream.operators.incremental import ntz
from revstream.plans.enrich import lookup, lookup_if_set, today

STALE_AFTER_DAYS = 30


def _sales_fact(df: DataFrame, key: str, renamed: dict[str, str], columns: str, as_of: datetime) -> DataFrame:
    """Shared shape: surrogate key, created date, fiscal label, then the listed columns."""
    df = df.withColumns(
        {
            key: surrogate_key("opportunity_id"),
            "created_date_id": F.col("created_at").cast("date"),
            "fiscal_quarter_label": fiscal_label(F.col("fiscal_year"), F.col("fiscal_quarter")),
            "built_at": ntz(as_of),
            **{new: F.col(old) for new, old in renamed.items()},
        }
    )
    return df.select(*columns.split(), "built_at")


def weighted_amount() -> Column:
    return (F.col("amount").cast("decimal(30,2)") * F.col("probability_pct") / 100).cast("decimal(38,2)")


def deal_measures(opportunities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys and amounts of the pipeline, bookings and win-rate facts, from staged deals alone.

    Reports by owner, account or quarter need nothing of the facts' context, so they join none of it and
    the scan reads the few columns used.
    """
    quarter = fiscal_label(F.col("fiscal_year"), F.col("fiscal_quarter")).alias("fiscal_quarter_label")
    by = ["opportunity_id", "account_id", "owner_id", quarter]
    pipeline = opportunities.filter(~F.col("is_closed")).select(*by, "amount", weighted_amount().alias("weighted_amount"))
    arr = null_of("decimal(38,2)").alias("arr_booked")  # no feed delivers it
    bookings = opportunities.filter(F.col("is_won")).select(*by, F.col("amount").alias("booking_amount"), arr)
    win_rate = opportunities.filter(F.col("is_closed")).select(*by, F.col("is_won").cast("int").alias("won_count"))
    return pipeline, bookings, win_rate


def fct_sales_pipeline(enriched: DataFrame, as_of: datetime) -> DataFrame:
    """Open deals. ``enriched`` comes from ``opportunity_enriched(..., keys=True)``."""
    now = today(as_of)
    df = enriched.filter(~F.col("is_closed")).withColumns(
        {
            "weighted_amount": weighted_amount(),
            "days_to_close": days_between(now, F.col("close_date")),
            "is_current_quarter_close": (F.col("fiscal_year") == F.year(now))
            & (F.col("fiscal_quarter") == F.quarter(now)),
            "is_stale": days_between(F.col("updated_at"), now) > STALE_AFTER_DAYS,
            "is_active": F.lit(True),
        }
    )
    return _sales_fact(
        df, "pipeline_id", {"close_date_id": "close_date"},
        """pipeline_id opportunity_id account_sk owner_sk campaign_sk close_date_id created_date_id account_id
        owner_id campaign_id opportunity_name opportunity_type stage_name forecast_category lead_source amount
        probability_pct weighted_amount expected_revenue arr mrr tcv account_name industry billing_country
        employee_segment revenue_segment owner_name owner_department campaign_name campaign_channel age_days
        days_to_close is_current_quarter_close is_stale fiscal_quarter fiscal_year fiscal_quarter_label
        line_item_count products_purchased created_at updated_at is_active""", as_of,
    )


def fct_bookings(enriched: DataFrame, as_of: datetime) -> DataFrame:
    """Won deals."""
    df = enriched.filter(F.col("is_won")).withColumns(
        {
            "days_to_close": days_between(F.col("created_at"), F.col("close_date")),
            "booking_category": booking_category(F.col("opportunity_type")),
        }
    )
    renamed = {
        "booking_date_id": "close_date",
        "booking_amount": "amount",
        "arr_booked": "arr",
        "mrr_booked": "mrr",
        "tcv_booked": "tcv",
    }
    return _sales_fact(
        df, "booking_id", renamed,
        """booking_id opportunity_id account_sk owner_sk campaign_sk booking_date_id created_date_id account_id
        owner_id campaign_id opportunity_name opportunity_type stage_name lead_source primary_competitor
        reason_won_lost booking_amount arr_booked mrr_booked tcv_booked total_quantity line_item_count
        arr_line_items services_line_items products_purchased contract_start_date contract_end_date
        contract_term_months account_name industry billing_country billing_state account_annual_revenue
        account_employees employee_segment revenue_segment owner_name owner_department campaign_name
        campaign_type campaign_channel days_to_close age_days fiscal_quarter fiscal_year fiscal_quarter_label
        booking_category close_date created_at updated_at""", as_of,
    )


def fct_win_rate(enriched: DataFrame, as_of: datetime) -> DataFrame:
    """Closed deals, won or lost."""
    df = enriched.filter(F.col("is_closed")).withColumns(
        {
            "won_count": F.col("is_won").cast("int"),
            "lost_count": F.col("is_lost").cast("int"),
            "deal_size_band": deal_size_band(F.col("amount")),
            "days_to_close": days_between(F.col("created_at"), F.col("close_date")),
        }
    )
    return _sales_fact(
        df, "win_rate_id", {"close_date_id": "close_date", "final_stage_name": "stage_name"},
        """win_rate_id opportunity_id account_sk owner_sk close_date_id created_date_id account_id owner_id
        campaign_id is_won is_lost won_count lost_count opportunity_name opportunity_type final_stage_name
        lead_source primary_competitor reason_won_lost amount arr deal_size_band account_name industry
        billing_country employee_segment revenue_segment owner_name owner_department days_to_close
        fiscal_quarter fiscal_year fiscal_quarter_label close_date created_at updated_at""", as_of,
    )


def member_totals(members: DataFrame) -> DataFrame:
    return members.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("total_members"),
        F.count_if(F.col("member_type") == "Lead").alias("lead_members"),
        F.count_if(F.col("member_type") == "Contact").alias("contact_members"),
        F.count_if(F.col("has_responded")).alias("responded_members"),
        F.min("created_at").alias("first_member_added_at"),
        F.max("created_at").alias("last_member_added_at"),
    )


def opportunity_totals(opportunities: DataFrame) -> DataFrame:
    is_open, amount = ~F.col("is_closed"), F.col("amount")
    zero = F.lit(0).cast("decimal(38,2)")
    total = lambda cond: F.sum(F.when(cond, amount).otherwise(zero)).cast("decimal(38,2)")
    won_on = F.when(F.col("is_won"), F.col("close_date"))
    return (
        opportunities.filter(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id")
        .agg(
            F.count(F.lit(1)).alias("total_opportunities"),
            F.count_if(is_open).alias("open_opportunities"),
            F.count_if("is_won").alias("won_opportunities"),
            F.count_if("is_lost").alias("lost_opportunities"),
            F.sum("amount").cast("decimal(38,2)").alias("total_pipeline_amount"),
            total(is_open).alias("open_pipeline_amount"),
            total(F.col("is_won")).alias("won_amount"),
            F.min(won_on).alias("first_won_date"),
            F.max(won_on).alias("last_won_date"),
        )
    )


# Reported names of the CRM's own roll-up fields.
_ROLLUPS = {
    "sf_number_of_leads": "number_of_leads",
    "sf_converted_leads": "number_of_converted_leads",
    "sf_number_of_contacts": "number_of_contacts",
    "sf_number_of_responses": "number_of_responses",
    "sf_opportunities": "number_of_opportunities",
    "sf_won_opportunities": "number_of_won_opportunities",
    "sf_pipeline_amount": "amount_all_opportunities",
    "sf_won_amount": "amount_won_opportunities",
}


def fct_campaign_performance(
    campaigns: DataFrame, members: DataFrame, opportunities: DataFrame, as_of: datetime
) -> DataFrame:
    """One row per campaign; members and deals are aggregated to campaign grain before joining."""
    m, o = member_totals(members), opportunity_totals(opportunities)
    df = lookup(campaigns, m, "campaign_id", "campaign_id", **{c: c for c in m.columns if c != "campaign_id"})
    df = lookup(df, o, "campaign_id", "campaign_id", **{c: c for c in o.columns if c != "campaign_id"})
    counts = [c for c in m.columns + o.columns if c.endswith(("_members", "_opportunities"))]
    amounts = ["total_pipeline_amount", "open_pipeline_amount", "won_amount"]
    cost = F.col("actual_cost")
    # Ratios read the joined values, before missing counts become zero.
    df = df.withColumns(
        {
            "response_rate_pct": percent(F.col("responded_members"), F.col("total_members")),
            "cost_per_lead": ratio(cost, F.col("lead_members")),
            "cost_per_opportunity": ratio(cost, F.col("total_opportunities")),
            "pipeline_roi": ratio(F.col("total_pipeline_amount"), cost),
            "revenue_roi": ratio(F.col("won_amount"), cost),
        }
    )
    df = df.withColumns(
        {
            "campaign_performance_id": surrogate_key("campaign_id"),
            "campaign_duration_days": days_between(F.col("start_date"), F.col("end_date")),
            **{c: null_of("string") for c in ("channel", "utm_source", "utm_medium")},
            **{c: F.coalesce(c, F.lit(0)) for c in counts},
            **{c: F.coalesce(F.col(c), F.lit(0).cast("decimal(38,2)")) for c in amounts},
            "won_arr": F.lit(0).cast("decimal(38,2)"),
            **{new: F.col(old) for new, old in _ROLLUPS.items()},
            "built_at": ntz(as_of),
        }
    )
    columns = """campaign_performance_id campaign_id campaign_name campaign_type campaign_status channel
        utm_source utm_medium start_date end_date campaign_duration_days budgeted_cost actual_cost number_sent
        total_members lead_members contact_members responded_members response_rate_pct sf_number_of_leads
        sf_converted_leads sf_number_of_contacts sf_number_of_responses sf_opportunities sf_won_opportunities
        sf_pipeline_amount sf_won_amount total_opportunities open_opportunities won_opportunities
        lost_opportunities total_pipeline_amount open_pipeline_amount won_amount won_arr first_won_date
        last_won_date cost_per_lead cost_per_opportunity pipeline_roi revenue_roi created_at updated_at
        first_member_added_at last_member_added_at built_at"""
    return df.select(*columns.split())


def fct_demand_generation(
    members: DataFrame,
    leads: DataFrame,
    contacts: DataFrame,
    campaigns: DataFrame,
    opportunities: DataFrame,
    as_of: datetime,
) -> DataFrame:
    """One row per campaign member with the person, campaign and converted deal behind it."""
    campaign = campaigns.select(
        "campaign_id",
        "campaign_name",
        "campaign_type",
        F.col("start_date").alias("campaign_start_date"),
        F.col("end_date").alias("campaign_end_date"),
        F.col("budgeted_cost").alias("campaign_budgeted_cost"),
        F.col("actual_cost").alias("campaign_actual_cost"),
    )
    # The inner join comes first: it is the one that can drop members.
    df = members.withColumnRenamed("created_at", "member_created_at").join(campaign, "campaign_id")
    df = lookup_if_set(
        df, leads, "lead_id", "lead_id",
        lead_email="email", lead_name="full_name", company="company", lead_title="title", industry="industry",
        annual_revenue="annual_revenue", number_of_employees="number_of_employees", person_source="lead_source",
        lead_status="status", lead_rating="rating", country="country", state="state", lead_owner_id="owner_id",
        lead_is_converted="is_converted", converted_date="converted_date",
        converted_account_id="converted_account_id", converted_opportunity_id="converted_opportunity_id",
    )
    df = lookup_if_set(
        df, contacts, "contact_id", "contact_id",
        contact_name="full_name", contact_email="email", contact_title="title",
        contact_source="lead_source", contact_owner_id="owner_id",
    )
    df = lookup_if_set(
        df, opportunities, "converted_opportunity_id", "opportunity_id",
        converted_opportunity_id_attr="opportunity_id", converted_opp_amount="amount",
        converted_opp_is_won="is_won", converted_opp_close_date="close_date",
        converted_opp_stage="stage_name", converted_opp_created_at="created_at",
    )
    joined = F.col("member_created_at")
    df = df.withColumns(
        {
            "demand_gen_id": surrogate_key("campaign_member_id"),
            "email": F.coalesce("lead_email", "contact_email"),
            "full_name": F.coalesce("lead_name", "contact_name"),
            "title": F.coalesce("lead_title", "contact_title"),
            "lead_source": F.coalesce("person_source", "contact_source"),
            "owner_id": F.coalesce("lead_owner_id", "contact_owner_id"),
            "lead_score": null_of("int"),
            **{c: null_of("string") for c in ("channel", "utm_source", "utm_medium")},
            "is_mql": F.col("has_responded"),
            "is_sql": F.col("converted_opportunity_id_attr").isNotNull(),
            "is_customer": F.coalesce(F.col("converted_opp_is_won"), F.lit(False)),
            "converted_opp_arr": null_of("decimal(38,2)"),
            "days_to_respond": days_between(joined, F.col("first_responded_date")),
            "days_member_to_opportunity": days_between(joined, F.col("converted_opp_created_at")),
            "days_member_to_close": days_between(joined, F.col("converted_opp_close_date")),
            "built_at": ntz(as_of),
        }
    )
    columns = """demand_gen_id campaign_member_id campaign_id lead_id contact_id person_id member_type
        member_status has_responded first_responded_date member_created_at email full_name company title
        industry annual_revenue number_of_employees lead_source country state owner_id lead_status lead_rating
        lead_score campaign_name campaign_type channel utm_source utm_medium campaign_start_date
        campaign_end_date campaign_budgeted_cost campaign_actual_cost is_mql is_sql is_customer
        lead_is_converted converted_date converted_account_id converted_opportunity_id_attr
        converted_opp_amount converted_opp_arr converted_opp_is_won converted_opp_close_date
        converted_opp_stage days_to_respond days_member_to_opportunity days_member_to_close built_at"""
    return df.select(*columns.split())
