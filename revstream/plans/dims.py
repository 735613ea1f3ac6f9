"""Dimensions: current-state tables rebuilt in full from staging, plus the calendar."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revstream.functions.scalars import (
    days_between,
    employee_segment,
    fiscal_label,
    months_between_boundaries,
    null_of,
    quarter_end,
    revenue_segment,
    surrogate_key,
    weeks_between,
    year_end,
    years_between,
)
from revstream.operators.incremental import ntz
from revstream.plans.enrich import lookup, today

# Calendar range.
SPINE_START, SPINE_END = date(2020, 1, 1), date(2030, 12, 31)


def _columns(text: str) -> list[str]:
    return text.split()


def _finish(df: DataFrame, sk: str, key: str, columns: str, as_of: datetime) -> DataFrame:
    return df.select(surrogate_key(key).alias(sk), *_columns(columns), ntz(as_of).alias("built_at"))


def dim_account(accounts: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    df = lookup(
        accounts, users, "owner_id", "user_id",
        owner_name="full_name", owner_department="department", owner_is_active="is_active",
    )
    df = lookup(df, accounts, "parent_id", "account_id", parent_account_name="account_name")
    df = df.withColumns(
        {
            "parent_account_id": F.col("parent_id"),
            "sub_industry": null_of("string"),
            "employee_segment": employee_segment(F.col("number_of_employees")),
            "revenue_segment": revenue_segment(F.col("annual_revenue")),
        }
    )
    return _finish(
        df, "account_sk", "account_id",
        """account_id parent_account_id parent_account_name account_name account_type industry sub_industry
        rating account_source website phone annual_revenue number_of_employees employee_segment
        revenue_segment billing_street billing_city billing_state billing_postal_code billing_country
        billing_latitude billing_longitude owner_id owner_name owner_department owner_is_active created_at
        last_modified_at updated_at""", as_of,
    )


def dim_contact(contacts: DataFrame, accounts: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    df = lookup(
        contacts, accounts, "account_id", "account_id",
        account_name="account_name", industry="industry", billing_country="billing_country",
    )
    df = lookup(df, users, "owner_id", "user_id", owner_name="full_name", owner_department="department")
    df = df.withColumns(
        {
            "linkedin_url": null_of("string"),
            "has_opted_out_of_email": null_of("boolean"),
            "do_not_call": null_of("boolean"),
            "birth_date": null_of("date"),
        }
    )
    return _finish(
        df, "contact_sk", "contact_id",
        """contact_id account_id account_name industry billing_country first_name last_name full_name
        salutation title department email phone mobile_phone linkedin_url lead_source mailing_city
        mailing_state mailing_country has_opted_out_of_email do_not_call owner_id owner_name
        owner_department created_at last_modified_at updated_at last_activity_date birth_date""", as_of,
    )


def dim_lead(enriched_leads: DataFrame, as_of: datetime) -> DataFrame:
    df = enriched_leads.withColumn("employee_segment", employee_segment(F.col("number_of_employees")))
    return _finish(
        df, "lead_sk", "lead_id",
        """lead_id full_name first_name last_name email phone title company industry annual_revenue
        number_of_employees lead_source status rating lead_score lead_grade city state country
        employee_segment is_converted converted_date converted_account_id converted_contact_id
        converted_opportunity_id days_to_convert owner_id owner_name owner_department original_campaign_id
        original_campaign_name original_campaign_type original_campaign_channel last_campaign_id
        last_campaign_name last_campaign_status responded_to_last_campaign created_at updated_at
        last_activity_date""", as_of,
    )


def dim_user(users: DataFrame, as_of: datetime) -> DataFrame:
    df = lookup(users, users, "manager_id", "user_id", manager_name="full_name")
    return _finish(
        df, "user_sk", "user_id",
        """user_id first_name last_name full_name email username alias title department division phone
        mobile_phone manager_id manager_name user_role_id profile_id timezone locale is_active created_at
        last_login_at updated_at""", as_of,
    )


def dim_campaign(campaigns: DataFrame, users: DataFrame, as_of: datetime) -> DataFrame:
    df = lookup(campaigns, users, "owner_id", "user_id", owner_name="full_name")
    df = lookup(
        df, campaigns, "parent_campaign_id", "campaign_id",
        parent_campaign_name="campaign_name", parent_campaign_type="campaign_type",
    )
    df = df.withColumns(
        {
            "campaign_duration_days": days_between(F.col("start_date"), F.col("end_date")),
            "budget_variance": (F.col("budgeted_cost") - F.col("actual_cost")).cast("decimal(38,2)"),
            **{c: null_of("string") for c in ("utm_source", "utm_medium", "utm_content", "channel")},
        }
    )
    return _finish(
        df, "campaign_sk", "campaign_id",
        """campaign_id campaign_name campaign_type campaign_status parent_campaign_id parent_campaign_name
        parent_campaign_type owner_id owner_name start_date end_date campaign_duration_days budgeted_cost
        actual_cost budget_variance expected_revenue expected_response_pct number_sent utm_source
        utm_medium utm_content channel is_active created_at updated_at""", as_of,
    )


def date_spine(spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def calendar(spine: DataFrame, as_of: datetime) -> DataFrame:
    """Calendar attributes of every ``date_day`` in ``spine``."""
    d, now = F.col("date_day"), today(as_of)
    weekday = F.weekday(d) + 1
    monday = F.date_trunc("week", d).cast("date")
    quarter_start = F.trunc(d, "quarter")
    attributes: dict[str, Column] = {
        "date_id": d,
        "date_day": d,
        "prior_date": F.date_sub(d, 1),
        "next_date": F.date_add(d, 1),
        "day_of_week": weekday,
        "day_of_week_name": F.date_format(d, "EEEE"),
        "day_of_week_name_short": F.date_format(d, "EEE"),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "week_start_date": monday,
        "week_end_date": F.date_add(monday, 6),
        "month_of_year": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": F.last_day(d),
        "quarter_of_year": F.quarter(d),
        "quarter_start_date": quarter_start,
        "quarter_end_date": quarter_end(d),
        "year_number": F.year(d),
        # The fiscal year is the calendar year.
        "fiscal_month": F.month(d),
        "fiscal_quarter": F.quarter(d),
        "fiscal_year": F.year(d),
        "fiscal_quarter_label": fiscal_label(F.year(d), F.quarter(d)),
        "is_weekend": weekday >= 6,
        "is_month_start": F.dayofmonth(d) == 1,
        "is_month_end": d == F.last_day(d),
        "is_quarter_start": d == quarter_start,
        "is_quarter_end": d == quarter_end(d),
        "is_year_start": F.dayofyear(d) == 1,
        "is_year_end": d == year_end(d),
        "days_ago": days_between(d, now),
        "weeks_ago": weeks_between(d, now),
        "months_ago": months_between_boundaries(d, now),
        "years_ago": years_between(d, now),
        "is_past_or_today": d <= now,
        "is_today": d == now,
        "is_future": d > now,
    }
    return spine.select(*[c.alias(n) for n, c in attributes.items()])


def dim_date(spark: SparkSession, as_of: datetime, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    return calendar(date_spine(spark, start, end), as_of)
