"""Enrichment of opportunities and leads with account, owner, campaign and line-item context.

Lookups are plain left joins. None carries a broadcast hint: Spark broadcasts a side only when its
estimated or measured size is under its threshold, and otherwise splits hot keys of a shuffled join.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.functions.scalars import (
    days_between,
    employee_segment,
    key_if,
    null_of,
    revenue_segment,
)
from revstream.operators.dedup import dedup_latest, newest_first
from revstream.session import Scratch


def today(as_of: datetime) -> Column:
    return F.lit(as_of.date())


def lookup(df: DataFrame, side: DataFrame, on: str, key: str, **columns: str) -> DataFrame:
    """Left join ``side`` by ``df.on = side.key`` and add only ``columns`` (new=old) of it."""
    right = side.selectExpr(f"{key} as {on}", *[f"{old} as {new}" for new, old in columns.items()])
    return df.join(right, on, "left")


def lookup_if_set(df: DataFrame, side: DataFrame, on: str, key: str, **columns: str) -> DataFrame:
    """:func:`lookup` by a column that is often NULL.

    Such rows match nothing, but a shuffled join deals them all to one task. Here they are dealt by a digest of the
    row, whose counterpart of ``side`` is always 0 (and not a constant, which would leave the join's keys).
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    right = side.selectExpr(f"{key} as {on}", *[f"{old} as {new}" for new, old in columns.items()])
    right = right.withColumn("_place", F.pmod(F.xxhash64(on), F.lit(1)))
    left = df.withColumn("_place", F.when(F.col(on).isNull(), F.xxhash64(*plain)).otherwise(F.lit(0)))
    return left.join(right, [on, "_place"], "left").drop("_place")


def line_item_rollup(items: DataFrame) -> DataFrame:
    """Count, total and distinct product names per opportunity.

    Grouped by (opportunity, product) first: an opportunity with very many line items shrinks to its
    distinct products, spread over many tasks, before anything is gathered per opportunity.
    """
    per_product = items.groupBy("opportunity_id", "product_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_price").alias("total")
    )
    return per_product.groupBy("opportunity_id").agg(
        F.sum("n").alias("line_item_count"),
        F.sum("total").cast("decimal(38,2)").alias("line_items_total"),
        null_of("decimal(38,2)").alias("arr_line_items"),
        null_of("decimal(38,2)").alias("services_line_items"),
        F.expr("listagg(product_name, ', ') within group (order by product_name)").alias("products_purchased"),
    )


# Output column order of the enriched opportunity.
_OPPORTUNITY_COLUMNS = """
    opportunity_id opportunity_name opportunity_type stage_name forecast_category amount expected_revenue
    probability_pct total_quantity arr mrr tcv lead_source primary_competitor reason_won_lost is_closed is_won
    is_lost has_line_items close_date fiscal_quarter fiscal_year created_at updated_at contract_start_date
    contract_end_date contract_term_months age_days account_id account_name industry account_type
    billing_country billing_state account_annual_revenue account_employees owner_id owner_name
    owner_department owner_manager_id campaign_id campaign_name campaign_type campaign_channel
    line_item_count line_items_total arr_line_items services_line_items products_purchased
""".split()


def opportunity_enriched(
    opportunities: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    campaigns: DataFrame,
    line_items: DataFrame,
    as_of: datetime,
    keys: bool = False,
    store: Scratch | None = None,
) -> DataFrame:
    """Opportunities with their context.

    ``keys=True`` also carries the dimension keys and account segments the facts need. They are
    functions of rows joined here anyway, so no fact joins the dimension tables a second time.

    Every lookup deals all rows anew. With ``store`` rows are written between lookups, so that the shuffle files of one
    can go before the next.
    """
    kept = store or (lambda frame, purpose, *done: frame)
    df = lookup(
        opportunities, accounts, "account_id", "account_id",
        _account="account_id", account_name="account_name", industry="industry",
        account_type="account_type", billing_country="billing_country", billing_state="billing_state",
        account_annual_revenue="annual_revenue", account_employees="number_of_employees",
    )
    df = lookup(
        df, users, "owner_id", "user_id",
        _owner="user_id", owner_name="full_name", owner_department="department", owner_manager_id="manager_id",
    )
    owned = kept(df, "with-owners")
    df = lookup_if_set(
        owned, campaigns, "campaign_id", "campaign_id",
        _campaign="campaign_id", campaign_name="campaign_name", campaign_type="campaign_type",
    )
    df = kept(df, "with-campaigns", owned)
    rollup = kept(line_item_rollup(line_items), "rollup")
    df = lookup(
        df, rollup, "opportunity_id", "opportunity_id",
        **{c: c for c in rollup.columns if c != "opportunity_id"},
    )
    closed_on = F.when(F.col("is_closed"), F.col("close_date"))
    df = df.withColumns(
        {
            "age_days": days_between(F.col("created_at"), F.coalesce(closed_on, today(as_of))),
            "line_item_count": F.coalesce("line_item_count", F.lit(0)),
            # No feed delivers these; they stay typed NULLs.
            **{c: null_of("decimal(38,2)") for c in ("arr", "mrr", "tcv")},
            **{c: null_of("string") for c in ("primary_competitor", "reason_won_lost", "campaign_channel")},
            **{c: null_of("date") for c in ("contract_start_date", "contract_end_date")},
            "contract_term_months": null_of("int"),
        }
    )
    extra = []
    if keys:
        known = F.col("_account").isNotNull()
        extra = [
            key_if(F.col("_account"), "account_id").alias("account_sk"),
            key_if(F.col("_owner"), "owner_id").alias("owner_sk"),
            key_if(F.col("_campaign"), "campaign_id").alias("campaign_sk"),
            F.when(known, employee_segment(F.col("account_employees"))).alias("employee_segment"),
            F.when(known, revenue_segment(F.col("account_annual_revenue"))).alias("revenue_segment"),
        ]
    return df.select(*_OPPORTUNITY_COLUMNS, *extra)


def latest_campaign_touch(members: DataFrame) -> DataFrame:
    """The last campaign membership of every lead; equal times are settled by the member id."""
    touches = members.filter(F.col("lead_id").isNotNull()).select(
        "lead_id",
        F.col("campaign_id").alias("last_campaign_id"),
        F.col("member_status").alias("last_campaign_status"),
        F.col("has_responded").alias("responded_to_last_campaign"),
        F.col("created_at").alias("campaign_member_created_at"),
        "campaign_member_id",
    )
    order = newest_first("campaign_member_created_at", "campaign_member_id")
    return dedup_latest(touches, "lead_id", order).drop("campaign_member_id")


# Output column order of the enriched lead.
_LEAD_COLUMNS = """
    lead_id full_name first_name last_name email phone title company industry annual_revenue
    number_of_employees lead_source status rating lead_score lead_grade city state country is_converted
    converted_date converted_account_id converted_contact_id converted_opportunity_id created_at updated_at
    last_activity_date days_to_convert owner_id owner_name owner_department original_campaign_id
    original_campaign_name original_campaign_type original_campaign_channel last_campaign_id
    last_campaign_name last_campaign_status responded_to_last_campaign
""".split()


def lead_enriched(leads: DataFrame, users: DataFrame, members: DataFrame, campaigns: DataFrame) -> DataFrame:
    df = lookup(leads, users, "owner_id", "user_id", owner_name="full_name", owner_department="department")
    df = lookup(
        df, latest_campaign_touch(members), "lead_id", "lead_id",
        last_campaign_id="last_campaign_id", last_campaign_status="last_campaign_status",
        responded_to_last_campaign="responded_to_last_campaign",
    )
    df = lookup_if_set(df, campaigns, "last_campaign_id", "campaign_id", last_campaign_name="campaign_name")
    unfilled = [c for c in _LEAD_COLUMNS if c.startswith("original_campaign_")] + ["lead_grade"]
    df = df.withColumns(
        {
            "days_to_convert": days_between(F.col("created_at"), F.col("converted_date")),
            "lead_score": null_of("int"),
            **{c: null_of("string") for c in unfilled},
        }
    )
    return df.select(*_LEAD_COLUMNS)
