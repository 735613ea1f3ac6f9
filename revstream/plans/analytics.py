"""Reports on the facts, dimensions and history tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstream.functions.scalars import coverage_health, days_between, fiscal_label, percent, ratio
from revstream.operators.ordered import HOT_ROWS, with_neighbours
from revstream.operators.scd import as_of
from revstream.plans.enrich import lookup, today

MONEY = "decimal(38,2)"


def _money(col: Column) -> Column:
    return F.coalesce(col, F.lit(0)).cast(MONEY)


def _count(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def pipeline_coverage(pipeline: DataFrame, bookings: DataFrame) -> DataFrame:
    """Open pipeline against bookings per fiscal quarter, with a health band."""
    quarter = "fiscal_quarter_label"
    open_deals = pipeline.groupBy(quarter).agg(
        F.sum("amount").alias("open_amount"),
        F.sum("weighted_amount").alias("weighted_pipeline"),
        F.count(F.lit(1)).alias("open_deals"),
    )
    won = bookings.groupBy(quarter).agg(
        F.sum("booking_amount").alias("bookings"),
        F.count(F.lit(1)).alias("won_deals"),
        F.sum("arr_booked").alias("arr_booked"),
    )
    joined = open_deals.join(won, quarter, "full_outer")
    coverage = ratio(F.col("open_amount"), F.col("bookings"))
    return joined.select(
        quarter,
        _money(F.col("open_amount")).alias("open_pipeline"),
        _money(F.col("weighted_pipeline")).alias("weighted_pipeline"),
        _count(F.col("open_deals")).alias("open_deals"),
        _money(F.col("bookings")).alias("bookings"),
        _count(F.col("won_deals")).alias("won_deals"),
        _money(F.col("arr_booked")).alias("arr_booked"),
        coverage.alias("coverage_ratio"),
        coverage_health(coverage).alias("coverage_health"),
    ).orderBy(quarter)


def win_rate_by(win_rate: DataFrame, *dimensions: str) -> DataFrame:
    return win_rate.groupBy(*dimensions).agg(
        F.sum("won_count").alias("won"),
        F.count(F.lit(1)).alias("closed"),
        percent(F.sum("won_count"), F.count(F.lit(1))).alias("win_rate_pct"),
    )


def stage_progression(pipeline: DataFrame, stages: DataFrame) -> DataFrame:
    """Open deals per stage in stage order."""
    per_stage = pipeline.groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("deals"),
        F.sum("amount").cast(MONEY).alias("amount"),
        F.sum("weighted_amount").cast(MONEY).alias("weighted_amount"),
        F.sum("age_days").alias("total_age_days"),
    )
    joined = per_stage.join(stages, "stage_name", "left")
    columns = "stage_name stage_order stage_category is_open deals amount weighted_amount total_age_days"
    return joined.select(*columns.split()).orderBy("stage_order", "stage_name")


def bookings_attainment(bookings: DataFrame, targets: DataFrame) -> DataFrame:
    """Booked amounts against the quarterly targets. ``targets`` is the seed, one row per quarter."""
    part = lambda *c: F.sum(F.when(F.col("booking_category").isin(*c), F.col("booking_amount")).otherwise(F.lit(0)))
    booked = bookings.groupBy("fiscal_quarter_label").agg(
        F.sum("booking_amount").alias("booked"), part("New Logo").alias("new_logo"), part("Expansion").alias("expansion")
    )
    df = targets.join(booked, "fiscal_quarter_label", "left")
    return df.select(
        "fiscal_quarter_label",
        "bookings_target",
        _money(F.col("booked")).alias("booked"),
        percent_of(F.col("booked"), F.col("bookings_target")).alias("attainment_pct"),
        percent_of(F.col("new_logo"), F.col("new_logo_target")).alias("new_logo_attainment_pct"),
        percent_of(F.col("expansion"), F.col("expansion_target")).alias("expansion_attainment_pct"),
    )


def percent_of(amount: Column, target: Column) -> Column:
    return ratio(_money(amount) * 100, target)


# -- marketing -----------------------------------------------------------------------------------------


def attribution(demand: DataFrame, bookings: DataFrame, model: str) -> DataFrame:
    """Booked amount credited to campaigns by the ``first``, ``last`` or ``linear`` touch of each deal.

    Touches are reduced before they meet the bookings: to one row per deal by min/max aggregates, or to
    counts per (deal, campaign). A deal with very many touches never reaches a task whole.
    """
    if model not in ("first", "last", "linear"):
        raise ValueError(f"unknown attribution model: {model}")
    touches = demand.select(
        F.col("converted_opportunity_id_attr").alias("opportunity_id"),
        "campaign_id",
        F.struct("member_created_at", "campaign_member_id").alias("position"),
    ).filter(F.col("opportunity_id").isNotNull())
    booked = bookings.select("opportunity_id", F.col("booking_amount").cast("decimal(24,2)").alias("amount"))

    if model == "linear":
        counts = touches.groupBy("opportunity_id", "campaign_id").agg(F.count(F.lit(1)).alias("n"))
        totals = counts.groupBy("opportunity_id").agg(F.sum("n").alias("total"))
        whole = lambda c: F.col(c).cast("decimal(12,0)")
        share = (F.col("amount") * whole("n")).cast("decimal(28,2)") / whole("total")
        joined = counts.join(totals.join(booked, "opportunity_id"), "opportunity_id")
        credited = joined.select("campaign_id", "n", F.round(share, 6).alias("credit"))
    else:
        pick = F.min_by if model == "first" else F.max_by
        chosen = touches.groupBy("opportunity_id").agg(pick("campaign_id", "position").alias("campaign_id"))
        credited = chosen.join(booked, "opportunity_id").select("campaign_id", F.lit(1).alias("n"), F.col("amount").alias("credit"))
    return credited.groupBy("campaign_id").agg(
        F.sum("n").alias("touches"),
        F.count(F.lit(1)).alias("deals"),
        F.sum("credit").cast("decimal(38,6)").alias("attributed_amount"),
    )


def funnel_conversion(demand: DataFrame, *dimensions: str) -> DataFrame:
    """Responded, qualified and customer counts, step rates and mean days per step."""
    mql, sql, won = F.count_if("is_mql"), F.count_if("is_sql"), F.count_if("is_customer")
    mean = lambda c: F.round(F.sum(c).cast("decimal(18,0)") / F.count(c).cast("decimal(18,0)"), 2)
    return demand.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("members"),
        mql.alias("mql"),
        sql.alias("sql"),
        won.alias("customers"),
        percent(mql, F.count(F.lit(1))).alias("mql_rate_pct"),
        percent(sql, mql).alias("sql_per_mql_pct"),
        percent(won, sql).alias("customer_per_sql_pct"),
        F.when(F.count("days_to_respond") > 0, mean("days_to_respond")).alias("avg_days_to_respond"),
        F.when(F.count("days_member_to_opportunity") > 0, mean("days_member_to_opportunity")).alias("avg_days_to_opportunity"),
        F.when(F.count("days_member_to_close") > 0, mean("days_member_to_close")).alias("avg_days_to_close"),
    )


# -- people and accounts ---------------------------------------------------------------------------------


def rep_scorecard(
    users: DataFrame, pipeline: DataFrame, bookings: DataFrame, win_rate: DataFrame, tasks: DataFrame, events: DataFrame,
    quota: float | None = None,
) -> DataFrame:
    """Pipeline, bookings, win rate, deal size, activity and attainment of ``quota`` per user."""
    open_by = pipeline.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("open_deals"), F.sum("amount").cast(MONEY).alias("open_amount")
    )
    won_by = bookings.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("won_deals"),
        F.sum("booking_amount").cast(MONEY).alias("booked"),
        ratio(F.sum("booking_amount"), F.count(F.lit(1))).alias("avg_deal"),
    )
    closed_by = win_rate.groupBy("owner_id").agg(percent(F.sum("won_count"), F.count(F.lit(1))).alias("win_rate_pct"))
    tasks_by = tasks.groupBy("owner_id").agg(F.count(F.lit(1)).alias("tasks"))
    events_by = events.groupBy("owner_id").agg(F.count(F.lit(1)).alias("events"))
    df = users.select("user_id", "full_name", "manager_name", "department")
    for side in (open_by, won_by, closed_by, tasks_by, events_by):
        df = lookup(df, side, "user_id", "owner_id", **{c: c for c in side.columns if c != "owner_id"})
    out = df.withColumns(
        {
            "coverage_ratio": ratio(F.col("open_amount"), F.col("booked")),
            **{c: _count(F.col(c)) for c in ("open_deals", "won_deals", "tasks", "events")},
            **{c: _money(F.col(c)) for c in ("open_amount", "booked")},
        }
    )
    if quota is not None:
        out = out.withColumn("attainment_pct", percent_of(F.col("booked"), F.lit(quota).cast(MONEY)))
    return out


def account_health(
    accounts: DataFrame, pipeline: DataFrame, bookings: DataFrame, contacts: DataFrame, tasks: DataFrame, events: DataFrame,
    now: datetime, recent_days: int = 90,
) -> DataFrame:
    """Open deals, bookings, contacts and recent activity per account of the account dimension."""
    recent = lambda d: F.count_if((days_between(F.col(d), today(now)) <= recent_days) & (F.col(d).cast("date") <= today(now)))
    sides = [
        pipeline.groupBy("account_id").agg(
            F.count(F.lit(1)).alias("open_deals"), F.sum("amount").cast(MONEY).alias("open_amount")
        ),
        bookings.groupBy("account_id").agg(
            F.count(F.lit(1)).alias("won_deals"), F.sum("booking_amount").cast(MONEY).alias("booked")
        ),
        contacts.groupBy("account_id").agg(F.count(F.lit(1)).alias("contacts")),
        tasks.groupBy(F.col("what_id").alias("account_id")).agg(recent("activity_date").alias("recent_tasks")),
        events.groupBy(F.col("what_id").alias("account_id")).agg(recent("start_datetime").alias("recent_events")),
    ]
    df = accounts.select("account_id", "account_name", "industry", "employee_segment", "revenue_segment", "owner_name")
    for side in sides:
        df = lookup(df, side, "account_id", "account_id", **{c: c for c in side.columns if c != "account_id"})
    counts = ("open_deals", "won_deals", "contacts", "recent_tasks", "recent_events")
    return df.withColumns(
        {**{c: _count(F.col(c)) for c in counts}, **{c: _money(F.col(c)) for c in ("open_amount", "booked")}}
    )


def crm_data_quality(opportunities: DataFrame, contacts: DataFrame, leads: DataFrame, accounts: DataFrame) -> DataFrame:
    """Counts of incomplete records, one pass per object."""

    def gaps(df: DataFrame, object_name: str, issues: dict[str, Column]) -> DataFrame:
        counted = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(n) for n, c in issues.items()])
        rows = F.array(*[F.struct(F.lit(n).alias("issue"), F.col(n).alias("records")) for n in issues])
        return counted.select(F.lit(object_name).alias("object_name"), "total", F.explode(rows).alias("r")).select(
            "object_name", "r.issue", "r.records", "total"
        )

    missing = lambda c: F.col(c).isNull()
    parts = [
        gaps(opportunities, "opportunity", {
            "no_close_date": missing("close_date"),
            "no_lead_source": missing("lead_source"),
            "no_closed_flag": missing("is_closed") | missing("is_won"),
            "negative_amount": F.col("amount") < 0,
        }),
        gaps(contacts, "contact", {"no_email": missing("email"), "no_lead_source": missing("lead_source")}),
        gaps(leads, "lead", {"no_email": missing("email"), "no_lead_source": missing("lead_source")}),
        gaps(accounts, "account", {"no_revenue": missing("annual_revenue"), "no_employees": missing("number_of_employees")}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- history ---------------------------------------------------------------------------------------------


def pipeline_waterfall(history: DataFrame, on: date | datetime) -> DataFrame:
    """Deals and amounts per stage as they stood on a past date."""
    return as_of(history, on).groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("deals"), F.sum("amount").cast(MONEY).alias("amount")
    )


def stage_velocity(history: DataFrame, now: datetime) -> DataFrame:
    """Days spent per stage over all versions; open versions count up to ``now``."""
    until = F.coalesce(F.col("valid_to").cast("date"), today(now))
    return history.groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum(days_between(F.col("valid_from"), until)).alias("total_days"),
        F.max(days_between(F.col("valid_from"), until)).alias("max_days"),
    )


def stage_regression(history: DataFrame, stages: DataFrame, key: str, min_rows: int = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Moves to an earlier stage: one row per version that follows a later-ordered one.

    ``counted`` may name a table, such as the raw versions, that has at least as many rows of each key.
    """
    order = stages.select("stage_name", "stage_order")
    # Versions in a stage without an order stay: the move after them starts there.
    ranked = history.select(key, "stage_name", "valid_from").join(order, "stage_name", "left")
    moved = with_neighbours(
        ranked, key, "valid_from",
        preceding={"from_stage": "stage_name", "from_order": "stage_order"}, min_rows=min_rows, counted=counted,
    )
    return moved.filter(F.col("from_order") > F.col("stage_order")).select(
        key, "from_stage", F.col("stage_name").alias("to_stage"), F.col("valid_from").alias("moved_at")
    )


def forecast_accuracy(history: DataFrame) -> DataFrame:
    """Amount forecast at each quarter's start for deals due in it, against what was won in it."""
    quarter = F.trunc("close_date", "quarter")
    start = quarter.cast("timestamp_ntz")
    at_start = (F.col("valid_from") <= start) & (F.col("valid_to").isNull() | (start < F.col("valid_to")))
    weighted = (F.col("amount").cast("decimal(30,2)") * F.col("probability_pct") / 100).cast(MONEY)
    is_open, is_won = ~F.col("is_closed"), F.col("is_won") & F.col("valid_to").isNull()
    per_quarter = (
        history.filter(F.col("close_date").isNotNull())
        .groupBy(quarter.alias("quarter_start"))
        .agg(
            F.count_if(at_start & is_open).alias("forecast_deals"),
            F.sum(F.when(at_start & is_open, weighted).otherwise(F.lit(0).cast(MONEY))).cast(MONEY).alias("forecast_amount"),
            F.count_if(is_won).alias("won_deals"),
            F.sum(F.when(is_won, F.col("amount")).otherwise(F.lit(0).cast(MONEY))).cast(MONEY).alias("won_amount"),
        )
    )
    q = F.col("quarter_start")
    return per_quarter.withColumns(
        {
            "fiscal_quarter_label": fiscal_label(F.year(q), F.quarter(q)),
            "accuracy_ratio": ratio(F.col("forecast_amount"), F.col("won_amount")),
        }
    )
