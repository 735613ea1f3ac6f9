"""Data-quality checks. A check is a DataFrame of failing rows; none failing means it passed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstream.functions.scalars import hours_between
from revstream.operators.incremental import loaded_at, ntz
from revstream.session import scratch, shuffles_released, written
from revstream.sources.tables import Table

# -- conditions a failing row meets ------------------------------------------------------------------


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_unaccepted(column: str, values: list) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def is_out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Both bounds are accepted values; NULL passes."""
    below = F.col(column) < low if low is not None else F.lit(False)
    above = F.col(column) > high if high is not None else F.lit(False)
    return below | above


# -- failing rows ------------------------------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are not compared."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(is_unaccepted(column, values))


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.filter(is_out_of_range(column, low, high))


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0).groupBy(column).agg(F.count(F.lit(1)).alias("failure_count"))


def amount_without_close_date(pipeline: DataFrame) -> DataFrame:
    bad = F.col("close_date_id").isNull() & (F.col("amount") > 0)
    return pipeline.filter(bad).select("opportunity_id", "opportunity_name", "amount", "close_date_id")


def won_in_pipeline(bookings: DataFrame, pipeline: DataFrame) -> DataFrame:
    return bookings.select("opportunity_id").join(pipeline.select("opportunity_id"), "opportunity_id", "left_semi")


def booking_missing_in_win_rate(bookings: DataFrame, win_rate: DataFrame) -> DataFrame:
    return bookings.select("opportunity_id").join(win_rate.select("opportunity_id"), "opportunity_id", "left_anti")


def freshness(
    tables: dict[str, DataFrame],
    as_of: datetime,
    column: str | None = None,
    warn_hours: int = 2,
    error_hours: int = 6,
    source: str = "landing",
) -> DataFrame:
    """Newest load per source and its state: pass, warn after two hours, error after six.

    ``column`` holds the time of loading; by default it is that of the feed named by ``source``.
    """
    column = column or loaded_at(source)
    newest = union_all(
        [df.agg(F.max(column).alias("latest_load")).select(F.lit(n).alias("source_name"), "latest_load") for n, df in tables.items()]
    )
    age = F.timestamp_diff("SECOND", F.col("latest_load").cast("timestamp_ntz"), ntz(as_of))
    state = (
        F.when(age.isNull() | (age > error_hours * 3600), "error").when(age > warn_hours * 3600, "warn").otherwise("pass")
    )
    return newest.withColumns({"age_hours": hours_between(F.col("latest_load"), ntz(as_of)), "status": state})


def campaign_reconcile(performance: DataFrame) -> DataFrame:
    """Campaigns whose derived counts differ from the CRM's own roll-ups, one row per differing measure."""
    pairs = {
        "leads": ("lead_members", "sf_number_of_leads"),
        "contacts": ("contact_members", "sf_number_of_contacts"),
        "responses": ("responded_members", "sf_number_of_responses"),
        "opportunities": ("total_opportunities", "sf_opportunities"),
        "won_opportunities": ("won_opportunities", "sf_won_opportunities"),
    }
    measures = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col(a).cast("bigint").alias("derived"), F.col(b).cast("bigint").alias("reported"))
            for m, (a, b) in pairs.items()
        ]
    )
    rows = performance.select("campaign_id", F.explode(measures).alias("m")).select("campaign_id", "m.*")
    return rows.filter(~F.col("derived").eqNullSafe(F.col("reported")))


# -- running many checks -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A check on one column of one table."""

    table: str
    kind: str
    column: str
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})"

    def condition(self) -> Column:
        if self.kind == "not_null":
            return is_missing(self.column)
        if self.kind == "accepted_values":
            return is_unaccepted(self.column, list(self.values))
        if self.kind == "accepted_range":
            return is_out_of_range(self.column, self.low, self.high)
        raise ValueError(f"not a row condition: {self.kind}")


_SEGMENTS = ("SMB", "Mid-Market", "Enterprise", "Strategic", "Unknown")
# Accepted texts.
LEAD_STATUSES = (
    "Open - Not Contacted", "Working - Contacted", "Closed - Not Converted", "Closed - Converted", "Nurturing",
)
DEAL_BANDS = ("Small  (< $10K)", "Mid    ($10K–$50K)", "Large  ($50K–$250K)", "Enterprise ($250K+)", "Unknown")
BOOKING_CATEGORIES = ("New Logo", "Renewal", "Expansion", "Other")


def _keyed(table: str, *columns: str) -> list[Check]:
    return [Check(table, kind, c) for c in columns for kind in ("not_null", "unique")]


def _filled(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c) for c in columns]


SOURCES = (
    "account", "contact", "lead", "opportunity", "opportunity_line_item", "campaign", "campaign_member", "task", "event", "user",
)

# The standing checks on deduplicated sources, staging tables, enriched frames, seeds, dimensions and facts.
CHECKS: list[Check] = [
    *[check for source in SOURCES for check in _keyed(f"src_{source}", "id")],
    *_keyed("opportunity_enriched", "opportunity_id"),
    *_keyed("lead_enriched", "lead_id"),
    *_keyed("stage_order", "stage_name"),
    *_filled("stage_order", "stage_order"),
    *_keyed("bookings_targets", "fiscal_quarter_label"),
    *_keyed("stg_accounts", "account_id"),
    *_filled("stg_accounts", "account_name", "owner_id", "updated_at"),
    *_keyed("stg_contacts", "contact_id"),
    *_filled("stg_contacts", "account_id", "updated_at"),
    *_keyed("stg_leads", "lead_id"),
    *_filled("stg_leads", "updated_at"),
    Check("stg_leads", "accepted_values", "status", "warn", values=LEAD_STATUSES),
    *_keyed("stg_opportunities", "opportunity_id"),
    *_filled("stg_opportunities", "account_id", "close_date", "stage_name"),
    Check("stg_opportunities", "accepted_range", "amount", "warn", low=0),
    *_keyed("stg_line_items", "opportunity_line_item_id"),
    *_filled("stg_line_items", "opportunity_id"),
    *_keyed("stg_campaigns", "campaign_id"),
    *_keyed("stg_campaign_members", "campaign_member_id"),
    *_filled("stg_campaign_members", "campaign_id"),
    *_keyed("stg_tasks", "task_id"),
    *_keyed("stg_events", "event_id"),
    *_keyed("stg_users", "user_id"),
    *_filled("stg_users", "email"),
    Check("stg_users", "unique", "email", "warn"),
    *_keyed("dim_account", "account_sk", "account_id"),
    *_filled("dim_account", "account_name"),
    Check("dim_account", "accepted_values", "employee_segment", values=_SEGMENTS),
    Check("dim_account", "accepted_values", "revenue_segment", values=_SEGMENTS),
    *_keyed("dim_contact", "contact_sk", "contact_id"),
    *_keyed("dim_lead", "lead_sk", "lead_id"),
    *_keyed("dim_user", "user_sk", "user_id"),
    *_filled("dim_user", "email"),
    Check("dim_user", "unique", "email", "warn"),
    *_keyed("dim_campaign", "campaign_sk", "campaign_id"),
    *_keyed("dim_date", "date_id"),
    *_keyed("fct_sales_pipeline", "pipeline_id", "opportunity_id"),
    *_filled("fct_sales_pipeline", "account_sk", "close_date_id"),
    Check("fct_sales_pipeline", "accepted_range", "amount", "warn", low=0),
    Check("fct_sales_pipeline", "accepted_range", "probability_pct", low=0, high=100),
    *_keyed("fct_bookings", "booking_id", "opportunity_id"),
    *_filled("fct_bookings", "booking_amount", "booking_date_id"),
    Check("fct_bookings", "accepted_range", "booking_amount", low=0),
    Check("fct_bookings", "accepted_values", "booking_category", values=BOOKING_CATEGORIES),
    *_keyed("fct_win_rate", "win_rate_id", "opportunity_id"),
    *_filled("fct_win_rate", "is_won", "is_lost"),
    Check("fct_win_rate", "accepted_values", "deal_size_band", values=DEAL_BANDS),
    *_keyed("fct_campaign_performance", "campaign_performance_id", "campaign_id"),
    *_filled("fct_campaign_performance", "campaign_name"),
    Check("fct_campaign_performance", "accepted_range", "response_rate_pct", "warn", low=0, high=100),
    *_keyed("fct_demand_generation", "demand_gen_id", "campaign_member_id"),
    *_filled("fct_demand_generation", "campaign_id", "is_mql", "is_sql", "is_customer"),
    Check("fct_demand_generation", "accepted_values", "member_type", values=("Lead", "Contact")),
]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _wanted(tables: dict[str, DataFrame], checks: list[Check] | None) -> dict[str, list[Check]]:
    found: dict[str, list[Check]] = {}
    for c in checks if checks is not None else CHECKS:
        if c.table in tables:
            found.setdefault(c.table, []).append(c)
    return found


def failing_rows(tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """``table_name, checks, failing_row``: every failing row once, as JSON, with the names of all checks it fails.

    All row conditions of a table are tried in one pass over it. Uniqueness needs one grouping per column, which
    combines on the map side; there a failing row is a repeated value with its count. Of these only the columns
    checked are read.
    """
    parts = []
    for name, mine in _wanted(tables, checks).items():
        df = tables[name]
        conditions = [F.when(c.condition(), F.lit(c.name)) for c in mine if c.kind != "unique"]
        if conditions:
            tagged = df.withColumn("_checks", F.array_compact(F.array(*conditions)).cast("array<string>")).filter(F.size("_checks") > 0)
            parts.append(tagged.select(F.lit(name).alias("table_name"), F.col("_checks").alias("checks"), F.to_json(F.struct(*df.columns)).alias("failing_row")))
        for c in mine:
            if c.kind == "unique":
                repeated = unique(df, c.column)
                parts.append(repeated.select(F.lit(name).alias("table_name"), F.array(F.lit(c.name)).cast("array<string>").alias("checks"), F.to_json(F.struct(*repeated.columns)).alias("failing_row")))
    if not parts:
        raise ValueError("no check on any of the tables")
    return reduce(DataFrame.union, parts)


def results_of(failures: DataFrame, tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """One result row per check on the given tables, from their failing rows: failures, severity and status."""
    counts = failures.select("table_name", F.explode("checks").alias("_check")).groupBy("table_name", "_check").agg(F.count(F.lit(1)).alias("failures"))
    rows = [(c.table, c.column, c.kind, c.severity, c.name) for mine in _wanted(tables, checks).values() for c in mine]
    listed = failures.sparkSession.createDataFrame(rows, "table_name string, column_name string, check_name string, severity string, _check string")
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return (
        listed.join(counts, ["table_name", "_check"], "left")
        .withColumn("failures", F.coalesce("failures", F.lit(0).cast("long")))
        .select("table_name", "column_name", "check_name", "severity", "failures", status.alias("status"))
    )


def run_checks(tables: dict[str, DataFrame], checks: list[Check] | None = None, failures: Table | None = None) -> DataFrame:
    """Result rows of the checks. With ``failures`` the failing rows are kept in that table, and counted there.

    Tables are checked one after the other, and the shuffle files of one go before the next: all in one plan, those of
    every uniqueness check lie on disk at once.
    """
    wanted = _wanted(tables, checks)
    if not wanted:
        raise ValueError("no check on any of the tables")
    spark = next(iter(tables.values())).sparkSession
    with shuffles_released(spark), scratch(spark) as store:
        if failures is not None:
            failures.overwrite(reduce(DataFrame.union, [store(failing_rows({name: tables[name]}, checks), "failures") for name in wanted]))
            found = failures.read()
        else:
            found = reduce(DataFrame.union, [written(failing_rows({name: tables[name]}, checks).drop("failing_row"), "failures") for name in wanted])
    return results_of(found, tables, checks)
