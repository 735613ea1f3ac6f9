"""The CRM plans bound to the shared tables: every frame built on demand from the raw views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.crm_views import AS_OF, view
from revstream.operators.dedup import dedup_latest, newest_first
from revstream.operators.scd import scd2_build
from revstream.plans import dims, enrich, facts, staging
from revstream.session import Scratch

LINE_ITEM_ORDER = ("systemmodstamp", "product2id", "pricebookentryid", "quantity", "totalprice")


def show(df: DataFrame) -> DataFrame:
    """Columns in types that read the same from both engines: decimals as double, dates and flags as text."""

    def cast(f: T.StructField) -> str:
        if isinstance(f.dataType, T.DecimalType):
            return f"cast({f.name} as double) as {f.name}"
        if isinstance(f.dataType, (T.DateType, T.BooleanType)):
            return f"cast({f.name} as string) as {f.name}"
        return f.name

    return df.selectExpr(*[cast(f) for f in df.schema.fields])


class Crm:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name, self.tables)

    def stg(self, obj: str) -> DataFrame:
        raw = self.raw(obj)
        if obj == "OpportunityLineItem":
            raw = dedup_latest(raw, "id", newest_first(*LINE_ITEM_ORDER))
        return staging.stage(raw, obj)

    accounts = cached_property(lambda self: self.stg("Account"))
    contacts = cached_property(lambda self: self.stg("Contact"))
    leads = cached_property(lambda self: self.stg("Lead"))
    opportunities = cached_property(lambda self: self.stg("Opportunity"))
    line_items = cached_property(lambda self: self.stg("OpportunityLineItem"))
    campaigns = cached_property(lambda self: self.stg("Campaign"))
    members = cached_property(lambda self: self.stg("CampaignMember"))
    tasks = cached_property(lambda self: self.stg("Task"))
    events = cached_property(lambda self: self.stg("Event"))
    users = cached_property(lambda self: self.stg("User"))

    def enriched(self, keys: bool = True, store: Scratch | None = None) -> DataFrame:
        return enrich.opportunity_enriched(
            self.opportunities, self.accounts, self.users, self.campaigns, self.line_items, AS_OF, keys, store
        )

    @cached_property
    def lead_enriched(self) -> DataFrame:
        return enrich.lead_enriched(self.leads, self.users, self.members, self.campaigns)

    dim_account = cached_property(lambda self: dims.dim_account(self.accounts, self.users, AS_OF))
    dim_contact = cached_property(lambda self: dims.dim_contact(self.contacts, self.accounts, self.users, AS_OF))
    dim_lead = cached_property(lambda self: dims.dim_lead(self.lead_enriched, AS_OF))
    dim_user = cached_property(lambda self: dims.dim_user(self.users, AS_OF))
    dim_campaign = cached_property(lambda self: dims.dim_campaign(self.campaigns, self.users, AS_OF))

    measures = cached_property(lambda self: facts.deal_measures(self.opportunities))
    pipeline = cached_property(lambda self: facts.fct_sales_pipeline(self.enriched(), AS_OF))
    bookings = cached_property(lambda self: facts.fct_bookings(self.enriched(), AS_OF))
    win_rate = cached_property(lambda self: facts.fct_win_rate(self.enriched(), AS_OF))

    @cached_property
    def campaign_performance(self) -> DataFrame:
        return facts.fct_campaign_performance(self.campaigns, self.members, self.opportunities, AS_OF)

    @cached_property
    def demand(self) -> DataFrame:
        return facts.fct_demand_generation(
            self.members, self.leads, self.contacts, self.campaigns, self.opportunities, AS_OF
        )

    @cached_property
    def opportunity_history(self) -> DataFrame:
        versions = staging.project(self.raw("OpportunityVersion"), "Opportunity").select(
            "opportunity_id", "stage_name", "amount", "probability_pct", "close_date", "is_closed", "is_won", "owner_id", "updated_at", "is_deleted"
        )
        return scd2_build(versions, "opportunity_id", deleted="is_deleted", counted=self.deal_versions)

    deal_versions = cached_property(lambda self: self.raw("OpportunityVersion").select(F.col("id").alias("opportunity_id")))
    account_versions = cached_property(lambda self: self.raw("AccountVersion").select(F.col("id").alias("account_id")))

    @cached_property
    def account_history(self) -> DataFrame:
        versions = staging.project(self.raw("AccountVersion"), "Account").select(
            "account_id", "industry", "owner_id", "updated_at"
        )
        return scd2_build(versions, "account_id", counted=self.account_versions)
