"""Registered queries: incremental reads, deduplication, upserts and history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.crm import LINE_ITEM_ORDER, Crm, show
from bindings.crm_views import AS_OF
from revstream.catalog import OBJECTS
from revstream.operators.dedup import dedup_latest, newest_first
from revstream.operators.extract import extract_objects
from revstream.operators.incremental import apply_lookback, exclude_deleted, incremental_extract, incremental_filter, ntz
from revstream.operators.ordered import as_of_join
from revstream.operators.quality import union_all
from revstream.operators.scd import as_of, deliver_versions, live, scd2_snapshot, scd2_step
from revstream.operators.upsert import merge_upsert
from revstream.operators.watermark import WatermarkStore
from revstream.plans import build as graph
from revstream.plans.staging import project, stage
from revstream.session import scratch_dir
from revstream.sources.tables import Table, compact_dedup

QUERIES = {}
WATERMARK = datetime(2024, 3, 1, 0, 20, tzinfo=timezone.utc)
# Times of three successive snapshot runs.
RUNS = datetime(2022, 1, 1), datetime(2024, 1, 1), datetime(2027, 1, 1)


def query(name: str):
    """Register ``fn(crm) -> DataFrame`` under ``name``."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: show(fn(Crm(spark, sf_dir)))
        return fn

    return register


LINE_COLUMNS = "id", "opportunityid", "product2id", "pricebookentryid", "quantity", "totalprice", "systemmodstamp"


@query("dedup_latest")
def dedup_latest_rows(c: Crm):
    raw = c.raw("OpportunityLineItem")
    return dedup_latest(raw, "id", newest_first(*LINE_ITEM_ORDER)).select(*LINE_COLUMNS)


@query("dedup_latest_since")
def dedup_latest_since(c: Crm):
    raw = c.raw("OpportunityLineItem")
    return dedup_latest(raw, "id", newest_first(*LINE_ITEM_ORDER), since=WATERMARK).select(*LINE_COLUMNS)


@query("compact_dedup")
def compact_dedup_table(c: Crm):
    table = Table(c.spark, scratch_dir(c.spark, "compact"))
    table.append(c.raw("OpportunityLineItem"))
    compact_dedup(table, "id", newest_first(*LINE_ITEM_ORDER))
    return table.read().select(*LINE_COLUMNS)


@query("exclude_deleted")
def exclude_deleted_rows(c: Crm):
    return exclude_deleted(c.raw("Opportunity")).select("id", "name", "amount")


@query("incremental_extract")
def incremental_extract_rows(c: Crm):
    rows = incremental_extract(c.raw("Opportunity"), "Opportunity", apply_lookback(WATERMARK))
    return rows.select("Id", "StageName", "Amount", "CloseDate", "IsWon", "LeadSource", "SystemModstamp", "NextStep")


@query("incremental_filter")
def incremental_filter_rows(c: Crm):
    """The deals the next run re-reads when staging holds everything modified before 2025."""
    raw = c.raw("Opportunity")
    target = stage(raw.filter("systemmodstamp < date '2025-01-01'"), "Opportunity")
    return incremental_filter(raw, target).select("id", "systemmodstamp")


@query("watermark_get_all")
def watermark_get_all(c: Crm):
    """Watermarks written at each object's newest change; users are left unwritten."""
    objects = [o for o in OBJECTS if o != "User"]
    newest = union_all(
        [
            c.raw(o).agg(F.date_trunc("second", F.max("systemmodstamp")).cast("timestamp_ntz").alias("ts")).select(F.lit(o).alias("object"), "ts")
            for o in objects
        ]
    )
    store = WatermarkStore(c.spark, scratch_dir(c.spark, "watermarks"))
    store.set_all({r["object"]: r["ts"] for r in newest.collect()})
    return store.get_all()


@query("run_log")
def run_log(c: Crm):
    """One extract run over the ten objects, from the default watermark."""
    store = WatermarkStore(c.spark, scratch_dir(c.spark, "watermarks"))
    sources = {o: (lambda o=o: c.raw(o)) for o in OBJECTS}
    log = extract_objects(c.spark, sources, store, scratch_dir(c.spark, "landing"), run_ts=AS_OF, backoff=())
    return log.select("object", "status", "records", "watermark_used", "attempts")


VERSION_COLUMNS = "id", "version", "stagename", "amount", "isclosed", "systemmodstamp"


def _versions(c: Crm, n: int):
    return c.raw("OpportunityVersion").filter(F.col("version") == n).select(*VERSION_COLUMNS)


def _changes(c: Crm):
    """Final versions of deals changed since 2023, and the deals deleted since."""
    final = c.raw("OpportunityVersion").filter("version = 3 and systemmodstamp >= date '2023-01-01'")
    return final.filter("not isdeleted").select(*VERSION_COLUMNS), final.filter("isdeleted").select("id")


@query("merge_upsert")
def merge_upsert_rows(c: Crm):
    updates, deletes = _changes(c)
    return merge_upsert(_versions(c, 1), updates, "id", newer="systemmodstamp", deletes=deletes)


@query("upsert_table")
def upsert_table(c: Crm):
    """The same merge through a stored table, then a replay of older versions, which changes nothing."""
    table = Table(c.spark, scratch_dir(c.spark, "upsert"))
    table.upsert(_versions(c, 1), "id", buckets=16)
    updates, deletes = _changes(c)
    table.upsert(updates, "id", newer="systemmodstamp", deletes=deletes)
    replay = _versions(c, 2).join(table.read().filter("version = 3").select("id"), "id", "left_semi")
    table.upsert(replay, "id", newer="systemmodstamp")
    return table.read()


@query("sync_columns")
def sync_columns_table(c: Crm):
    """An upsert whose rows bring a new column and lack an old one."""
    table = Table(c.spark, scratch_dir(c.spark, "sync"))
    table.upsert(_versions(c, 1), "id", buckets=16)
    updates, _ = _changes(c)
    table.upsert(updates.drop("stagename").withColumn("region", F.concat(F.lit("R"), F.col("id") % 3)), "id")
    return table.read()


def _current(c: Crm, run: datetime):
    """The staged deals as a snapshot run at ``run`` sees them."""
    seen = c.raw("OpportunityVersion").filter(F.col("systemmodstamp") <= ntz(run))
    staged = stage(dedup_latest(seen, "id"), "Opportunity")
    return staged.select("opportunity_id", "stage_name", "amount", "updated_at")


@query("scd2_snapshot")
def scd2_snapshot_runs(c: Crm):
    history = None
    for run in RUNS:
        history = scd2_snapshot(history, _current(c, run), "opportunity_id", now=run)
    return history


@query("scd2_snapshot_table")
def scd2_snapshot_table(c: Crm):
    """The same three runs stored as a snapshot table."""
    table = Table(c.spark, scratch_dir(c.spark, "snapshot"))
    for run in RUNS:
        table.snapshot(scd2_step(table.open_versions(), _current(c, run), "opportunity_id", now=run, closed=table.closed_versions()))
    return table.read()


HISTORY_COLUMNS = "opportunity_id", "stage_name", "amount", "probability_pct", "close_date", "scd_id", "valid_from", "valid_to"


@query("scd2_build")
def scd2_build_history(c: Crm):
    return c.opportunity_history.select(*HISTORY_COLUMNS)


@query("history_late_versions")
def history_late_versions(c: Crm):
    """Deal versions delivered in three shuffled parts, each with some of the part before once more."""
    versions = project(c.raw("OpportunityVersion"), "Opportunity").select(
        "opportunity_id", "stage_name", "amount", "probability_pct", "close_date", "updated_at", "is_deleted"
    )
    part = F.pmod(F.xxhash64("opportunity_id", "updated_at"), F.lit(3))
    again = F.pmod(F.xxhash64("updated_at", "opportunity_id"), F.lit(7)) == 0
    table = Table(c.spark, scratch_dir(c.spark, "history"))
    for i in range(3):
        deliver_versions(table, versions.filter((part == i) | ((part == i - 1) & again)), "opportunity_id", buckets=16)
    return live(table.read(), "is_deleted").select(*HISTORY_COLUMNS)


@query("as_of")
def as_of_rows(c: Crm):
    at = datetime(2025, 6, 15, 12)
    return as_of(c.opportunity_history, at).select("opportunity_id", "stage_name", "amount", "valid_from", "valid_to")


@query("as_of_join")
def as_of_join_rows(c: Crm):
    """Deals with their account's industry and owner when the deal was created."""
    deals = c.opportunities.select("opportunity_id", "account_id", "created_at", "amount")
    columns = {"industry_then": "industry", "owner_then": "owner_id"}
    counted = c.account_versions.union(c.raw("Opportunity").select("accountid"))
    return as_of_join(deals, c.account_history, "account_id", "created_at", columns, counted=counted)


def _raw(c: Crm, until: datetime | None = None) -> dict:
    """Raw rows of every object, deals and line items as of ``until``."""
    raw = {o: c.raw(o) for o in OBJECTS}
    if until is not None:
        raw = {o: df.filter(F.col("systemmodstamp") <= ntz(until)) for o, df in raw.items()}
    return raw


def _built(c: Crm, raw: dict, path: str, as_of: datetime):
    orders = {"OpportunityLineItem": newest_first(*LINE_ITEM_ORDER)}
    return graph.build(c.spark, raw, path, as_of, dedup_orders=orders, buckets=4, checks=False, parallel=8)


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table and the sum of 48 bits of every row's digest; the time of building is left out."""

    def text(f: T.StructField):
        col = F.col(f.name)
        return F.coalesce((col.cast("decimal(38,2)") if isinstance(f.dataType, (T.DecimalType, T.DoubleType)) else col).cast("string"), F.lit("~"))

    columns = sorted((f for f in df.schema.fields if f.name != "built_at"), key=lambda f: f.name)
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *map(text, columns))), 1, 12), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("fingerprint")
    return df.agg(F.count(F.lit(1)).alias("row_count"), total).select(F.lit(name).alias("table_name"), "row_count", "fingerprint")


@query("build_marts")
def build_marts(c: Crm):
    """Two runs of the whole graph, the second incremental; every table's rows and fingerprint, history included."""
    path = scratch_dir(c.spark, "warehouse")
    first = datetime(2026, 4, 1)
    _built(c, _raw(c, first), path, first)
    wh = _built(c, _raw(c), path, AS_OF)
    tables = [*graph.CHECKED, *(f"history_{graph.STAGING[o][4:]}" for o in graph.SNAPSHOTS)]
    return union_all([fingerprint(wh.read(n).select("date_id") if n == "dim_date" else wh.read(n), n) for n in tables])


# What the first run of ``incremental_facts`` sees of rows modified after a day: two in three with these older values.
EARLIER = {
    "Account": ("2020-03-01", {"industry": "'OLD'", "numberofemployees": "1", "ownerid": "(ownerid + 1) % 10"}),
    "User": ("2019-01-01", {"department": "'OLD'"}),
    "Campaign": ("2025-11-01", {"name": "name || ' (old)'", "actualcost": "actualcost + 1"}),
    "Lead": ("2026-04-01", {"company": "'OLD'", "convertedopportunityid": "convertedopportunityid + 7"}),
    "Contact": ("2020-03-01", {"title": "'OLD'"}),
    "Opportunity": ("2026-03-01", {"accountid": "accountid + 1", "campaignid": "(campaignid + 1) % 200", "isclosed": "false", "iswon": "false", "stagename": "'Prospecting'"}),
    "OpportunityLineItem": ("2026-07-01", {"opportunityid": "opportunityid + 1", "totalprice": "totalprice * 2"}),
    "CampaignMember": ("2026-01-28", {"campaignid": "(campaignid + 1) % 200", "leadid": "leadid + 2"}),
}


def _earlier(c: Crm) -> dict:
    """Raw rows before the last changes: of the rows changed later a third is missing, the others differ and are not deleted."""
    raw = _raw(c)
    for obj, (day, older) in EARLIER.items():
        df = raw[obj]
        late = F.col("systemmodstamp") > F.lit(day).cast("timestamp_ntz")
        values = {n: F.expr(e) for n, e in older.items()} | {"systemmodstamp": F.expr("systemmodstamp - interval 1500 days")}
        values |= {"isdeleted": F.lit(False)} if "isdeleted" in df.columns else {}
        then = df.filter(late & (F.col("id") % 3 != 0)).withColumns({n: e.cast(df.schema[n].dataType) for n, e in values.items()})
        raw[obj] = df.filter(~late).unionByName(then.select(*df.columns))
    return raw


@query("incremental_facts")
def incremental_facts(c: Crm):
    """Facts after a run that merges only what changed accounts, owners, campaigns, people, deals and line items touch."""
    path = scratch_dir(c.spark, "warehouse")
    _built(c, _earlier(c), path, datetime(2026, 8, 1))
    wh = _built(c, _raw(c), path, AS_OF)
    return union_all([fingerprint(wh.read(n), n) for n in graph.FACTS])


@query("staging_full_refresh")
def staging_full_refresh(c: Crm):
    """Deals staged as a whole, then again from the rows changed since 2024 alone."""
    wh = graph.Warehouse(c.spark, scratch_dir(c.spark, "staging"))
    raw = c.raw("Opportunity")
    graph.update_staging(wh, raw, "Opportunity", buckets=8)
    graph.update_staging(wh, raw.filter("systemmodstamp >= date '2024-01-01'"), "Opportunity", full_refresh=True, buckets=8)
    return wh.read("stg_opportunities").select("opportunity_id", "amount", "updated_at")


@query("staging_connector")
def staging_connector(c: Crm):
    """Deals from the other feed, whose delete flag has another name; those deleted since leave staging."""
    wh = graph.Warehouse(c.spark, scratch_dir(c.spark, "staging"))
    raw = c.raw("Opportunity").withColumnRenamed("isdeleted", "_fivetran_deleted")
    before = raw.withColumns({"_fivetran_deleted": F.lit(False), "systemmodstamp": F.expr("systemmodstamp - interval 3000 days")})
    for rows in (before, raw):
        graph.update_staging(wh, rows, "Opportunity", source="connector", buckets=8)
    return wh.read("stg_opportunities").select("opportunity_id", "amount", "updated_at")


@query("project_keeps_deleted")
def project_keeps_deleted(c: Crm):
    """Staged columns of all account rows, deleted ones included."""
    return project(c.raw("Account"), "Account").select("account_id", "account_name", "is_deleted", "annual_revenue")
