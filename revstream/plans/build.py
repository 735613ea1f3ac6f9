"""One run of the whole batch graph: staging, history, dimensions, facts, checks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.catalog import source_name
from revstream.functions.scalars import surrogate_key
from revstream.operators.dedup import dedup_latest
from revstream.operators.incremental import LOOKBACK_DAYS, delete_flag, incremental_filter
from revstream.operators.quality import run_checks
from revstream.operators.scd import scd2_step
from revstream.plans import changes, dims, enrich, facts
from revstream.plans.staging import UNIQUE_KEYS, conform, stage
from revstream.session import Scratch, scratch, shuffles_released
from revstream.sources import seeds
from revstream.sources.tables import BUCKETS, Table

STAGING = {
    "Account": "stg_accounts",
    "Contact": "stg_contacts",
    "Lead": "stg_leads",
    "Opportunity": "stg_opportunities",
    "OpportunityLineItem": "stg_line_items",
    "Campaign": "stg_campaigns",
    "CampaignMember": "stg_campaign_members",
    "Task": "stg_tasks",
    "Event": "stg_events",
    "User": "stg_users",
}
SNAPSHOTS = ("Account", "Contact", "Lead", "Opportunity")
ENRICHED = "opportunity_enriched"


def at_once(spark: SparkSession, parallel: int) -> int:
    """How many tables are built side by side: ``parallel``, and at most one for two cores.

    More do not end sooner; they only hold their plans in the driver and their shuffle files on disk.
    """
    return max(1, min(parallel, spark.sparkContext.defaultParallelism // 2))


def _together(jobs: list[Callable[[], None]], parallel: int) -> None:
    """Run independent table builds side by side; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


class Warehouse:
    """The tables of one run, by name, under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.path}/{name}")

    def read(self, name: str) -> DataFrame:
        df = self.table(name).read()
        if df is None:
            raise ValueError(f"no table {name}")
        return df


def update_staging(
    wh: Warehouse,
    raw: DataFrame,
    obj: str,
    full_refresh: bool = False,
    deletes: str = "propagate",
    lookback_days: int = LOOKBACK_DAYS,
    dedup_order: list | None = None,
    source: str = "landing",
    buckets: int = BUCKETS,
    record: bool = False,
) -> None:
    """Merge the recently changed raw rows of one object into its staging table.

    A full refresh, or an empty target, loads everything. ``deletes="propagate"`` removes keys whose
    latest version is deleted; ``"ignore"`` leaves the last live version in place. ``record`` adds the keys that
    the merge changes to the object's pending changes, before it is committed: a run that dies in between leaves
    keys too many, never too few.
    """
    table, key = wh.table(STAGING[obj]), UNIQUE_KEYS[obj]
    target = None if full_refresh else table.read()
    # The lookback filter goes below the deduplication: a key with any changed version has its latest
    # version among them.
    changed = incremental_filter(conform(raw, obj), target, days=lookback_days)
    latest = dedup_latest(changed, "id", dedup_order)
    if target is None:
        table.overwrite(stage(latest, obj, source), key, buckets)
        return
    with scratch(wh.spark) as store:
        latest = store(_storable(latest), "latest")  # feeds the updates and the deletes
        updates, gone = stage(latest, obj, source), None
        if deletes == "propagate" and obj != "User":
            gone = latest.filter(delete_flag(latest, source)).select(F.col("id").alias(key))
        if record:
            pending(wh, obj).append(changes.changed_rows(target, updates, gone, key, changes.PARENTS[obj]))
        table.upsert(updates, key, deletes=gone, materialize=False)


def _storable(df: DataFrame) -> DataFrame:
    """``df`` with columns that have no type, which files cannot hold, as text."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)})


def pending(wh: Warehouse, obj: str) -> Table:
    """Keys of an object's staging rows that changed since the facts were last brought up to date."""
    return wh.table(f"changes_{STAGING[obj][4:]}")


RUNS = "as_of timestamp_ntz, state string, run int"
FULL_STARTED, DONE = "full started", "done"


def last_run(wh: Warehouse) -> tuple[str, datetime] | None:
    """State and time of the last entry of the warehouse's run ledger."""
    runs = wh.table("runs").read()
    row = None if runs is None else runs.orderBy(F.desc("run")).first()
    return None if row is None else (row["state"], row["as_of"])


def log_run(wh: Warehouse, as_of: datetime, state: str) -> None:
    table = wh.table("runs")
    head = table.head()
    table.append(wh.spark.createDataFrame([(as_of.replace(tzinfo=None), state, head.version + 1 if head else 1)], RUNS))


def merge_fact(
    wh: Warehouse,
    name: str,
    updates: DataFrame,
    key: str,
    touched: DataFrame,
    ids: str,
    insert_only: bool = False,
    keep_as: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace the rows of a fact whose source ids are ``touched`` by ``updates``; those without an update go.

    With ``insert_only`` stored rows stay as they are; with ``keep_as`` rows without an update stay as it makes them.
    ``updates`` is read several times: it is a stored frame or a cheap projection of one.
    """
    table = wh.table(name)
    gone = touched.select((surrogate_key(ids) if key != ids else F.col(ids)).alias(key)).join(updates.select(key), key, "left_anti")
    if insert_only:
        table.upsert(updates, key, insert_only=True, materialize=False)
        return
    if keep_as is not None:
        left = keep_as(table.read().join(gone, key, "left_semi")).select(*updates.columns)
        table.upsert(updates.unionByName(left), key)
        return
    table.upsert(updates, key, deletes=gone, materialize=False)


def update_snapshot(wh: Warehouse, obj: str, now: datetime) -> None:
    table = wh.table(f"history_{STAGING[obj][4:]}")
    current = wh.read(STAGING[obj])
    table.snapshot(scd2_step(table.open_versions(), current, UNIQUE_KEYS[obj], "updated_at", now, closed=table.closed_versions()))


def pipeline_after(target: DataFrame | None, current: DataFrame, closed: str = "drop") -> DataFrame:
    """The pipeline table after a run. Deals no longer open are dropped, or kept with ``is_active = false``."""
    if target is None or closed == "drop":
        return current
    if closed != "flag":
        raise ValueError(f"closed must be 'drop' or 'flag', not {closed!r}")
    gone = target.join(current.select("pipeline_id"), "pipeline_id", "left_anti")
    return current.unionByName(gone.withColumn("is_active", F.lit(False)))


def rewrite_facts(wh: Warehouse, stg: dict[str, DataFrame], as_of: datetime, full_refresh: bool, bookings_insert_only: bool, closed_deals: str, buckets: int, parallel: int) -> None:
    """All facts from all of staging."""
    acc, con, led, opp = (stg[o] for o in ("Account", "Contact", "Lead", "Opportunity"))
    usr, cam, mem = (stg[o] for o in ("User", "Campaign", "CampaignMember"))
    # Three facts read this, so it is joined and stored once.
    with scratch(wh.spark) as store:
        joined = enrich.opportunity_enriched(opp, acc, usr, cam, stg["OpportunityLineItem"], as_of, keys=True, store=store)
        wh.table(ENRICHED).overwrite(joined, "opportunity_id", buckets)
    enriched = wh.read(ENRICHED)
    pipeline, ledger = wh.table("fct_sales_pipeline"), wh.table("fct_bookings")
    still_open = pipeline_after(pipeline.read(), facts.fct_sales_pipeline(enriched, as_of), closed_deals)
    performance = facts.fct_campaign_performance(cam, mem, opp, as_of)
    demand = facts.fct_demand_generation(mem, led, con, cam, opp, as_of)
    bookings = facts.fct_bookings(enriched, as_of)
    if bookings_insert_only and not full_refresh:
        book = partial(ledger.upsert, bookings, "booking_id", insert_only=True, buckets=buckets, materialize=False)
    else:
        book = partial(ledger.overwrite, bookings, "booking_id", buckets)
    _together(
        [
            partial(pipeline.overwrite, still_open, "pipeline_id", buckets),
            book,
            partial(wh.table("fct_win_rate").overwrite, facts.fct_win_rate(enriched, as_of), "win_rate_id", buckets),
            partial(wh.table("fct_campaign_performance").overwrite, performance, "campaign_performance_id", buckets),
            partial(wh.table("fct_demand_generation").overwrite, demand, "demand_gen_id", buckets),
        ],
        parallel,
    )


def merge_facts(wh: Warehouse, stg: dict[str, DataFrame], as_of: datetime, day_changed: bool, bookings_insert_only: bool, closed_deals: str, parallel: int) -> None:
    """Only the fact rows that pending changes touch are computed and merged.

    Each side of a lookup is cut to the rows the touched ones refer to before it is joined. On a new day the
    deals whose measures count to today are touched as well.
    """
    if closed_deals not in ("drop", "flag"):
        raise ValueError(f"closed must be 'drop' or 'flag', not {closed_deals!r}")
    acc, con, led, opp = (stg[o] for o in ("Account", "Contact", "Lead", "Opportunity"))
    usr, cam, mem, items = (stg[o] for o in ("User", "Campaign", "CampaignMember", "OpportunityLineItem"))
    found = {}
    for obj, parent in changes.PARENTS.items():
        rows, key = pending(wh, obj).read(), UNIQUE_KEYS[obj]
        found[obj] = rows if rows is not None else stg[obj].select(key, *([parent] if parent else [])).limit(0)
    only = changes.only

    def sales(store: Scratch) -> None:
        touched = store(changes.touched_opportunities(opp, found, day_changed), "touched-deals")
        if touched.isEmpty():
            return
        deals = store(only(opp, "opportunity_id", touched), "deals")
        sides = only(acc, "account_id", deals), only(usr, "user_id", deals, "owner_id"), only(cam, "campaign_id", deals)
        with scratch(wh.spark) as steps:
            rows = store(enrich.opportunity_enriched(deals, *sides, only(items, "opportunity_id", touched), as_of, keys=True, store=steps), ENRICHED, deals)
        keep_as = (lambda gone: gone.withColumn("is_active", F.lit(False))) if closed_deals == "flag" else None
        merge = partial(merge_fact, wh, touched=touched, ids="opportunity_id")
        # One after the other: each holds shuffle files of whole rows.
        merge(ENRICHED, rows, "opportunity_id")
        merge("fct_sales_pipeline", facts.fct_sales_pipeline(rows, as_of), "pipeline_id", keep_as=keep_as)
        merge("fct_bookings", facts.fct_bookings(rows, as_of), "booking_id", insert_only=bookings_insert_only)
        merge("fct_win_rate", facts.fct_win_rate(rows, as_of), "win_rate_id")

    def campaigns(store: Scratch) -> None:
        touched = store(changes.touched_campaigns(found), "touched-campaigns")
        if not touched.isEmpty():
            rows = store(facts.fct_campaign_performance(*[only(df, "campaign_id", touched) for df in (cam, mem, opp)], as_of), "fct_campaign_performance")
            merge_fact(wh, "fct_campaign_performance", rows, "campaign_performance_id", touched, "campaign_id")

    def demand(store: Scratch) -> None:
        touched = store(changes.touched_members(mem, led, found), "touched-members")
        if not touched.isEmpty():
            members = store(only(mem, "campaign_member_id", touched), "members")
            people = store(only(led, "lead_id", members), "people")
            deals = only(opp, "opportunity_id", people, "converted_opportunity_id")
            rows = store(facts.fct_demand_generation(members, people, only(con, "contact_id", members), only(cam, "campaign_id", members), deals, as_of), "fct_demand_generation")
            merge_fact(wh, "fct_demand_generation", rows, "demand_gen_id", touched, "campaign_member_id")

    def cleared(merges: Callable[[Scratch], None]) -> None:
        with scratch(wh.spark) as store:
            merges(store)

    _together([partial(cleared, merges) for merges in (sales, campaigns, demand)], parallel)


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    path: str,
    as_of: datetime,
    full_refresh: bool = False,
    dedup_orders: dict[str, list] | None = None,
    bookings_insert_only: bool = False,
    closed_deals: str = "drop",
    buckets: int = BUCKETS,
    checks: bool = True,
    parallel: int = 4,
    source: str = "landing",
    deletes: str = "propagate",
    lookback_days: int = LOOKBACK_DAYS,
) -> Warehouse:
    """Run the graph once. Staging comes before history, so history reflects this run's data.

    Facts end as a full refresh would leave them (but for ``built_at``, the run that last computed the row): the
    rows that this run's changes touch are computed again and merged. All rows are computed when a staging table
    was loaded as a whole, a fact is missing, or the last such run did not end. With ``bookings_insert_only`` the
    bookings are a ledger instead: rows once booked stay as they were. ``source``, ``deletes`` and
    ``lookback_days`` are those of ``update_staging``.

    Every stage reads stored tables, so no plan spans the graph and a lost executor replays one stage.
    Tables that do not depend on each other are built ``parallel`` at a time (see ``at_once``). Shuffle files go when the action that
    made them has ended: what it wrote is read from then on.
    """
    wh, parallel = Warehouse(spark, path), at_once(spark, parallel)
    with shuffles_released(spark):
        before = last_run(wh)

        def staging(obj: str) -> None:
            order = (dedup_orders or {}).get(obj)
            record = obj in changes.PARENTS
            update_staging(wh, raw[obj], obj, full_refresh, deletes, lookback_days, order, source, buckets, record)

        unfinished = before is not None and before[0] == FULL_STARTED
        rewrite = full_refresh or unfinished or any(wh.table(t).head() is None for t in (*FACTS, *(STAGING[o] for o in changes.PARENTS)))
        if rewrite:
            log_run(wh, as_of, FULL_STARTED)
        _together([partial(staging, obj) for obj in STAGING], parallel)

        stg = {obj: wh.read(name) for obj, name in STAGING.items()}
        acc, con, led, usr = (stg[o] for o in ("Account", "Contact", "Lead", "User"))
        cam, mem = stg["Campaign"], stg["CampaignMember"]
        rebuilt = {
            "dim_account": dims.dim_account(acc, usr, as_of),
            "dim_contact": dims.dim_contact(con, acc, usr, as_of),
            "dim_lead": dims.dim_lead(enrich.lead_enriched(led, usr, mem, cam), as_of),
            "dim_user": dims.dim_user(usr, as_of),
            "dim_campaign": dims.dim_campaign(cam, usr, as_of),
            "dim_date": dims.dim_date(spark, as_of),
        }
        _together(
            [partial(wh.table(name).overwrite, df) for name, df in rebuilt.items()]
            + [partial(update_snapshot, wh, obj, as_of) for obj in SNAPSHOTS],
            parallel,
        )
        if rewrite:
            rewrite_facts(wh, stg, as_of, full_refresh, bookings_insert_only, closed_deals, buckets, parallel)
        else:
            merge_facts(wh, stg, as_of, before is None or before[1].date() != as_of.date(), bookings_insert_only, closed_deals, parallel)
        log_run(wh, as_of, DONE)
        for obj in changes.PARENTS:  # carried into the facts now
            table = pending(wh, obj)
            if table.head() is not None and table.head().row_count:
                table.overwrite(table.read().limit(0))
        if checks:
            wh.table("quality_results").overwrite(check_tables(wh, raw, dedup_orders))
    return wh


FACTS = ("fct_sales_pipeline", "fct_bookings", "fct_win_rate", "fct_campaign_performance", "fct_demand_generation")
CHECKED = (
    *STAGING.values(),
    "dim_account", "dim_contact", "dim_lead", "dim_user", "dim_campaign", "dim_date",
    *FACTS,
)


def check_tables(wh: Warehouse, raw: dict[str, DataFrame] | None = None, dedup_orders: dict[str, list] | None = None) -> DataFrame:
    """Results of the standing checks on a built warehouse, its seeds and, where given, its sources.

    Failing rows stay in table ``quality_failures``.
    """
    tables = {name: wh.read(name) for name in (*CHECKED, ENRICHED)}
    tables["lead_enriched"] = wh.read("dim_lead").select("lead_id")  # one row per enriched lead
    tables |= {"stage_order": seeds.stage_order(wh.spark), "bookings_targets": seeds.bookings_targets(wh.spark)}
    for obj, df in (raw or {}).items():
        tables[f"src_{source_name(obj)}"] = dedup_latest(conform(df, obj), "id", (dedup_orders or {}).get(obj)).select("id")
    return run_checks(tables, failures=wh.table("quality_failures"))
