"""Registered queries: landing, typed loads, streaming loads, raw tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from bindings.crm import Crm, show
from bindings.crm_views import AS_OF
from revstream.catalog import OBJECTS, source_name
from revstream.operators.extract import extract_objects
from revstream.operators.incremental import DEFAULT_WATERMARK, incremental_extract
from revstream.operators.quality import union_all
from revstream.operators.watermark import WatermarkStore
from revstream.plans import monitor
from revstream.session import scratch_dir
from revstream.sources import landing
from revstream.sources.listing import list_files
from revstream.sources.tables import Table
from revstream.streaming import ingest

QUERIES = {}
RUN_1 = datetime(2026, 8, 1, 6, tzinfo=timezone.utc)
RUN_2 = datetime(2026, 8, 2, 7, 30, tzinfo=timezone.utc)
EPOCH = datetime(1990, 1, 1, tzinfo=timezone.utc)


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: show(fn(Crm(spark, sf_dir)))
    return fn


DEAL = (
    "id", "name", "type", "accountid", "stagename", "amount", "probability", "closedate", "fiscalquarter", "isclosed",
    "iswon", "leadsource", "createddate", "systemmodstamp",
)


def _extract(c: Crm, obj: str = "Opportunity", where: str = "true"):
    return incremental_extract(c.raw(obj).filter(where), obj, EPOCH)


def _land(c: Crm, obj: str = "Opportunity") -> str:
    """Two runs: rows modified before 2023, then the rest."""
    root = scratch_dir(c.spark, "landing")
    landing.land_ndjson(_extract(c, obj, "systemmodstamp < date '2023-01-01'"), root, obj, RUN_1)
    landing.land_ndjson(_extract(c, obj, "systemmodstamp >= date '2023-01-01'"), root, obj, RUN_2)
    return root


@query
def scan_ndjson(c: Crm):
    """Deals written as NDJSON and loaded back with their stored types."""
    wire = landing.scan_ndjson(c.spark, landing.object_path(_land(c), "Opportunity"), "Opportunity")
    return landing.load_typed(wire, "Opportunity", AS_OF).select(*DEAL)


@query
def land_partition_scan(c: Crm):
    wire = landing.land_partition_scan(c.spark, _land(c), "Opportunity", "2026-08-02", "2026-08-31")
    return landing.load_typed(wire, "Opportunity", AS_OF).select(*DEAL)


def _wire(c: Crm):
    """Deals as wire text; some amounts, dates and flags unreadable, some blank."""
    rows = _extract(c)
    text = rows.select(*[F.col(n).cast("string").alias(n) for n in rows.columns])
    k = F.col("Id").cast("bigint")
    return text.withColumns(
        {
            "Amount": F.when(k % 50 == 7, "12,5").when(k % 50 == 9, "").otherwise(F.col("Amount")),
            "CloseDate": F.when(k % 70 == 3, "soon").otherwise(F.col("CloseDate")),
            "IsWon": F.when(k % 90 == 4, "maybe").otherwise(F.col("IsWon")),
        }
    )


@query
def load_typed(c: Crm):
    return landing.load_typed(_wire(c), "Opportunity", AS_OF).select(*DEAL)


@query
def quarantine_bad_rows(c: Crm):
    _, bad = landing.split_bad_rows(landing.load_typed(_wire(c), "Opportunity", AS_OF))
    return bad.select("id", "amount", F.col("_bad_fields").alias("bad_fields"))


@query
def good_rows(c: Crm):
    good, _ = landing.split_bad_rows(landing.load_typed(_wire(c), "Opportunity", AS_OF))
    return good.select("id", "amount", "closedate")


@query
def load_metadata(c: Crm):
    """Rows, named files and first ordinal per extract run, from the load columns."""
    wire = landing.scan_ndjson(c.spark, landing.object_path(_land(c), "Opportunity"), "Opportunity")
    loaded = landing.load_typed(wire, "Opportunity", AS_OF)
    return loaded.groupBy(
        F.col("_source_object").alias("source_object"),
        F.col("_extract_timestamp").alias("extract_timestamp"),
        F.col("_load_timestamp").alias("load_timestamp"),
    ).agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.count_if(F.col("_file_name").endswith(".json")).alias("rows_with_file"),
        F.min("_file_row_number").alias("first_row_number"),
    )


@query
def variant_extract(c: Crm):
    events = c.spark.read.parquet(f"{c.sf_dir}/events.parquet")
    kept = events.select("event_id", F.try_parse_json("props").alias("raw_data"))
    return kept.select(
        "event_id",
        landing.variant_extract(kept, "raw_data", "$.k", "bigint").alias("k"),
        landing.variant_extract(kept, "raw_data", "$.new_field", "string").alias("new_field"),
    )


@query
def scan_csv_pages(c: Crm):
    path = scratch_dir(c.spark, "csv")
    pages = _extract(c).write.option("header", True).option("maxRecordsPerFile", landing.ROWS_PER_FILE)
    pages.options(**landing.TIMESTAMP_TEXT).csv(path)
    return landing.load_typed(landing.scan_csv_pages(c.spark, path, "Opportunity"), "Opportunity", AS_OF).select(*DEAL)


@query
def scan_csv_headers(c: Crm):
    """Pages with swapped, missing and additional columns, each read by its own header."""
    path = scratch_dir(c.spark, "csv")
    rows, kind = _extract(c), F.col("Id") % 3
    pages = {
        "swapped": rows.filter(kind == 0).select(*reversed(rows.columns)),
        "missing": rows.filter(kind == 1).drop("Amount", "LeadSource"),
        "more": rows.filter(kind == 2).withColumn("Region__c", F.lit("north, east")).select("Region__c", *rows.columns),
    }
    for name, page in pages.items():
        page.write.option("header", True).options(**landing.TIMESTAMP_TEXT).csv(f"{path}/{name}")
    return landing.load_typed(landing.scan_csv_pages(c.spark, f"{path}/*", "Opportunity"), "Opportunity", AS_OF).select(*DEAL)


@query
def append_raw(c: Crm):
    """Two appends to a raw table laid out by modification month, then a read of its recent part."""
    path = scratch_dir(c.spark, "raw")
    for where in ("systemmodstamp < date '2023-01-01'", "systemmodstamp >= date '2023-01-01'"):
        landing.append_raw(c.raw("Opportunity").filter(where).select("id", "amount", "systemmodstamp"), path)
    return landing.read_raw(c.spark, path, datetime(2024, 6, 10, tzinfo=timezone.utc))


@query
def auto_ingest(c: Crm):
    """Two landings, each followed by a load, and a file of an old run date that arrives last."""
    root, obj = scratch_dir(c.spark, "landing"), "CampaignMember"
    table, checkpoint = scratch_dir(c.spark, "ingested"), scratch_dir(c.spark, "stream")
    late = datetime(2026, 5, 1, tzinfo=timezone.utc)
    for run, where in ((RUN_1, "status not in ('click', 'view')"), (RUN_2, "status = 'click'"), (late, "status = 'view'")):
        landing.land_ndjson(_extract(c, obj, where), root, obj, run)
        ingest.auto_ingest(c.spark, root, obj, table, checkpoint, AS_OF)
    ingest.auto_ingest(c.spark, root, obj, table, checkpoint, AS_OF)
    loaded = ingest.read_ingested(c.spark, table)
    return loaded.select(
        "id", "campaignid", "leadid", "contactid", "status", "hasresponded", "firstrespondeddate", "isdeleted", "createddate"
    )


@query
def ingest_ledger(c: Crm):
    """Deals landed in two runs, some unreadable, loaded, and the reports over the ledger of that load."""
    root, obj = scratch_dir(c.spark, "landing"), "Opportunity"
    table, checkpoint = scratch_dir(c.spark, "ingested"), scratch_dir(c.spark, "stream")
    wire = _wire(c)
    for run, part in ((RUN_1, F.col("Id").cast("bigint") % 2 == 0), (RUN_2, F.col("Id").cast("bigint") % 2 == 1)):
        landing.land_ndjson(wire.filter(part), root, obj, run)
        ingest.auto_ingest(c.spark, root, obj, table, checkpoint, AS_OF)
    ledger = ingest.read_ledger(c.spark, table)
    landed = list_files(c.spark, landing.object_path(root, obj), "*.json").filter("bytes > 0").select(F.lit(obj).alias("pipe_name"), "file_name")
    status = monitor.pipe_status(landed, ledger, AS_OF).select("pipe_name", "pending")
    per_day = monitor.files_per_pipe_day(ledger, AS_OF).groupBy("pipe_name").agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors").alias("errors"))
    failed = monitor.failed_files(ledger, AS_OF, limit=1_000_000).groupBy("pipe_name").agg(
        F.sum("error_count").alias("errors_of_failed_files"), F.count_if(F.col("first_error_line_number").isNull()).alias("files_without_line")
    )
    quarantined = ingest.read_ingested(c.spark, table, bad=True).groupBy(F.col("_source_object").alias("pipe_name")).agg(F.count(F.lit(1)).alias("bad_rows"))
    return status.join(per_day, "pipe_name").join(failed, "pipe_name").join(quarantined, "pipe_name")


@query
def fold_months(c: Crm):
    """Deals loaded in six batches; months with several small files are folded after the fourth and the last.

    Rows and amounts by month, and whether a month's rows are in two files at most: its fold and the newest batch.
    """
    root, obj = scratch_dir(c.spark, "landing"), "Opportunity"
    table, checkpoint = scratch_dir(c.spark, "ingested"), scratch_dir(c.spark, "stream")
    rows = _extract(c)
    for part in range(6):
        landing.land_ndjson(rows.filter(F.col("Id").cast("bigint") % 6 == part), root, obj, RUN_1)
        ingest.auto_ingest(c.spark, root, obj, table, checkpoint, AS_OF)
        if part in (3, 5):
            ingest.fold_months(c.spark, table, min_files=2)
    files = ingest.ingested_files(c.spark, table).groupBy("mod_month").agg((F.count(F.lit(1)) <= 2).alias("clustered"))
    months = ingest.read_ingested(c.spark, table).groupBy(F.trunc("systemmodstamp", "month").alias("mod_month"))
    return months.agg(F.count(F.lit(1)).alias("deals"), F.sum("amount").alias("amount")).join(files, "mod_month")


@query
def stream_upsert(c: Crm):
    """Deal versions arriving out of order end as the newest version of each deal."""
    root, obj = scratch_dir(c.spark, "landing"), "Opportunity"
    table, checkpoint = Table(c.spark, scratch_dir(c.spark, "upserted")), scratch_dir(c.spark, "stream")
    for run, versions in ((RUN_1, "version <> 2"), (RUN_2, "version = 2")):
        rows = incremental_extract(c.raw("OpportunityVersion").filter(versions), obj, DEFAULT_WATERMARK)
        landing.land_ndjson(rows, root, obj, run, compression="gzip")
        ingest.stream_upsert(c.spark, root, obj, table, checkpoint, loaded_at=AS_OF)
    return table.read().select("id", "stagename", "amount", "systemmodstamp")


@query
def table_growth(c: Crm):
    """Raw tables of all objects by a listing of their files; row counts from the files' footers."""
    root = scratch_dir(c.spark, "raw")
    for obj in OBJECTS:
        landing.append_raw(c.raw(obj).select("id", F.col("systemmodstamp").cast("timestamp_ntz").alias("systemmodstamp")), f"{root}/{source_name(obj)}")
    tables = {source_name(obj): landing.read_raw(c.spark, f"{root}/{source_name(obj)}") for obj in OBJECTS}
    rows = union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])
    sizes = monitor.table_growth(list_files(c.spark, root, "*.parquet"), root, AS_OF, rows)
    checked = (F.col("bytes") > 0) & (F.col("created") <= F.col("last_altered")) & (F.col("minutes_since_refresh") == F.timestamp_diff("MINUTE", F.date_trunc("minute", F.col("last_altered")), F.lit(AS_OF).cast("timestamp_ntz")))
    return sizes.select("table_name", "row_count", checked.alias("sized"), (F.col("files") > 0).alias("listed"))


def _extracted(c: Crm, **how):
    """One extract of four objects after an earlier run, its log and the watermarks it leaves."""
    objects = ["Account", "Opportunity", "Campaign", "User"]
    store, root = WatermarkStore(c.spark, scratch_dir(c.spark, "watermarks")), scratch_dir(c.spark, "landing")
    store.set_all({o: datetime(2022, 1, 1, tzinfo=timezone.utc) for o in objects})
    log = extract_objects(c.spark, {o: (lambda o=o: c.raw(o)) for o in objects}, store, root, run_ts=RUN_1, backoff=(), **how)
    return log.join(store.get_all(objects), "object").select("object", "status", "records", "watermark_used", "watermark")


@query
def extract_backfill(c: Crm):
    """A backfill reads from its own start and leaves the watermarks alone."""
    return _extracted(c, backfill_start="2021-06-01T00:00:00Z")


@query
def extract_dry_run(c: Crm):
    """A dry run says where it would start; it reads and moves nothing."""
    return _extracted(c, dry_run=True)


@query
def extract_incremental(c: Crm):
    """A run reads half an hour before each watermark and moves it to its own start."""
    return _extracted(c)
