"""Load, usage and freshness reports over the ingest ledgers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revstream.functions.scalars import hours_between, minutes_between, seconds_between
from revstream.operators.incremental import as_utc, ntz
from revstream.operators.ordered import with_neighbours
from revstream.operators.quality import union_all
from revstream.operators.quantile import exact_percentiles
from revstream.sources.listing import folder_below

# Fixed value: price per credit.
CREDIT_PRICE = "3.00"
GIB = 1 << 30


def _last(df: DataFrame, column: str, as_of: datetime, **span: int) -> DataFrame:
    return df.filter(F.col(column) >= ntz(as_utc(as_of) - timedelta(**span)))


def files_per_pipe_day(loads: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    lag = seconds_between(F.col("first_error_timestamp"), F.col("last_load_time"))
    return (
        _last(loads, "last_load_time", as_of, days=days)
        .groupBy("pipe_name", F.to_date("last_load_time").alias("load_date"))
        .agg(
            F.count(F.lit(1)).alias("files_loaded"),
            F.sum("row_count").alias("rows_loaded"),
            F.sum("error_count").alias("errors"),
            F.avg(lag).alias("avg_file_lag_seconds"),
        )
        .orderBy("pipe_name", F.desc("load_date"))
    )


def failed_files(loads: DataFrame, as_of: datetime, days: int = 7, limit: int = 100) -> DataFrame:
    """The newest files with load errors, a top-k report."""
    columns = (
        "pipe_name last_load_time file_name row_count error_count first_error_message first_error_line_number "
        "first_error_column_name"
    )
    recent = _last(loads, "last_load_time", as_of, days=days).filter(F.col("error_count") > 0)
    return recent.select(*columns.split()).orderBy(F.desc("last_load_time"), "file_name").limit(limit)


def _cost(df: DataFrame, *keys) -> DataFrame:
    credits = F.sum("credits_used")
    return df.groupBy(*keys).agg(
        credits.alias("total_credits"), (credits * F.lit(CREDIT_PRICE).cast("decimal(5,2)")).alias("estimated_cost_usd")
    )


def pipe_cost(usage: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    out = _cost(_last(usage, "start_time", as_of, days=days), "pipe_name")
    return out.orderBy(F.desc("total_credits"), "pipe_name")


def compute_cost_daily(usage: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    day = F.to_date("start_time").alias("usage_date")
    out = _cost(_last(usage, "start_time", as_of, days=days), "warehouse_name", day)
    return out.withColumnRenamed("total_credits", "credits_used").orderBy("warehouse_name", F.desc("usage_date"))


def query_stats(queries: DataFrame, as_of: datetime, tag_prefix: str = "build", days: int = 7, limit: int = 50) -> DataFrame:
    return (
        _last(queries, "start_time", as_of, days=days)
        .filter(F.col("query_tag").startswith(tag_prefix) & (F.col("execution_status") == "SUCCESS"))
        .groupBy("warehouse_name", "query_type")
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            F.sum("credits_used_cloud_services").alias("cloud_service_credits"),
            (F.avg("execution_time") / 1000).alias("avg_execution_sec"),
            (F.max("execution_time") / 1000).alias("max_execution_sec"),
        )
        .orderBy(F.desc("query_count"), "warehouse_name", "query_type")
        .limit(limit)
    )


def slowest_queries(queries: DataFrame, as_of: datetime, tag_prefix: str = "build", days: int = 7, limit: int = 20) -> DataFrame:
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    return (
        _last(queries, "start_time", as_of, days=days)
        .filter(F.col("query_tag").startswith(tag_prefix) & (F.col("query_type") == "SELECT"))
        .orderBy(F.desc("execution_time"), "query_text")
        .limit(limit)
        .select(
            "query_tag",
            "query_text",
            "warehouse_name",
            F.round(whole("execution_time") / 1000, 1).alias("execution_sec"),
            F.round(whole("bytes_scanned") / GIB, 2).alias("gb_scanned"),
            "rows_produced",
            "start_time",
        )
    )


def latency_percentiles(queries: DataFrame, as_of: datetime, tag_prefix: str = "build", days: int = 30) -> DataFrame:
    """Median, 95th percentile and maximum seconds per day, exact."""
    tagged = (
        _last(queries, "start_time", as_of, days=days)
        .filter(F.col("query_tag").startswith(tag_prefix))
        .select(F.to_date("start_time").alias("run_date"), (F.col("execution_time") / 1000).alias("sec"))
    )
    totals = tagged.groupBy("run_date").agg(F.count(F.lit(1)).alias("queries_run"), F.max("sec").alias("max_sec"))
    points = exact_percentiles(tagged, "run_date", "sec", {"p50_sec": 0.5, "p95_sec": 0.95})
    return totals.join(points, "run_date", "left").orderBy(F.desc("run_date"))


def freshness_report(tables: dict[str, DataFrame], as_of: datetime, column: str = "_load_timestamp") -> DataFrame:
    newest = union_all(
        [df.agg(F.max(column).cast("timestamp_ntz").alias("latest_load")).select(F.lit(n).alias("view_name"), "latest_load") for n, df in tables.items()]
    )
    return newest.withColumn("minutes_ago", minutes_between(F.col("latest_load"), ntz(as_of))).orderBy(
        F.desc("minutes_ago"), "view_name"
    )


def table_growth(files: DataFrame, root: str, as_of: datetime, rows: DataFrame | None = None) -> DataFrame:
    """Files, size and age per table, the first folder below ``root``, from a listing (``list_files``).

    ``rows`` (table_name, row_count) adds row counts, e.g. from load ledgers; no contents are read for the rest.
    """
    sizes = files.groupBy(folder_below(root).alias("table_name")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("modified_at").alias("last_altered"),
        F.min("modified_at").alias("created"),
    )
    counted = sizes.withColumn("row_count", F.lit(None).cast("long")) if rows is None else sizes.join(rows, "table_name", "left")
    return counted.select(
        "table_name",
        "row_count",
        "files",
        "bytes",
        F.round(F.col("bytes").cast("decimal(20,0)") / GIB, 3).alias("size_gb"),
        "last_altered",
        "created",
        minutes_between(F.col("last_altered"), ntz(as_of)).alias("minutes_since_refresh"),
    ).orderBy(F.desc_nulls_last("row_count"), F.desc("bytes"), "table_name")


def duplicate_report(tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    parts = []
    for name, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("distinct_ids"))
        parts.append(counts.select(F.lit(name).alias("object_name"), "total_rows", "distinct_ids"))
    out = union_all(parts).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_ids"))
    return out.orderBy(F.desc("duplicate_rows"), "object_name")


def dedup_run_history(runs: DataFrame, as_of: datetime, hours: int = 48) -> DataFrame:
    recent = _last(runs, "scheduled_time", as_of, hours=hours).filter(F.col("name").startswith("TASK_DEDUP_"))
    took = seconds_between(F.col("scheduled_time"), F.col("completed_time"))
    return recent.withColumn("duration_sec", took).orderBy(F.desc("scheduled_time"))


def stale_alert(table: DataFrame, as_of: datetime, column: str = "_load_timestamp", hours: int = 3) -> DataFrame:
    """One row when the newest load is ``hours`` old or older, no row otherwise."""
    newest = table.agg(F.max(column).cast("timestamp_ntz").alias("latest_load"))
    aged = newest.withColumn("hours_old", hours_between(F.col("latest_load"), ntz(as_of)))
    return aged.filter(F.col("hours_old") >= hours)


def ingest_health(status: DataFrame) -> DataFrame:
    """Readiness over all pipes. ``status``: pipe_name, state, pending (negative when unknown), failed."""
    not_error = F.col("state") != "ERROR"
    known = F.when(F.col("pending") >= 0, F.col("pending"))
    agg = status.agg(
        F.coalesce(F.max(known), F.lit(0)).alias("max_pending"),
        F.coalesce(F.bool_or(F.col("state") == "ERROR"), F.lit(False)).alias("any_pipe_errors"),
        F.coalesce(F.bool_or(F.col("failed") > 0), F.lit(False)).alias("any_failed_files"),
        F.coalesce(F.bool_and(F.when(not_error, F.col("state") == "RUNNING")), F.lit(True)).alias("all_running"),
        F.count(F.lit(1)).alias("pipe_count"),
    )
    ready = (F.col("max_pending") == 0) & ~F.col("any_pipe_errors")
    return agg.withColumn("all_pipes_ready", ready)


# A pipe is in error when its last loads all had errors and are at least so many, and stalled when it has been
# silent for longer than so many of its usual gaps.
ERROR_STREAK, SILENT_GAPS = 3, 5


def outcome_runs(loads: DataFrame, block: str = "day") -> DataFrame:
    """Runs of consecutive loads of a pipe with one outcome: ``pipe_name, run, failed, loads, first_load, last_load``.

    Loads are numbered into runs per pipe and time block; a table with a row per block carries the last outcome
    and the count of changes across blocks, so a pipe with most of the loads is spread over as many tasks as it has
    blocks. Loads at one time are ordered by file name.
    """
    events = loads.filter(F.col("last_load_time").isNotNull()).select(
        "pipe_name", "file_name", F.col("last_load_time").alias("at"), (F.coalesce("error_count", F.lit(0)) > 0).alias("failed"), F.date_trunc(block, "last_load_time").alias("_block")
    )
    within = Window.partitionBy("pipe_name", "_block").orderBy("at", "file_name")
    before = F.lag("failed").over(within)
    marked = events.withColumn("_change", F.when(before != F.col("failed"), 1).otherwise(0))
    order = F.struct("at", "file_name")
    blocks = marked.groupBy("pipe_name", "_block").agg(F.min_by("failed", order).alias("_first"), F.max_by("failed", order).alias("_last"), F.sum("_change").alias("_changes"))
    across = Window.partitionBy("pipe_name").orderBy("_block")
    entered = F.when(F.lag("_last").over(across) != F.col("_first"), 1).otherwise(0)
    blocks = blocks.withColumn("_entered", entered).withColumn("_base", F.sum(F.col("_entered") + F.col("_changes")).over(across) - F.col("_changes"))
    numbered = marked.withColumn("_nth", F.sum("_change").over(within)).join(blocks.select("pipe_name", "_block", "_base"), ["pipe_name", "_block"])
    return numbered.groupBy("pipe_name", (F.col("_base") + F.col("_nth")).alias("run")).agg(
        F.min("failed").alias("failed"), F.count(F.lit(1)).alias("loads"), F.min("at").alias("first_load"), F.max("at").alias("last_load")
    )


def usual_gaps(loads: DataFrame) -> DataFrame:
    """``pipe_name, usual_gap``: the median of the seconds between a pipe's load times, NULL for a single one."""
    times = loads.filter(F.col("last_load_time").isNotNull()).select("pipe_name", F.col("last_load_time").alias("at")).distinct()
    gaps = with_neighbours(times, "pipe_name", "at", preceding={"before": "at"}).select(
        "pipe_name", (F.unix_micros(F.col("at").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))).alias("gap")
    )
    micros = exact_percentiles(gaps, "pipe_name", "gap", {"usual": 0.5})
    return micros.select("pipe_name", (F.col("usual") / 1_000_000).alias("usual_gap"))


def pipe_states(loads: DataFrame, as_of: datetime, error_streak: int = ERROR_STREAK, silent_gaps: float = SILENT_GAPS) -> DataFrame:
    """State of every pipe from its load events: ERROR, STALLED or RUNNING, and what it rests on."""
    runs = outcome_runs(loads)
    last = F.max_by(F.struct("failed", "loads"), "run")
    per_pipe = runs.groupBy("pipe_name").agg(
        last.alias("_last"),
        F.max("last_load").alias("last_load_time"),
        F.count_if("failed").alias("error_runs"),
        F.coalesce(F.max(F.when(F.col("failed"), F.col("loads"))), F.lit(0)).alias("longest_error_run"),
    )
    joined = per_pipe.join(usual_gaps(loads), "pipe_name", "left")
    errors = F.when(F.col("_last.failed"), F.col("_last.loads")).otherwise(0)
    silence = (F.unix_micros(ntz(as_of).cast("timestamp")) - F.unix_micros(F.col("last_load_time").cast("timestamp"))) / 1_000_000
    state = F.when(F.col("trailing_errors") >= error_streak, "ERROR").when(silence > F.col("usual_gap") * silent_gaps, "STALLED").otherwise("RUNNING")
    return joined.withColumn("trailing_errors", errors).select(
        "pipe_name", state.alias("state"), "trailing_errors", "error_runs", "longest_error_run", "usual_gap", "last_load_time"
    )


def pipe_status(landed_files: DataFrame, loads: DataFrame, as_of: datetime) -> DataFrame:
    """State, pending and failed files per pipe, from the files landed (pipe_name, file_name) and the load ledger.

    A pipe that has landed files but never loaded one is IDLE.
    """
    loaded = loads.groupBy("pipe_name", "file_name").agg(F.max("error_count").alias("error_count"))
    joined = landed_files.join(loaded, ["pipe_name", "file_name"], "left")
    counts = joined.groupBy("pipe_name").agg(F.count_if(F.col("error_count").isNull()).alias("pending"), F.count_if(F.col("error_count") > 0).alias("failed"))
    states = pipe_states(loads, as_of).select("pipe_name", "state")
    return counts.join(states, "pipe_name", "left").select("pipe_name", F.coalesce("state", F.lit("IDLE")).alias("state"), "pending", "failed")
