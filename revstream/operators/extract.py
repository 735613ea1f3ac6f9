"""One incremental extract run over many objects: windows, isolation, retries and the run log."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revstream.operators.incremental import LOOKBACK_MINUTES, apply_lookback, as_utc, incremental_extract
from revstream.operators.watermark import WatermarkStore
from revstream.sources.landing import ROWS_PER_FILE, land_ndjson
from revstream.sources.tables import Table

RUN_LOG = (
    "run_timestamp string, object string, status string, records bigint, watermark_used string, attempts int, "
    "error string"
)
# Errors that a retry cannot fix.
PERMANENT = (AnalysisException, ValueError)


def extract_objects(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame]],
    store: WatermarkStore,
    landing_root: str,
    run_ts: datetime | None = None,
    backfill_start: datetime | str | None = None,
    dry_run: bool = False,
    parallel: int = 5,
    backoff: tuple[float, ...] = (30, 90),
    lookback_minutes: int = LOOKBACK_MINUTES,
    log_table: Table | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    compression: str = "gzip",
) -> DataFrame:
    """Extract and land every object in ``sources``; returns one run-log row per object.

    The rows are also appended to ``log_table`` when one is given. ``compression`` is that of the landing files.

    The watermark of each object moves to the run's *start* as soon as that object landed, so changes made
    while the run is in flight are read again by the next one; a run that dies before that lands its rows
    again, and deduplication settles it. A backfill leaves watermarks alone. One failing object does not
    stop the others, whether its watermark, its source or its landing fails.
    """
    run_ts = as_utc(run_ts or datetime.now(timezone.utc))
    one_at_a_time = Lock()  # of the store's users

    def since(obj: str) -> datetime:
        if backfill_start:
            return as_utc(backfill_start)
        with one_at_a_time:
            return apply_lookback(store.get(obj), lookback_minutes)

    def land(obj: str, start: datetime) -> int:
        written = Observation()
        rows = incremental_extract(sources[obj](), obj, start).observe(written, F.count(F.lit(1)).alias("n"))
        land_ndjson(rows, landing_root, obj, run_ts, rows_per_file, compression)
        return written.get["n"]

    def run(obj: str) -> tuple:
        attempt, error, start = 0, None, None
        for attempt in range(1, len(backoff) + 2):
            try:
                start = since(obj)
                if dry_run:
                    return (run_ts.isoformat(), obj, "dry_run", 0, start.isoformat(), 0, None)
                records = land(obj, start)
                if not backfill_start:
                    with one_at_a_time:
                        store.set_all({obj: run_ts})
                return (run_ts.isoformat(), obj, "success", records, start.isoformat(), attempt, None)
            except PERMANENT as e:
                error = e
                break
            except Exception as e:  # noqa: BLE001 - any failure is this object's alone
                error = e
                if attempt <= len(backoff):
                    time.sleep(backoff[attempt - 1])
        used = start.isoformat() if start else None
        return (run_ts.isoformat(), obj, "error", 0, used, attempt, str(error).split("\n")[0])

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(sources) or 1))) as pool:
        results = list(pool.map(run, sources))
    log = spark.createDataFrame(results, RUN_LOG)
    if log_table is not None:
        log_table.append(log)
    return log


def run_summary(log: DataFrame) -> DataFrame:
    """One row per run: objects, total records and the objects that failed."""
    failed = F.when(F.col("status") == "error", F.col("object"))
    return log.groupBy("run_timestamp").agg(
        F.count(F.lit(1)).alias("objects_run"),
        F.sum("records").alias("total_records"),
        F.count_if(F.col("status") == "error").alias("failure_count"),
        F.array_join(F.sort_array(F.collect_set(failed)), ",").alias("failures"),
    )
