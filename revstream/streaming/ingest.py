"""New landing files into raw tables, each file once, and raw changes into a keyed table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revstream.operators.dedup import dedup_latest, newest_first
from revstream.operators.incremental import as_utc, ntz
from revstream.session import variants_whole
from revstream.sources.landing import load_typed, object_path, parse_lines
from revstream.sources.listing import list_files
from revstream.sources.tables import Table


# Spark's default ignores files a week older than the newest one it has seen; here no file is too old to load.
ANY_AGE = "36500d"
SMALL_FILE = 64 << 20


def landing_stream(spark: SparkSession, root: str, obj: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema("value string, date date").option("maxFileAge", ANY_AGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(object_path(root, obj)).withColumn("_file_name", F.col("_metadata.file_path"))
    return parse_lines(lines, obj)


# One row per loaded file. Times are those of the extract (of the first bad row) and of the load.
LEDGER = (
    "pipe_name string, file_name string, row_count long, error_count long, first_error_timestamp timestamp_ntz, "
    "first_error_line_number long, first_error_message string, first_error_column_name string, last_load_time timestamp_ntz, "
    "batch_id long"
)


def file_loads(loaded: DataFrame, pipe: str) -> DataFrame:
    """What was loaded of every file: rows, bad rows and the first bad line (a line without an ordinal comes last)."""
    bad = F.col("_bad_fields").isNotNull()
    line = F.struct(F.col("_file_row_number").isNull().alias("unnumbered"), "_file_row_number", "_bad_fields", "_extract_timestamp")
    found = loaded.groupBy(F.col("_file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad).alias("error_count"),
        F.min(F.when(bad, line)).alias("first"),
        F.max("_load_timestamp").alias("last_load_time"),
    )
    return found.select(
        F.lit(pipe).alias("pipe_name"),
        "file_name",
        "row_count",
        "error_count",
        F.col("first._extract_timestamp").alias("first_error_timestamp"),
        F.col("first._file_row_number").alias("first_error_line_number"),
        F.concat(F.lit("unreadable: "), F.col("first._bad_fields")).alias("first_error_message"),
        F.substring_index("first._bad_fields", ",", 1).alias("first_error_column_name"),
        "last_load_time",
    )


def _write_months(rows: DataFrame, path: str) -> None:
    """One batch or fold by month. Records (``raw_data``) stay whole: zstd makes them as small as columns of their fields would."""
    with variants_whole(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("is_bad", "mod_month").parquet(path)


def load_batch(batch: DataFrame, batch_id: int, obj: str, table: str) -> None:
    """Write one batch of typed rows and then its part of the load ledger, which makes the rows visible.

    Both go to the batch's own folder, which a repeated batch replaces, so a batch that dies and comes again
    is neither lost nor counted twice. Rows are gathered by month before they are written: a month goes into few
    files, ordered by time, however many tasks read the landing files.
    """
    rows, ledger = f"{table}/rows/batch_id={batch_id}", f"{table}/ledger/batch_id={batch_id}"
    _write_months(
        batch.withColumns({"is_bad": F.col("_bad_fields").isNotNull(), "mod_month": F.trunc("systemmodstamp", "month")})
        .hint("rebalance", "is_bad", "mod_month")
        .sortWithinPartitions("is_bad", "mod_month", "systemmodstamp"),
        rows,
    )
    written = batch.sparkSession.read.schema(batch.schema).parquet(rows)
    file_loads(written, obj).write.mode("overwrite").parquet(ledger)


def auto_ingest(
    spark: SparkSession,
    root: str,
    obj: str,
    table: str,
    checkpoint: str,
    loaded_at: datetime | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load every landing file not loaded before, then stop; ``read_ledger`` says what was loaded of each file.

    Bad rows go to ``is_bad=true`` folders of the same table. One checkpoint belongs to one table.
    """
    loaded = load_typed(landing_stream(spark, root, obj, files_per_trigger), obj, loaded_at)
    query = (
        loaded.writeStream.foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, obj, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _ledger_parts(spark: SparkSession, table: str) -> DataFrame:
    """The ledger with the parts that folds have written: one row per folded month, under negative batch numbers."""
    return spark.read.schema(f"{LEDGER}, mod_month date, until_batch long").parquet(f"{table}/ledger")


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """The load ledger of an ingested table: ``LEDGER``, one row per file."""
    return _ledger_parts(spark, table).filter("batch_id >= 0").drop("mod_month", "until_batch")


def _visible(df: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (or files) by ``batch_id`` and ``mod_month``: a month's last fold, and the batches after those it holds.

    The last folds are one row per month of the table. The condition names partition columns only, so superseded
    folders are not opened.
    """
    last = parts.filter("batch_id < 0").groupBy("mod_month").agg(F.min(F.struct("batch_id", "until_batch")).alias("f")).collect()
    if not last:
        return df.filter("batch_id >= 0")
    held = {field: F.create_map(*[F.lit(x) for r in last for x in (r.mod_month, r.f[field])])[F.col("mod_month")] for field in ("batch_id", "until_batch")}
    later = F.col("batch_id") > F.coalesce(held["until_batch"], F.lit(-1))
    return df.filter(F.when(F.col("batch_id") >= 0, later).otherwise(F.col("batch_id") == held["batch_id"]))


def read_ingested(spark: SparkSession, table: str, bad: bool = False, since: datetime | None = None) -> DataFrame:
    """The rows of the batches in the ledger; ``since`` prunes whole months and then filters rows."""
    parts = _ledger_parts(spark, table)
    df = spark.read.parquet(f"{table}/rows").filter(F.col("is_bad") == F.lit(bad))
    df = df.filter("batch_id >= 0") if bad else _visible(df, parts)
    if since is not None:
        start = as_utc(since)
        df = df.filter((F.col("mod_month") >= F.lit(start.date().replace(day=1))) & (F.col("systemmodstamp") >= ntz(start)))
    df = df.join(parts.select("batch_id").distinct(), "batch_id", "left_semi").drop("batch_id", "is_bad", "mod_month")
    return df if bad else df.drop("_bad_fields", "_corrupt_record")


def ingested_files(spark: SparkSession, table: str) -> DataFrame:
    """``file_name, bytes, modified_at, batch_id, mod_month`` of the files that :func:`read_ingested` reads good rows from."""
    folder = lambda name: F.regexp_extract("file_name", f"/{name}=([^/]+)/", 1)
    files = list_files(spark, f"{table}/rows", "*.parquet").filter(folder("is_bad") == "false")
    files = files.withColumns({"batch_id": folder("batch_id").cast("long"), "mod_month": F.try_to_date(folder("mod_month"))})
    parts = _ledger_parts(spark, table)
    return _visible(files, parts).join(parts.select("batch_id").distinct(), "batch_id", "left_semi")


def fold_months(spark: SparkSession, table: str, small_bytes: int = SMALL_FILE, min_files: int = 8) -> list[date]:
    """Rewrite the months that have ``min_files`` or more files under ``small_bytes``; returns these months.

    Every load adds files to each month it touches. A folded month is few files again, ordered by time. Its rows go to
    a folder of their own, and become the month's rows in place of the old ones when the fold's ledger part exists, a
    single file written last: a fold that dies changes nothing, and loads may go on meanwhile. The newest batch
    may still be replayed and stays as it is, as do bad rows and rows without a readable time. Old folders are not
    removed, so readers that began before end well.
    """
    parts = _ledger_parts(spark, table)
    newest, oldest = parts.agg(F.max("batch_id"), F.least(F.min("batch_id"), F.lit(0))).first()
    if newest is None:
        return []
    settled = ingested_files(spark, table).filter((F.col("batch_id") < newest) & F.col("mod_month").isNotNull())
    small = settled.filter(F.col("bytes") < small_bytes).groupBy("mod_month").count().filter(F.col("count") >= min_files)
    months = sorted(r.mod_month for r in small.collect())
    if not months:
        return []
    fold = oldest - 1
    rows = _visible(spark.read.parquet(f"{table}/rows").filter("not is_bad"), parts)
    rows = rows.filter((F.col("batch_id") < newest) & F.col("mod_month").isin(months)).drop("batch_id")
    _write_months(rows.hint("rebalance", "mod_month").sortWithinPartitions("mod_month", "systemmodstamp"), f"{table}/rows/batch_id={fold}")
    done = spark.createDataFrame([(m, newest - 1) for m in months], "mod_month date, until_batch long")
    done.coalesce(1).write.mode("overwrite").parquet(f"{table}/ledger/batch_id={fold}")
    return months


def stream_upsert(
    spark: SparkSession,
    root: str,
    obj: str,
    table: Table,
    checkpoint: str,
    key: str = "id",
    newer: str = "systemmodstamp",
    loaded_at: datetime | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Keep ``table`` at the latest version of every key as landing files arrive.

    A batch may be replayed after a failure. That is harmless: within a batch the newest version wins,
    and against the table a stored row that is newer than its update stays.
    """
    loaded = load_typed(landing_stream(spark, root, obj, files_per_trigger), obj, loaded_at)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        good = batch.filter(F.col("_bad_fields").isNull()).drop("_bad_fields", "_corrupt_record", "raw_data")
        latest = dedup_latest(good, key, newest_first(newer, "_load_timestamp", "_file_name", "_file_row_number"))
        table.upsert(latest, key, newer=newer)

    query = (
        loaded.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
