"""Landing files: NDJSON and CSV scans, the NDJSON writer, typed loads and bad-row handling."""

from __future__ import annotations

import csv
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.catalog import LOAD_META, META, crm_object
from revstream.operators.incremental import as_utc, ntz

ROWS_PER_FILE = 50_000
# Texts the file format reads as NULL.
NULL_TEXTS = ("", "null", "NULL", "None")
# Whole microseconds in text files; the default writers stop at milliseconds.
TIMESTAMP_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def object_path(root: str, obj: str) -> str:
    return f"{root.rstrip('/')}/{crm_object(obj).folder}"


# -- writing ---------------------------------------------------------------------------------------


def land_ndjson(
    df: DataFrame, root: str, obj: str, run_ts: datetime, rows_per_file: int = ROWS_PER_FILE, compression: str = "none"
) -> None:
    """Write one extract as NDJSON under ``{root}/{object}/date={run date}``.

    Explicit NULLs are kept, at most ``rows_per_file`` rows go into a file (raise it for a bulk extract,
    where 50,000 would mean millions of files), and every row carries the extract time, the object name
    and its ordinal within its file. Every line repeats all field names, so ``compression="gzip"`` saves most of the
    space; scans read such files (``.json.gz``) as they are, each as a whole in one task.
    """
    ordinal = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % rows_per_file + 1
    out = df.withColumns(
        {
            "_extract_timestamp": F.lit(as_utc(run_ts).isoformat()),
            "_source_object": F.lit(crm_object(obj).name),
            "_row_ordinal": ordinal.cast("string"),
        }
    )
    (
        out.write.mode("append")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", compression)
        .options(**TIMESTAMP_TEXT)
        .json(f"{object_path(root, obj)}/date={as_utc(run_ts):%Y-%m-%d}")
    )


# -- scanning --------------------------------------------------------------------------------------


_NULLS = ", ".join(f"'{t}'" for t in NULL_TEXTS)


def parse_lines(lines: DataFrame, obj: str) -> DataFrame:
    """Text lines to the object's wire fields, all strings, plus the line as a variant (``raw_data``).

    A line that is not JSON gives a row of NULLs with the text in ``_corrupt_record``.
    """
    schema = T.StructType([*crm_object(obj).wire_schema().fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json("value", schema, options)
    file_columns = [c for c in ("_file_name", "date") if c in lines.columns]
    out = lines.select(parsed.alias("r"), F.try_parse_json("value").alias("raw_data"), *file_columns)
    fields = [f"case when r.{f.wire} not in ({_NULLS}) then r.{f.wire} end as {f.wire}" for f in crm_object(obj).fields]
    meta = [f"r.{n}" for n in (*META, "_row_ordinal", "_corrupt_record")]
    return out.selectExpr(*fields, *meta, "raw_data", *file_columns)


def scan_ndjson(spark: SparkSession, path: str, obj: str) -> DataFrame:
    """All files under ``path``; a key missing from a line is NULL. ``date=`` folders become ``date``."""
    lines = spark.read.text(path).withColumn("_file_name", F.col("_metadata.file_path"))
    return parse_lines(lines, obj)


def land_partition_scan(spark: SparkSession, root: str, obj: str, first: str, last: str) -> DataFrame:
    """One object's files of the run dates ``first``..``last``; other date folders are not listed as input."""
    lines = spark.read.text(object_path(root, obj)).filter(F.col("date").between(F.lit(first), F.lit(last)))
    return parse_lines(lines.withColumn("_file_name", F.col("_metadata.file_path")), obj)


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The pages under ``path`` by their first line. One row per page comes to the driver, as in any file listing."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    place = F.struct("file_block_start", F.monotonically_increasing_id())
    first = lines.withColumn("place", place).groupBy("file_path").agg(F.min_by("value", "place").alias("header"))
    pages: dict[str, list[str]] = {}
    for row in first.orderBy("header", "file_path").collect():
        pages.setdefault(row["header"], []).append(row["file_path"])
    return pages


def scan_csv_pages(spark: SparkSession, path: str, obj: str) -> DataFrame:
    """CSV pages with a header each, every value text; a byte-order mark before a header is dropped.

    Pages may have other columns, or the same in another order: those with the same header are read together, by
    name, and a field that a page lacks is NULL. Of columns with one name the last counts. Empty pages have no rows.
    """
    parts = []
    for header, files in _headers(spark, path).items():
        names = next(csv.reader([header.lstrip("\ufeff")]), [])
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        page = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("multiLine", True).csv(files)
        at = {name: f"c{i}" for i, name in enumerate(names)}
        wire = [(F.col(at[n]) if n in at else F.lit(None).cast("string")).alias(n) for n in crm_object(obj).extract_fields]
        parts.append(page.select(*wire))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in crm_object(obj).extract_fields]))
    return reduce(DataFrame.union, parts)


# -- loading ---------------------------------------------------------------------------------------


def typed(wire: str, kind: str) -> str:
    """SQL for wire text as its stored type; blank and unreadable text become NULL."""
    return wire if kind == "string" else f"try_cast(nullif({wire}, '') as {kind})"


def bad_fields(obj: str, have: set[str]) -> str:
    """SQL for the names of the fields whose text cannot be read as their type; NULL when none."""
    marks = [
        f"case when nullif({f.wire}, '') is not null and {typed(f.wire, f.kind)} is null then '{f.wire}' end"
        for f in crm_object(obj).fields
        if f.kind != "string" and f.wire in have
    ]
    named = f"nullif(concat_ws(',', {', '.join(marks)}), '')"
    if "_corrupt_record" in have:
        return f"case when _corrupt_record is not null then '_corrupt_record' else {named} end"
    return named


def load_typed(wire: DataFrame, obj: str, loaded_at: datetime | None = None) -> DataFrame:
    """The object's stored columns, the raw record and the load metadata.

    ``_bad_fields`` is NULL for a good row; see ``split_bad_rows``.
    """
    have = set(wire.columns)
    clock = f"timestamp_ntz'{as_utc(loaded_at).replace(tzinfo=None)}'" if loaded_at else "localtimestamp()"
    meta = {
        "_extract_timestamp": "try_cast(_extract_timestamp as timestamp_ntz)",
        "_source_object": "_source_object",
        "_load_timestamp": clock,
        "_file_name": "_file_name",
        "_file_row_number": "try_cast(_row_ordinal as bigint)",
    }
    needs = {"_extract_timestamp": "_extract_timestamp", "_source_object": "_source_object", "_file_name": "_file_name", "_file_row_number": "_row_ordinal"}
    return wire.selectExpr(
        *[f"{typed(f.wire, f.kind) if f.wire in have else f'cast(null as {f.kind})'} as {f.column}" for f in crm_object(obj).fields],
        *(["raw_data"] if "raw_data" in have else []),
        *[f"{expr if needs.get(n, n) in have or n == '_load_timestamp' else f'cast(null as {LOAD_META[n]})'} as {n}" for n, expr in meta.items()],
        f"{bad_fields(obj, have)} as _bad_fields",
        *(["_corrupt_record"] if "_corrupt_record" in have else []),
    )


def split_bad_rows(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantined rows with the reason. One bad row does not cost its file."""
    good = loaded.filter(F.col("_bad_fields").isNull()).drop("_bad_fields", "_corrupt_record")
    return good, loaded.filter(F.col("_bad_fields").isNotNull())


def variant_extract(df: DataFrame, column: str, path: str, kind: str) -> Column:
    """A field of a kept record by path, NULL when absent or of another shape."""
    col = F.col(column)
    if dict(df.dtypes)[column] == "string":
        col = F.try_parse_json(col)
    return F.try_variant_get(col, path, kind)


# -- raw tables ------------------------------------------------------------------------------------


def append_raw(loaded: DataFrame, path: str) -> None:
    """Append to a raw table laid out by month of modification and ordered by time within its files.

    A day or an hour is then found by the files' min/max statistics, without a folder per day: years of
    history arriving at once would scatter every task over thousands of folders. The rebalance keeps a
    month in few files and splits one that is far larger than the others.
    """
    (
        loaded.withColumn("mod_month", F.trunc("systemmodstamp", "month"))
        .hint("rebalance", "mod_month")
        .sortWithinPartitions("mod_month", "systemmodstamp")
        .write.mode("append")
        .partitionBy("mod_month")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The raw table; ``since`` prunes whole months and then filters rows."""
    df = spark.read.parquet(path)
    if since is not None:
        start = as_utc(since)
        month = F.lit(start.date().replace(day=1))
        df = df.filter((F.col("mod_month") >= month) & (F.col("systemmodstamp") >= ntz(start)))
    return df.drop("mod_month")
