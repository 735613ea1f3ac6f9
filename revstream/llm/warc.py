"""Content-addressed WARC archive: payload bytes once per digest, exact record headers apart.

``write_archive`` writes two Parquet tables: ``payloads(digest, payload)`` with every distinct payload once,
and ``headers(record_id, header, payload_digest)`` with the exact header bytes of every record.
``read_archive`` joins them on the digest and gives the original records back, byte for byte.

Defined cases: a NULL payload is empty; a NULL uri gives no target header; of records that share an id (or
have none) each gets its own header, and the response of a group of equal payloads is its smallest id
(equal rows are then all responses; a group whose ids are all NULL has no revisits); an empty table gives an
empty archive; line breaks in a uri become spaces; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revstream.llm.common import stored

REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_uri(id_col: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), id_col.cast("string"), F.lit(">"))


def plan_records(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, revisit_bytes: int) -> DataFrame:
    """Digest, length and, for a revisit, the id of its response; no payload travels.

    A SHA-256 collision would show as one digest with two lengths or second hashes, and ends the job.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    narrow = stored(
        pages.select(
            F.col(id_col).cast("long").alias("id"),
            F.regexp_replace(F.col(uri_col).cast("string"), r"[\r\n]+", " ").alias("uri"),
            F.sha2(payload, 256).alias("digest"),
            F.octet_length(payload).cast("long").alias("n_bytes"),
            F.xxhash64(payload).alias("second"),
        ),
        "warc-plan",
    )
    groups = (
        narrow.groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"), F.min("second").alias("s0"), F.max("second").alias("s1"),
             F.min("n_bytes").alias("b0"), F.max("n_bytes").alias("b1"))
        .withColumn("n", F.when((F.col("s0") == F.col("s1")) & (F.col("b0") == F.col("b1")), F.col("n")).otherwise(
            F.raise_error(F.concat(F.lit("two payloads share the digest "), F.col("digest"))).cast("long")))
    )
    shared = stored(groups.filter((F.col("n") > 1) & (F.col("b0") >= revisit_bytes)).select("digest", "first_id"), "warc-shared")
    return narrow.join(shared, "digest", "left").select(
        "id", "uri", "digest", "n_bytes", F.when(F.col("id") > F.col("first_id"), F.col("first_id")).alias("refers_to")
    )


def header_text(revisit_of: Column, record: Column, uri: Column, digest: Column, n_bytes: Column) -> Column:
    """The header block of one record: version line, named fields, empty line."""
    revisit = revisit_of.isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(line("WARC-Record-ID", record), F.lit("")),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_uri(revisit_of)), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Length", n_bytes.cast("string")),
        F.lit("\r\n"),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write one record per row under ``path``: ``payloads`` and ``headers``.

    The payload of a group is taken below the shuffle by a group limit, so a payload that a third of all
    rows share leaves each task once.
    """
    planned = plan_records(pages, id_col, uri_col, payload_col, revisit_bytes)
    planned.select(
        F.col("id").alias("record_id"),
        F.encode(header_text(F.col("refers_to"), _record_uri(F.col("id")), F.col("uri"), F.col("digest"), F.col("n_bytes")), "UTF-8").alias("header"),
        F.col("digest").alias("payload_digest"),
    ).write.parquet(f"{path}/headers")
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    first = Window.partitionBy("digest").orderBy(F.octet_length("payload"))
    rows.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth").write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record as it was written: ``record_id, header, payload, payload_digest``, and the parsed fields.

    The digest is computed again from the payload that the join brought; a difference ends the job.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    checked = payloads.select("digest", "payload", F.sha2("payload", 256).alias("found"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return headers.join(checked, headers["payload_digest"] == checked["digest"], "left").select(
        "record_id",
        "header",
        "payload",
        F.when(F.col("found") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("payload_digest"))).cast("string")
        ).alias("payload_digest"),
        "payload_bytes",
        field("WARC-Type").alias("record_type"),
        F.expr("try_cast(regexp_extract(decode(header, 'UTF-8'), 'WARC-Refers-To: <urn:page:(-?[0-9]+)>', 1) as long)").alias("refers_to"),
        F.when(F.instr(text, "WARC-Target-URI: ") > 0, field("WARC-Target-URI")).alias("uri"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """Whole records as they stand in a WARC file: header, payload, two line ends."""
    return records.withColumn("record", F.concat(F.col("header"), F.col("payload"), F.encode(F.lit("\r\n\r\n"), "UTF-8")))
