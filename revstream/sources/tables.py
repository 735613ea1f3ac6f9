"""Parquet tables that can be replaced, appended to, upserted and snapshotted.

Data goes to fresh folders under ``data/``; a one-row JSON commit, written last, names the folders
that make up the table. Readers see the previous commit until then, so a job that dies half way
leaves the table as it was. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.operators.dedup import dedup_latest
from revstream.operators.upsert import bucket_of, merge_in_buckets, merge_upsert, sync_columns
from revstream.session import checkpointed

COMMIT = "version int, operation string, committed_at string, row_count bigint, buckets int, schema string, parts array<string>"

# Hash buckets of a keyed table. Set it per table so that a bucket is a few files of the advisory size.
BUCKETS = 64
# Fixed value: old versions of a table stay, so its files are packed tighter than Spark's default does.
CODEC = "zstd"


# Metadata of a column in a commit's schema: the versions from which it has been stored, and with which type.
TYPES = "types"


def _version(part: str) -> int:
    return int(part[1 : part.index("-")])


def _typed(field: T.StructField) -> str:
    return T.StructType([T.StructField(field.name, field.dataType)]).json()


def _stored_type(field: T.StructField, version: int) -> T.DataType | None:
    """The type a folder of ``version`` stores the column with, None when the column was not there."""
    kinds = [kind for since, kind in field.metadata.get(TYPES, [["0", _typed(field)]]) if int(since) <= version]
    return T.StructType.fromJson(json.loads(kinds[-1]))[0].dataType if kinds else None


def _dated(schema: T.StructType, version: int, head: Row | None) -> T.StructType:
    """``schema`` with what is known of its columns since ``head``, and new columns and types from ``version`` on."""
    before = {f.name: f for f in T.StructType.fromJson(json.loads(head.schema)).fields} if head else {}
    fields = []
    for f in schema.fields:
        old = before.get(f.name)
        types = old.metadata.get(TYPES, [["0", _typed(old)]]) if old else []
        if not old or old.dataType != f.dataType:
            types = [*types, [str(version), _typed(f)]]
        fields.append(T.StructField(f.name, f.dataType, f.nullable, {TYPES: types}))
    return T.StructType(fields)


def _bucket(part: str) -> int:
    return int(part.rsplit("=", 1)[1])


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- reading -----------------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per commit: the table's growth ledger."""
        try:
            return self.spark.read.schema(COMMIT).json(f"{self.path}/commits")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], COMMIT)

    def head(self) -> Row | None:
        return self.commits().orderBy(F.desc("version")).first()

    def read(self) -> DataFrame | None:
        """The table at its latest commit, or None before the first."""
        head = self.head()
        return None if head is None else self._load(head.parts, head.schema)

    def _load(self, parts: list[str], schema: str) -> DataFrame:
        """The folders with the columns of ``schema``.

        A folder written before a column was added, or added again, reads it as NULL; one written before its
        type changed reads the old type and casts. Folders with the same stored columns are read together.
        """
        fields = T.StructType.fromJson(json.loads(schema)).fields
        if not parts:
            return self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in fields]))
        alike: dict[tuple, list[str]] = {}
        for part in parts:
            alike.setdefault(tuple(_stored_type(f, _version(part)) for f in fields), []).append(f"{self.path}/data/{part}")
        loaded = []
        for kinds, files in alike.items():
            there = T.StructType([T.StructField(f.name, kind) for f, kind in zip(fields, kinds) if kind is not None])
            values = [(F.lit(None) if kind is None else F.col(f.name)).cast(f.dataType).alias(f.name) for f, kind in zip(fields, kinds)]
            loaded.append(self.spark.read.schema(there).parquet(*files).select(*values))
        return reduce(DataFrame.union, loaded)

    # -- writing -----------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, key: str | None = None, buckets: int = BUCKETS) -> None:
        """Replace the table; with ``key`` it is laid out in hash buckets for later upserts."""
        version, part = self._next(self.head())
        if key:
            parts, rows = self._write_buckets(df, key, buckets, part)
            self._commit(version, "overwrite", parts, df.schema, rows, buckets)
        else:
            df.write.option("compression", CODEC).parquet(self._folder(part))
            self._commit(version, "overwrite", [part], df.schema, self._count(part, df.schema))

    def append(self, df: DataFrame) -> None:
        head = self.head()
        version, part = self._next(head)
        df.write.option("compression", CODEC).parquet(self._folder(part))
        before = (list(head.parts), head.row_count) if head else ([], 0)
        self._commit(version, "append", [*before[0], part], _dated(df.schema, version, head), before[1] + self._count(part, df.schema))

    def upsert(
        self,
        updates: DataFrame,
        key: str,
        newer: str | None = None,
        deletes: DataFrame | None = None,
        insert_only: bool = False,
        buckets: int = BUCKETS,
        materialize: bool = True,
        merge: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None,
    ) -> None:
        """Merge ``updates`` by ``key``; rewrite only the hash buckets that hold a changed key.

        ``newer``, ``deletes`` and ``insert_only`` are those of ``merge_upsert``, which ``merge(stored, updates)``
        replaces where a key has several rows. The schema follows the updates. ``updates`` is read twice; ``materialize=False`` skips writing it to the checkpoint
        folder first, for updates that are a cheap projection of a stored table.
        """
        head = self.head()
        in_buckets = merge is None and newer is None
        if merge is None:
            merge = partial(merge_upsert, key=key, newer=newer, deletes=deletes, insert_only=insert_only)
        if head is None:
            self.overwrite(merge(None, updates), key, buckets)
            return
        version, part = self._next(head)
        schema = updates.schema
        updates = checkpointed(updates) if materialize else updates
        kept, replaced = [], list(head.parts)
        stored, touched = 1, dict.fromkeys(range(head.buckets or buckets), head.row_count)
        if head.buckets:
            buckets = head.buckets
            keys = updates.select(key) if deletes is None else updates.select(key).unionByName(deletes.select(key))
            # At most ``buckets`` rows come to the driver.
            touched = {r["bucket"]: r["count"] for r in keys.groupBy(bucket_of(key, buckets)).count().collect()}
            kept = [p for p in head.parts if _bucket(p) not in touched]
            replaced = [p for p in head.parts if _bucket(p) in touched]
            stored = max(1, len(head.parts))
        target = self._load(replaced, head.schema) if replaced else None
        if target is not None:
            target = target.select(*[F.col(c).cast(schema[c].dataType).alias(c) if c in schema.names else F.col(c) for c in target.columns])
        if in_buckets:
            sizes = {b: n + head.row_count // stored for b, n in touched.items()}
            merged = merge_in_buckets(target, updates, key, sizes, buckets, deletes, insert_only)
            parts, rows = self._write_placed(merged, schema, part)
        else:
            parts, rows = self._write_buckets(sync_columns(merge(target, updates), schema.names), key, buckets, part)
        rows += self._load(kept, head.schema).count() if kept else 0
        self._commit(version, "upsert", kept + parts, _dated(schema, version, head), rows, buckets)

    def snapshot(self, step: DataFrame) -> None:
        """Store one ``scd2_step``: replace the open versions, keep every closed one written so far."""
        head = self.head()
        version, part = self._next(head)
        split = step.withColumn("is_open", F.col("valid_to").isNull().cast("int"))
        split.write.partitionBy("is_open").option("compression", CODEC).parquet(self._folder(part))
        closed_before = [p for p in head.parts if p.endswith("is_open=0")] if head else []
        flagged = T.StructType([*step.schema.fields, T.StructField("is_open", T.IntegerType())])
        written = self.spark.read.schema(flagged).parquet(self._folder(part)).groupBy("is_open").count().collect()
        parts = closed_before + [f"{part}/is_open={r['is_open']}" for r in written]
        schema = _dated(step.schema, version, head)
        self._commit(version, "snapshot", parts, schema, self._load(parts, schema.json()).count())

    def open_versions(self) -> DataFrame | None:
        """The open versions of a snapshot table, read without its closed history."""
        head = self.head()
        return None if head is None else self._load([p for p in head.parts if p.endswith("is_open=1")], head.schema)

    def closed_versions(self) -> DataFrame | None:
        """The closed versions of a snapshot table; readers of a few columns scan only those."""
        head = self.head()
        return None if head is None else self._load([p for p in head.parts if p.endswith("is_open=0")], head.schema)

    # -- internals ---------------------------------------------------------------------------------

    @staticmethod
    def _next(head: Row | None) -> tuple[int, str]:
        """The next version and a folder name no failed attempt has used."""
        version = 1 if head is None else head.version + 1
        return version, f"v{version}-{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"

    def _folder(self, part: str) -> str:
        return f"{self.path}/data/{part}"

    def _write_buckets(self, df: DataFrame, key: str, buckets: int, part: str) -> tuple[list[str], int]:
        """Write by hash bucket; returns the folders written and their rows.

        The rebalance gathers a bucket into few files and splits one that outgrows the advisory size.
        """
        out = df.withColumn("bucket", bucket_of(key, buckets))
        return self._write_placed(out.hint("rebalance", "bucket"), df.schema, part)

    def _write_placed(self, df: DataFrame, schema: T.StructType, part: str) -> tuple[list[str], int]:
        """Write rows with a ``bucket`` as they are dealt; returns the folders written and their rows."""
        df.write.partitionBy("bucket").option("compression", CODEC).parquet(self._folder(part))
        with_bucket = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        sizes = self.spark.read.schema(with_bucket).parquet(self._folder(part)).groupBy("bucket").count().collect()
        return [f"{part}/bucket={r['bucket']}" for r in sorted(sizes)], sum(r["count"] for r in sizes)

    def _count(self, part: str, schema: T.StructType) -> int:
        return self.spark.read.schema(schema).parquet(self._folder(part)).count()

    def _commit(self, version, operation, parts, schema, rows, buckets=None) -> None:
        row = (version, operation, datetime.now(timezone.utc).isoformat(), rows, buckets, schema.json(), parts)
        self.spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").json(f"{self.path}/commits")


def compact_dedup(table: Table, key: str = "id", order=None) -> None:
    """Rewrite the table with only the latest version of each key."""
    table.overwrite(dedup_latest(table.read(), key, order))
