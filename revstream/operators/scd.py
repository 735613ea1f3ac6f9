"""Type-2 history: incremental snapshots, rebuild from a change log, point-in-time reads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstream.operators.dedup import dedup_latest
from revstream.operators.incremental import ntz
from revstream.operators.ordered import HOT_ROWS, hot_keys, with_neighbours
from revstream.sources.tables import BUCKETS, Table

META = ("scd_id", "valid_from", "valid_to", "source_updated_at")


def scd_id(key: str, updated_at: str) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(updated_at).cast("string")))


def _opened(df: DataFrame, key: str, updated_at: str) -> DataFrame:
    stamp = F.col(updated_at).cast("timestamp_ntz")
    return df.withColumns(
        {
            "scd_id": scd_id(key, updated_at),
            "valid_from": stamp,
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "source_updated_at": stamp,
        }
    )


def with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns it lacks of ``other``, as NULL."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})


def with_meta_prefix(history: DataFrame, prefix: str) -> DataFrame:
    """History with its four bookkeeping columns renamed, for readers that expect a prefix."""
    names = {c: prefix + c for c in META[:3]} | {"source_updated_at": prefix + "updated_at"}
    return history.withColumnsRenamed(names)


def scd2_step(
    open_versions: DataFrame | None,
    current: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    now: datetime | None = None,
    invalidate: bool = True,
    closed: DataFrame | None = None,
) -> DataFrame:
    """One snapshot run over the open versions: the versions still open and those closed by this run.

    A newer source row closes the open version at its own time and opens another. A key missing from
    the source is closed at ``now``. A source row that is not newer changes nothing. Of ``closed`` history
    only the key and ``valid_to`` are read: a key that returns opens no earlier than it was last closed.
    Columns new to the source are NULL in older versions, and columns it has lost are NULL in new ones.
    """
    fresh = _opened(current, key, updated_at)
    if open_versions is None:
        return fresh
    if closed is not None:
        last = closed.groupBy(F.col(key).alias("_closed_key")).agg(F.max("valid_to").alias("_closed_at"))
        back = fresh.join(last, F.col(key) == F.col("_closed_key"), "left")
        overlaps = F.col("_closed_at") > F.col("valid_from")
        returned_id = F.md5(F.concat_ws("|", "scd_id", F.col("_closed_at").cast("string")))
        fresh = back.withColumns(
            {
                "scd_id": F.when(overlaps, returned_id).otherwise(F.col("scd_id")),
                "valid_from": F.when(overlaps, F.col("_closed_at")).otherwise(F.col("valid_from")),
            }
        ).select(*fresh.columns)
    if invalidate and now is None:
        raise ValueError("now is needed to close versions of missing keys")
    open_versions, fresh = with_columns_of(open_versions, fresh), with_columns_of(fresh, open_versions)
    cols = fresh.columns
    old = open_versions.select(F.col(key).alias("_old_key"), F.struct(*cols).alias("_old"))
    new = fresh.select(F.col(key).alias("_new_key"), F.struct(*cols).alias("_new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    has_old, has_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    newer = F.col("_new.source_updated_at") > F.col("_old.source_updated_at")
    closed_by_update = F.col("_old").withField("valid_to", F.col("_new.valid_from"))
    gone = F.col("_old").withField("valid_to", ntz(now)) if invalidate else F.col("_old")
    versions = (
        F.when(~has_old, F.array("_new"))
        .when(~has_new, F.array(gone))
        .when(newer, F.array(closed_by_update, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    return both.select(F.explode(versions).alias("_row")).select("_row.*").select(*cols)


def scd2_snapshot(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    now: datetime | None = None,
    invalidate: bool = True,
) -> DataFrame:
    """The whole history after one snapshot run."""
    if history is None:
        return scd2_step(None, current, key, updated_at)
    is_open = F.col("valid_to").isNull()
    closed = history.filter(~is_open)
    step = scd2_step(history.filter(is_open), current, key, updated_at, now, invalidate, closed)
    return closed.unionByName(step, allowMissingColumns=True)


def scd2_build(
    versions: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    order: list[Column] | None = None,
    min_rows: int = HOT_ROWS,
    deleted: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The whole history in one batch from all raw versions, in any arrival order.

    Copies of one version (same key and time) collapse first; ``order`` picks which copy stays. ``deleted``
    names a flag: a raw version that carries it closes the version before it at its own time and opens none,
    so a deleted key has no open version until it returns. The flag is not part of the result. ``counted`` is that
    of ``cut_hot_keys``.
    """
    out = _intervals(versions, key, updated_at, order, min_rows, counted)
    return out if deleted is None else live(out, deleted)


def _intervals(versions: DataFrame, key: str, updated_at: str, order: list[Column] | None, min_rows: int, counted: DataFrame | None = None) -> DataFrame:
    """Every distinct version, deleted ones too, valid until the next one of its key.

    Without a hot key the versions are shuffled once, by key: copies and successors are then found in place.
    """
    first = order or [F.col(updated_at).desc()]
    hot = hot_keys(versions if counted is None else counted, key, min_rows) is not None
    distinct = dedup_latest(versions if hot else versions.repartition(key), [key, updated_at], first)
    opened = _opened(distinct, key, updated_at).drop("valid_to")
    if hot:
        out = with_neighbours(opened, key, "valid_from", following={"valid_to": "valid_from"}, min_rows=min_rows, counted=counted)
    else:
        out = opened.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from")))
    return out.select(*[c for c in opened.columns if c not in META], *META)


def live(history: DataFrame, deleted: str) -> DataFrame:
    """History without the versions that mark a delete, and without the flag."""
    return history.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def splice_versions(
    stored: DataFrame | None,
    versions: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    order: list[Column] | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """``stored`` history after ``versions`` took their places in it, whenever they were made or delivered.

    A late version splits the interval it falls into; one delivered again changes nothing. Of two copies of a version
    the first by ``order`` stays, else the delivered one. ``stored`` must hold the versions that mark deletes as well
    (``live`` leaves them out for readers): a version that arrives later may lie between two of them. Columns new to
    the versions are NULL in older rows.
    """
    flag = "_delivered"
    raw = versions.withColumn(flag, F.lit(1))
    if stored is not None:
        before = stored.select(*[c for c in stored.columns if c in versions.columns]).withColumn(flag, F.lit(0))
        raw = raw.unionByName(before, allowMissingColumns=True)
    return _intervals(raw, key, updated_at, [*(order or []), F.desc(flag)], min_rows).drop(flag)


def deliver_versions(
    table: Table,
    versions: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    order: list[Column] | None = None,
    buckets: int = BUCKETS,
    min_rows: int = HOT_ROWS,
) -> None:
    """Splice ``versions`` into a stored history laid out in hash buckets by ``key``.

    Only the buckets of the delivered keys are read and written. Deliveries may come in any order and again: the
    table ends as ``scd2_build`` of all of them, with the versions that mark deletes. A delivery that dies leaves the
    table as it was.
    """

    def merge(stored: DataFrame | None, delivered: DataFrame) -> DataFrame:
        return splice_versions(stored, delivered.drop(*META), key, updated_at, order, min_rows)

    if not versions.isEmpty():
        # The table's columns are those of the versions, then the bookkeeping ones.
        table.upsert(_opened(versions, key, updated_at).select(*versions.columns, *META), key, buckets=buckets, merge=merge)


def as_of(history: DataFrame, ts: datetime | date | Column) -> DataFrame:
    """The version of every key valid at ``ts``: start included, end excluded."""
    if isinstance(ts, datetime):
        at = ntz(ts)
    else:
        at = (ts if isinstance(ts, Column) else F.lit(ts)).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
