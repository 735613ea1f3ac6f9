"""Next and previous rows, and as-of joins, within a key that may hold a third of all rows.

A window partitioned by the key alone gives all rows of one key to one task. Here the rows of large keys are
dealt by ranges of their order first, so that every range holds about as many rows as the next, also where most
rows of a key have one time. Each range is a window of its own, and a small table with one row per (hot key,
range) carries values across the cuts. The result does not depend on which keys were cut or where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.session import written

# A key is cut when it has at least this many rows, into ranges of about as many: below, one task orders
# it in seconds and cutting costs more than it saves. Every such key is cut, NULL included.
HOT_ROWS = 10_000_000


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame | None:
    """``_key, _n``: every key with at least ``min_rows`` rows, NULL included, and its rows; None when there is none.

    A table with fewer rows has no such key; of a plain scan that is known from the files' footers.
    """
    keys = df.select(F.col(key).alias("_key"))
    if keys.count() < min_rows:
        return None
    hot = written(keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def _hashed(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashed(f.dataType) for f in kind.fields)
    return _hashed(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def cut_hot_keys(
    df: DataFrame, key: str, order: str, min_rows: int = HOT_ROWS, ties: tuple[str, ...] = (), counted: DataFrame | None = None
) -> DataFrame | None:
    """Add ``_range``, rising with the order within a hot key and NULL for every other key, and ``_tie``.

    Rows are ordered by ``order``, ``ties`` and last by a digest (``_tie``), so a cut may fall between rows of one
    time. The hot rows are stored with their ranges: cuts come from a sample, and a range must stay the same for
    all who read it. ``counted`` is a table that has at least as many rows of each key and is cheaper to count.
    None when no key is hot.
    """
    hot = hot_keys(df if counted is None else counted, key, min_rows)
    if hot is None:
        return None
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    total = hot.agg(F.sum("_n")).first()[0]  # one number
    digest = F.xxhash64(*[f.name for f in df.schema.fields if _hashed(f.dataType)])
    rows = df.join(hot, same_key, "left_semi").withColumn("_tie", digest)
    dealt = rows.repartitionByRange(max(2, -(-total // min_rows)), key, order, *ties, "_tie")
    cut = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    none = {"_tie": F.lit(None).cast("long"), "_range": F.lit(None).cast("int")}
    return df.join(hot, same_key, "left_anti").withColumns(none).unionByName(cut)


def across_cuts(cut: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Rows of ``cut`` with what ``links`` holds for their key and range."""
    named = links.withColumnsRenamed({key: "_link_key", "_range": "_link_range"})
    same = F.col(key).eqNullSafe(F.col("_link_key")) & (F.col("_range") == F.col("_link_range"))
    return cut.join(named, same, "left").drop("_link_key", "_link_range")


def with_neighbours(
    df: DataFrame,
    key: str,
    order: str,
    following: dict[str, str] | None = None,
    preceding: dict[str, str] | None = None,
    ties: tuple[str, ...] = (),
    min_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the next (``following``) and previous (``preceding``) row of the same key.

    Both map new names to existing columns. The order is ``order`` then ``ties``, ascending. ``counted`` is that
    of ``cut_hot_keys``.
    """
    following, preceding = following or {}, preceding or {}
    cut = cut_hot_keys(df, key, order, min_rows, ties, counted)

    def neighbours(w: Window) -> dict[str, Column]:
        return {
            **{new: F.lead(old).over(w) for new, old in following.items()},
            **{new: F.lag(old).over(w) for new, old in preceding.items()},
        }

    if cut is None:
        return df.withColumns(neighbours(Window.partitionBy(key).orderBy(order, *ties)))

    position = F.struct(order, *ties, "_tie")
    carried = F.struct(*[F.col(c) for c in dict.fromkeys([*following.values(), *preceding.values()])])
    across = Window.partitionBy(key).orderBy("_range")
    links = (
        cut.filter(F.col("_range").isNotNull())
        .groupBy(key, "_range")
        .agg(F.min_by(carried, position).alias("_head"), F.max_by(carried, position).alias("_tail"))
        .select(
            key,
            "_range",
            F.lead("_head").over(across).alias("_next_head"),
            F.lag("_tail").over(across).alias("_prev_tail"),
        )
    )
    w = Window.partitionBy(key, "_range").orderBy(order, *ties, "_tie")
    ends = {"_has_next": F.lead(F.lit(1)).over(w), "_has_prev": F.lag(F.lit(1)).over(w)}
    out = across_cuts(cut.withColumns({**ends, **neighbours(w)}), links, key)

    def across_cut(end: str, link: str, new: str, old: str) -> Column:
        return F.when(F.col(end).isNull(), F.col(link)[old]).otherwise(F.col(new))

    filled = {
        **{n: across_cut("_has_next", "_next_head", n, o) for n, o in following.items()},
        **{n: across_cut("_has_prev", "_prev_tail", n, o) for n, o in preceding.items()},
    }
    return out.withColumns(filled).select(*df.columns, *following, *preceding)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    ts: str,
    columns: dict[str, str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    min_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Every fact with ``columns`` (new=old) of the version of its key valid at ``ts``.

    Facts and versions are merged into one ordered stream per key and the last version seen is
    carried forward, so the work is one sort. A join on the key with an interval condition would
    compare every fact of a key with every version of it. ``counted`` is that of ``cut_hot_keys``.
    """
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    version = F.struct(F.col(valid_to).alias("_to"), *[F.col(old).alias(new) for new, old in columns.items()])
    versions = history.filter(F.col(key).isNotNull()).select(key, F.col(valid_from).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_kind"), version.alias("_v"))
    rows = facts.filter(usable).select(
        key, F.col(ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_f")
    )
    stream = versions.unionByName(rows, allowMissingColumns=True)
    cut = cut_hot_keys(stream, key, "_t", min_rows, ("_kind",), counted)

    def carried_forward(df: DataFrame, *parts: str) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).filter(F.col("_kind") == 1)

    if cut is None:
        matched = carried_forward(stream, key)
    else:
        before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        links = (
            cut.filter(F.col("_range").isNotNull())
            .groupBy(key, "_range")
            .agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_tail"))
            .select(key, "_range", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
        )
        matched = across_cuts(carried_forward(cut, key, "_range"), links, key).withColumn("_v", F.coalesce("_v", "_carry"))
    valid: Column = F.col("_v._to").isNull() | (F.col("_t") < F.col("_v._to"))
    out = matched.select("_f.*", *[F.when(valid, F.col(f"_v.{new}")).alias(new) for new in columns])
    unusable = facts.filter(~usable).withColumns({new: F.lit(None).cast(out.schema[new].dataType) for new in columns})
    return out.unionByName(unusable)
