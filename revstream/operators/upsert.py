"""Merging changed rows into a keyed table, as DataFrame operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revstream.operators.dedup import dedup_latest


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias("bucket")


def sync_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns``: those missing are an error, extra ones are dropped."""
    return df.select(*columns)


def _several(key: str) -> Column:
    return F.concat(F.lit(f"several updates of {key} "), F.col(key).cast("string"), F.lit(" and no order"))


def one_per_key(updates: DataFrame, key: str) -> DataFrame:
    """``updates``, failing when it runs if a key has several rows: without an order none of them is the right one.

    Keys are counted below the shuffle, without the rows; NULL keys are not compared.
    """
    counts = updates.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    twice = counts.filter(F.when(F.col("_rows") > 1, F.raise_error(_several(key)).cast("boolean")).otherwise(F.lit(False)))
    nothing = twice.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in updates.schema.fields])
    return updates.union(nothing)


def newest(df: DataFrame, key: str, newer: str, *first: Column) -> DataFrame:
    """One row per key, the latest by ``newer``; equal times are settled by ``first`` and then by a digest of the row.

    So every run keeps the same row. Columns without an order or a hash (maps, variants) do not enter the digest.
    """
    plain = sorted(f.name for f in df.schema.fields if f.name != "_new" and not isinstance(f.dataType, (T.MapType, T.VariantType)))
    return dedup_latest(df, key, [F.col(newer).desc_nulls_last(), *first, F.xxhash64(*plain)])


def merge_upsert(
    target: DataFrame | None,
    updates: DataFrame,
    key: str,
    newer: str | None = None,
    deletes: DataFrame | None = None,
    insert_only: bool = False,
) -> DataFrame:
    """Target after the merge: matched rows replaced, new rows added, columns following the updates.

    * ``newer``: a stored row later in this column than its update stays (late or replayed input); of several
      updates of a key the latest counts, also when there is no target yet. Without it a key may have one update.
    * ``deletes``: keys to remove from the result.
    * ``insert_only``: stored rows are never replaced, whatever ``newer`` says; it then only picks among updates.
    """
    if newer is None:
        updates = one_per_key(updates, key)
    elif target is None or insert_only:
        updates = newest(updates, key, newer)
    if target is None:
        merged = updates
    elif insert_only:
        merged = target.unionByName(updates.join(target.select(key), key, "left_anti"), allowMissingColumns=True)
    elif newer is not None:
        both = target.withColumn("_new", F.lit(0)).unionByName(
            updates.withColumn("_new", F.lit(1)), allowMissingColumns=True
        )
        merged = newest(both, key, newer, F.desc("_new"))
    else:
        untouched = target.join(updates.select(key), key, "left_anti")
        merged = untouched.unionByName(updates, allowMissingColumns=True)
    if deletes is not None:
        merged = merged.join(deletes.select(key), key, "left_anti")
    return merged.select(*updates.columns)


# Rows from which a bucket is merged in several places.
PLACE_ROWS = 20_000


def merge_in_buckets(
    target: DataFrame | None,
    updates: DataFrame,
    key: str,
    rows: dict[int, int],
    buckets: int,
    deletes: DataFrame | None = None,
    insert_only: bool = False,
) -> DataFrame:
    """``merge_upsert`` without an order, for a table in hash buckets: the merged rows with their ``bucket``.

    Rows and keys to delete travel once, to the place of their bucket where they are merged and can be written; joins by
    key and a rebalance by bucket would send them up to three times. ``rows`` says about how many rows each bucket has
    that occurs. NULL keys match nothing and are dealt by a digest.
    """
    marked = [updates.withColumn("_new", F.lit(1))]
    if target is not None:
        marked.insert(0, target.withColumn("_new", F.lit(0)))
    if deletes is not None:
        marked.append(deletes.select(F.col(key).cast(updates.schema[key].dataType).alias(key), F.lit(2).alias("_new")))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked).select(*updates.columns, "_new")
    plain = sorted(f.name for f in updates.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType)))

    shuffled = int(updates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(1, min(shuffled // max(1, len(rows)), -(-max(rows.values(), default=0) // PLACE_ROWS)))
    digest = F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(F.xxhash64(key))
    number = F.array_position(F.array(*[F.lit(b) for b in sorted(rows)]).cast("array<int>"), F.col("bucket")) - 1
    place = (number * pieces + F.pmod(F.shiftright(digest, 16), F.lit(pieces))).cast("int")
    dealt = every.withColumn("bucket", bucket_of(key, buckets)).withColumn("_place", place).repartitionById(max(1, len(rows)) * pieces, "_place")

    mine, new = Window.partitionBy("bucket", "_place", key), F.col("_new")
    counted = dealt.withColumns(
        {"_first": F.min(new).over(mine), "_last": F.max(new).over(mine), "_updates": F.sum((new == 1).cast("int")).over(mine)}
    )
    if insert_only:
        stays = (F.col("_last") < 2) & (new == F.col("_first"))
    else:
        stays = (new < 2) & (new == F.col("_last"))
    twice = F.raise_error(_several(key)).cast("boolean")
    kept = counted.filter(F.when(F.col(key).isNull(), new < 2).when(F.col("_updates") > 1, twice).otherwise(stays))
    return kept.select(*updates.columns, "bucket")
