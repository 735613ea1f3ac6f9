"""Latest version per key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstream.operators.incremental import ntz


# The order of versions of a record where none is given. A line of a file is unique, so it has no ties.
NEWEST = ("systemmodstamp", "_load_timestamp", "_file_name", "_file_row_number")


def newest_first(*cols: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def dedup_latest(
    df: DataFrame,
    key: str | list[str] = "id",
    order: list[Column] | None = None,
    since: datetime | None = None,
    since_column: str = "systemmodstamp",
) -> DataFrame:
    """One row per key: the first by ``order`` (newest modification, newest load, then the place in its file).

    ``row_number() <= 1`` plans a group limit on the map side, so a key holding a large share of the
    rows sends at most one row per input partition through the shuffle.

    ``since`` filters *before* the window. That is the same as filtering after it, because the order
    starts with the filtered column descending: if any version of a key passes, the latest one does.
    """
    keys = [key] if isinstance(key, str) else key
    if order is None:
        order = newest_first(*[c for c in NEWEST if c in df.columns])
    if since is not None:
        df = df.filter(F.col(since_column) >= ntz(since))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank <= 1").drop("_rank")
