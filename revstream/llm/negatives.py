"""Hard-negative mining: exact search by the threshold algorithm over per-dimension sorted lists.

Vectors are held as integers (``floor(scale * x)``), so scores are exact. Rows are dealt by the signs of fixed
random planes into tiles of about ``TILE`` rows, and anchors into groups of at most about ``GROUP``; one task holds
one tile and one group. In a tile every dimension has its list of rows sorted by that component. For an anchor each
list is read from the end that the sign of the anchor's component favours. A row met in any list is scored at once
on all components (random access). The threshold, the score a row would have that stood at the reading depth of
every list, bounds all rows not met yet. Reading stops when it has fallen strictly below the kth score found, or
below what may be returned at all; rows that tie with the kth score are so all met.

The search runs twice: first each anchor's positives (its best rows of the same label), then, in a window of scores
for each positive, its best rows of other labels. Every tile returns at most k rows per anchor or window. All
anchors meet all tiles, so the work is the stated query set against all rows, in blocks.

Defined cases: rows with a NULL label or vector, or a NULL or non-finite component, take no part; neither do rows
with a component of ``LIMIT`` or more after scaling, whose scores a long cannot hold. Shorter vectors count as
filled with zeros. Equal rows (id, label and vector) count once; rows that share only the id are different rows.
Ties go to the smaller id, a NULL id last. An anchor without positives or negatives has no output row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstream.llm.common import LAST_ID, mixed, partitions, ship, stored

TILE = 16_384
LEAST_TILE = 2_048  # smaller tables are cut finer, so that all tasks have work
GROUP = 16_384
LIMIT = 1 << 26
PLANES = 16
STEP = 32  # entries of every list read first; doubled each time


def integers(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, label, v)`` of the rows that take part, each once: ``v`` is the vector in whole numbers."""
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) < LIMIT))
    rows = vectors.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & usable)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(scaled, lambda x: x.cast("int")).alias("v")).distinct()


def _matrix(table: pa.Table) -> np.ndarray:
    """The rows' vectors, shorter ones filled with zeros."""
    column = table.column("v").combine_chunks()
    n = column.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(n), int(n.max()) if len(n) else 0), dtype=np.int64)
    at = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[at] = column.flatten().to_numpy()
    return out


def _ids(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().fill_null(LAST_ID).to_numpy()


def _by_planes(rows: DataFrame) -> DataFrame:
    """``rows`` with ``code``: on which side of fixed random planes a vector lies, so that tiles hold similar rows."""

    def run(batches):
        for batch in batches:
            m = _matrix(pa.Table.from_batches([batch]))
            # Component d of plane p is +1 or -1 by a hash, whatever the dimensions of the batch.
            d, p = np.arange(m.shape[1], dtype=np.uint64)[:, None], np.arange(PLANES, dtype=np.uint64)
            signs = (mixed(d * np.uint64(PLANES) + p + np.uint64(1)) & np.uint64(1)).astype(np.int64) * 2 - 1
            code = ((m @ signs > 0) @ (1 << np.arange(PLANES))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    return rows.mapInArrow(run, "rk long, id long, label long, v array<int>, anchor boolean, code int")


class Tile:
    """Rows of a tile with a sorted list per dimension."""

    def __init__(self, table: pa.Table, dims: int, largest: int):
        m = _matrix(table)
        self.m = np.zeros((len(m), dims), dtype=np.int64)
        self.m[:, : m.shape[1]] = m
        self.rk, self.id, self.label = _ids(table, "rk"), _ids(table, "id"), _ids(table, "label")
        self.lists = np.argsort(self.m, axis=0, kind="stable").T.astype(np.int32)  # dimension x place
        self.sorted = np.take_along_axis(self.m, self.lists.T.astype(np.int64), axis=0).T.copy()
        # Scores stay whole in the narrowest kind that holds their largest possible value.
        bound = max(largest, int(np.abs(self.m).max()) if self.m.size else 0) ** 2 * max(dims, 1)
        self.rows = self.m.astype(np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64)
        self.met = np.zeros(len(m), dtype=bool)

    def search(self, v: np.ndarray, enough: Callable[[np.ndarray, np.ndarray, int | None], bool]) -> tuple[np.ndarray, np.ndarray]:
        """Rows met and their scores when ``enough(rows, scores, threshold)`` holds or the lists end."""
        n, used = len(self.rk), np.flatnonzero(v)
        falling = v[used] > 0
        sign, at = np.where(falling, -1, 1)[:, None], np.where(falling, n - 1, 0)[:, None]
        query, weights = v.astype(self.rows.dtype), v[used]
        self.met[:] = False
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth, step = 0, STEP
        # Before any row is read the lists' heads bound all of them.
        heads = self.sorted[used, at[:, 0]]
        if enough(rows, scores, int(weights @ heads)):
            return rows, scores
        while depth < n:
            to = min(depth + step, n)
            before = self.met.copy()
            if len(used):
                self.met[self.lists[used[:, None], at + sign * np.arange(depth, to)]] = True
            else:  # every row scores zero
                self.met[:] = True
                to = n
            new = np.flatnonzero(self.met & ~before)
            if len(new):
                rows = np.concatenate([rows, new])
                scores = np.concatenate([scores, np.rint(self.rows[new] @ query).astype(np.int64) if self.rows.dtype != np.int64 else self.rows[new] @ query])
            depth, step = to, step * 2
            if len(rows) == n:
                break
            threshold = int(weights @ self.sorted[used, at[:, 0] + sign[:, 0] * (depth - 1)])
            if enough(rows, scores, threshold):
                break
        return rows, scores

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in ``rows`` of the first ``k``: higher scores, then smaller ids."""
        if len(rows) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            some = np.flatnonzero(scores >= kth)
        else:
            some = np.arange(len(rows))
        return some[np.lexsort((self.rk[rows[some]], self.id[rows[some]], -scores[some]))][:k]


def _grid(rows: DataFrame, anchors: DataFrame, tiles: int, groups: int):
    """Every tile beside every group of anchors: one cogroup each."""
    left = rows.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = anchors.withColumn("grp", F.pmod(F.xxhash64("a"), F.lit(groups)).cast("int")).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return left.groupBy("tile", "grp").cogroup(right.groupBy("tile", "grp"))


def _paired(rows: pa.Table, anchors: pa.Table) -> tuple[Tile, np.ndarray]:
    vectors = _matrix(anchors)
    widest = max(vectors.shape[1], int(rows.column("v").combine_chunks().value_lengths().to_numpy().max()))
    out = np.zeros((len(vectors), widest), dtype=np.int64)
    out[:, : vectors.shape[1]] = vectors
    return Tile(rows, widest, int(np.abs(out).max()) if out.size else 0), out


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {c: [] for c in ("a", "rk", "id", "score")}
        if rows.num_rows and anchors.num_rows:
            tile, vectors = _paired(rows, anchors)
            for a, own_id, label, v in zip(_ids(anchors, "a"), _ids(anchors, "anchor_id"), _ids(anchors, "label"), vectors):
                like = (tile.label == label) & ((tile.rk != a) | (tile.id != own_id))
                total = int(like.sum())
                if not total:
                    continue

                def enough(met, scores, threshold, like=like, total=total):
                    own = scores[like[met]]
                    return len(own) == total or (len(own) >= k and (own > threshold).sum() >= k)

                met, scores = tile.search(v, enough)
                own = np.flatnonzero(like[met])
                own = own[tile.best(met[own], scores[own], k)]
                found["a"].append(np.full(len(own), a))
                found["rk"].append(tile.rk[met[own]])
                found["id"].append(tile.id[met[own]])
                found["score"].append(scores[own])
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for c, x in found.items()})

    return run


def _negatives(k: int, low: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found = {c: [] for c in ("a", "top", "rk", "id", "score")}
        if rows.num_rows and anchors.num_rows:
            tile, vectors = _paired(rows, anchors)
            tops = anchors.column("tops").to_pylist()
            for a, label, v, windows in zip(_ids(anchors, "a"), _ids(anchors, "label"), vectors, tops):
                other = tile.label != label

                def inside(scores, p):
                    return (100 * scores >= low * p) & (scores <= p)

                def enough(met, scores, threshold, other=other, windows=windows):
                    own = scores[other[met]] if len(met) else scores
                    return all(100 * threshold < low * p or (inside(own, p) & (own > threshold)).sum() >= k for p in windows)

                met, scores = tile.search(v, enough)
                if not len(met):
                    continue
                own = np.flatnonzero(other[met])
                for p in windows:
                    at = own[inside(scores[own], p)]
                    at = at[tile.best(met[at], scores[at], k)]
                    found["a"].append(np.full(len(at), a))
                    found["top"].append(np.full(len(at), p))
                    found["rk"].append(tile.rk[met[at]])
                    found["id"].append(tile.id[met[at]])
                    found["score"].append(scores[at])
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for c, x in found.items()})

    return run


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    tile_rows: int = TILE,
    group_rows: int = GROUP,
    least_tile: int = LEAST_TILE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on column ``id``. Of each anchor's ``n_positives`` best rows of its label, every one
    gets the ``n_negatives`` best rows of other labels that score at most as high and at least ``low`` percent.
    """
    spark = vectors.sparkSession
    ship(spark)
    prepared = integers(vectors, id_col, label_col, vector_col, scale)
    keyed = prepared.select(F.xxhash64("id", "label", "v").alias("rk"), "id", "label", "v", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    coded = stored(_by_planes(keyed), "vectors")
    n, n_anchors = coded.agg(F.count("*"), F.count_if("anchor")).first()
    tiles = max(math.ceil(n / tile_rows), min(partitions(spark), n // least_tile), 1)
    groups = max(math.ceil(n_anchors / group_rows), 1)
    tiled = coded.repartitionByRange(tiles, "code", "rk").withColumn("tile", F.spark_partition_id())
    rows = stored(tiled.select("tile", "rk", "id", "label", "v"), "tiles")
    tiles = (rows.agg(F.max("tile")).first()[0] or 0) + 1  # more when the session deals them finer
    anchors = coded.filter("anchor").select(F.col("rk").alias("a"), F.col("id").alias("anchor_id"), "label", "v")

    best = lambda *by: Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id"), F.asc("rk"))
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    found = _grid(rows, anchors, tiles, groups).applyInArrow(_positives(n_positives), "a long, rk long, id long, score long")
    positives = stored(found.withColumn("nth", F.row_number().over(best("a"))).filter(F.col("nth") <= n_positives).drop("nth"), "positives")
    windows = positives.groupBy("a").agg(F.collect_set("score").alias("tops"))  # n_positives at most
    asked = anchors.select("a", "label", "v").join(windows, "a")
    found = _grid(rows, asked, tiles, groups).applyInArrow(_negatives(n_negatives, low), "a long, top long, rk long, id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(best("a", "top"))).filter(F.col("rank") <= n_negatives)
    pairs = positives.select("a", F.col("score").alias("top"), shown("id").alias("positive_id"))
    return pairs.join(ranked, ["a", "top"]).join(anchors.select("a", "anchor_id"), "a").select(
        "anchor_id", "positive_id", "rank", shown("id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score")
    )
