"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of ``BITS`` random projections, orders vectors by the concatenated
bits and compares neighbours in bounded windows of that order (a block of ``BLOCK`` with itself and the next
block). Pairs with cosine of at least the threshold, in double precision, are united across passes.

How many passes a vector needs is measured. Two vectors surely meet when they agree in more bits than any whole block
around them has in common; in a dense group, which most planes do not split, those are many. Vectors whose pairs at
the threshold are still missed with a probability above ``MISSED`` go through further rounds of passes among
themselves. Where those would compare as much as all vectors do, the vector is compared with all vectors instead.

Links are then counted exactly within every component found: in one group when it has at most ``GROUP`` vectors;
for larger ones by angles to the component's centre: vectors within half the threshold angle of one direction
are all linked to each other and need no comparison, and only the others meet the component, block by block.
Equal vectors are one class from the start, so copies are never compared.

Defined cases: a vector that is NULL, empty, zero or holds a NULL or non-finite component links with nothing;
vectors of different lengths link with nothing of each other; rows that share an id (or have none) are vectors
of their own, and a component's id is the smallest id in it, ids that are NULL left aside; the label and other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstream.llm.common import components, partitions, ship, stored

BITS, BLOCK, GROUP = 63, 256, 1_024
ROUND = 64  # passes of a further round, at most
MISSED = 0.01  # of pairs at the threshold, in expectation


def passes_for(n: int, cosine: float, block: int = BLOCK) -> int:
    """Passes of the first round: enough for vectors spread evenly.

    Those meet when they agree in the bits that tell blocks apart, about log2(n / block) of them.
    """
    agree = 1 - math.acos(cosine) / math.pi
    meet = agree ** max(0.0, math.log2(max(n, 1) / block) + 1)
    return max(2, math.ceil(math.log(MISSED) / math.log1p(-min(meet, 0.999))))


def _unit(column) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in column])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # by a power of two: squares stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    return a @ b.T >= cosine


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, key)`` and classes ``(key, x, n)`` of equal usable vectors; key NULL marks an unusable one."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    plain = F.transform(x, lambda v: v + F.lit(0.0))  # -0.0 is 0.0
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("id"), F.when(usable, F.sha2(F.to_json(F.struct(plain.alias("x"))), 256)).alias("key"),
                                 F.when(usable, plain).alias("x")), "vectors")
    found = rows.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.first("x").alias("x"))
    # A class gets a number for the rounds that follow; being stored, it does not change.
    return rows.select("id", "key"), stored(found.select("key", "n", "x", F.monotonically_increasing_id().alias("c"), F.size("x").alias("dim")), "classes")


def blocks(found: DataFrame, n_passes: int, block: int, turn: int = 0) -> DataFrame:
    """``(pass, dim, h, block, c)``: bits and place of every class in the order of each pass of round ``turn``."""
    spark = found.sparkSession

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = np.left_shift(np.int64(1), np.arange(BITS - 1, -1, -1, dtype=np.int64))
        for batch in batches:
            c, dims = batch.column("c").to_numpy(), batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _unit(batch.column("x").take(pa.array(at)).to_pylist())
                if dim not in planes:
                    planes[dim] = np.random.default_rng([int(dim), turn]).standard_normal((n_passes * BITS, dim))
                bits = (x @ planes[dim].T >= 0).reshape(len(at), n_passes, BITS)
                h = (bits * weights).sum(axis=2)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(n_passes), len(at)), pa.int32()), pa.array(np.full(len(at) * n_passes, dim), pa.int32()),
                                                  pa.array(h.ravel(), pa.int64()), pa.array(np.repeat(c[at], n_passes), pa.int64())], names=["pass", "dim", "h", "c"])

    hashes = found.select("c", "x", "dim").mapInArrow(run, "pass int, dim int, h long, c long")
    n = max(partitions(spark), 1)
    order = hashes.repartitionByRange(n, "pass", "dim", "h", "c").sortWithinPartitions("pass", "dim", "h", "c")
    order = stored(order.withColumn("row", F.monotonically_increasing_id()), "order")
    part, row = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["part"]: r["n"] for r in order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row per partition
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    place = F.element_at(F.array(*map(F.lit, before or [0])), (part + 1).cast("int")) + row
    return order.select("pass", "dim", "h", "c", F.floor(place / block).cast("long").alias("block"))


def _stars(near: np.ndarray, ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges from every id to the smallest one it is connected with by the symmetric matrix ``near``."""
    np.fill_diagonal(near, True)
    rank = np.argsort(np.argsort(ids))
    label = rank.copy()
    while True:
        low = np.where(near, label[None, :], len(ids)).min(axis=1)
        if (low == label).all():
            break
        label = low
    ordered = np.sort(ids)
    moved = label != rank
    return ids[moved].tolist(), ordered[label[moved]].tolist()


def pass_chances(home: DataFrame, cosine: float) -> DataFrame:
    """``(c, gain)``: for every class the log of the probability that a partner at the threshold met it in no pass.

    A prefix group that reaches over three blocks or more holds a whole block; any other group meets in full.
    """
    differ = F.col("lo").bitwiseXOR(F.col("hi"))
    common = F.when((F.col("first") != F.col("last")), -1).when(differ == 0, BITS).otherwise(F.lit(BITS) - F.length(F.bin(differ)))
    kind = F.struct("pass", "dim")
    span = home.groupBy("block").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.min(kind).alias("first"), F.max(kind).alias("last"))
    span = stored(span.select("block", common.alias("common")), "spans")
    around = span.select(F.explode(F.sequence(F.col("block") - 1, F.col("block") + 1)).alias("block"), "common")
    depth = stored(around.groupBy("block").agg((F.max("common") + 1).alias("depth")), "depths")
    agree = 1 - math.acos(cosine) / math.pi
    meet = F.when(F.col("depth") <= BITS, F.least(F.pow(F.lit(agree), F.col("depth")), F.lit(0.999))).otherwise(0.0)
    return home.join(depth, "block").groupBy("c").agg(F.sum(F.log1p(-meet)).alias("gain"))


def tile_links(found: DataFrame, asked: DataFrame, cosine: float, n: int, group: int) -> DataFrame:
    """``(a, b)``: linked classes of which one is in ``asked(c)``, as stars within each pair of tiles."""
    tiles = max(1, math.ceil(n / group))
    tile = F.pmod(F.xxhash64("c"), F.lit(tiles))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long")))
    some = max(1, math.ceil(asked.count() / group))
    mine = F.pmod(F.xxhash64("c", F.lit(1)), F.lit(some))
    left = found.join(asked.select("c"), "c").select("c", "x", mine.alias("mine"), every.alias("other"), F.lit(True).alias("query"))
    right = found.select("c", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(some - 1).cast("long"))).alias("mine"), tile.alias("other"), F.lit(False).alias("query"))

    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        c, query, xs = table.column("c").to_numpy(), table.column("query").to_numpy(zero_copy_only=False), table.column("x").to_pylist()
        dims = np.array([len(x) for x in xs])
        for dim in np.unique(dims[query]):
            at = np.flatnonzero(dims == dim)
            x = _unit([xs[i] for i in at])
            near = np.zeros((len(at), len(at)), dtype=bool)
            q = query[at]
            near[np.ix_(q, ~q)] = _linked(x[q], x[~q], cosine)
            near |= near.T | (c[at][:, None] == c[at][None, :])
            more = _stars(near, c[at])
            a += more[0]
            b += more[1]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.union(right).groupBy("mine", "other").applyInArrow(run, "a long, b long")


def all_links(found: DataFrame, cosine: float, n_passes: int | None, block: int, group: int) -> DataFrame:
    """``(a, b)``: linked classes met in any round of passes, or by a comparison with all vectors."""
    n, enough = found.count(), math.log(MISSED)
    links, rest, turn, hard = [], found.withColumn("miss", F.lit(0.0)), 0, []
    n_passes = n_passes or passes_for(n, cosine, block)
    while True:
        home = stored(blocks(rest, n_passes, block, turn), "places")
        links.append(stored(window_links(rest, home, cosine), "links"))
        gain = F.coalesce("gain", F.lit(0.0))
        # Passes still needed, at the rate of this round.
        need = F.when(gain < 0, F.ceil((enough - F.col("miss") - gain) / (gain / n_passes))).otherwise(n)
        state = rest.select("c", "miss").join(pass_chances(home, cosine), "c", "left").select("c", (F.col("miss") + gain).alias("miss"), need.alias("need"))
        state = stored(state.filter(F.col("miss") > enough), "state")
        costly = F.col("need") * (2 * block) >= n
        hard.append(state.filter(costly).select("c"))
        left, most = state.filter(~costly).agg(F.count("*"), F.max("need")).first()
        if not left:
            break
        rest = stored(found.join(state.filter(~costly).select("c", "miss"), "c"), "rest")
        turn, n_passes = turn + 1, max(1, min(int(most), ROUND))
    asked = stored(reduce(DataFrame.union, hard), "asked")
    if asked.limit(1).count():
        links.append(tile_links(found, asked, cosine, n, group))
    return reduce(DataFrame.union, links)


def window_links(found: DataFrame, home: DataFrame, cosine: float) -> DataFrame:
    """``(a, b)``: linked classes met in the windows of any pass, as stars within each window."""
    home = home.select("pass", "c", "block").join(found.select("c", "x"), "c")
    both = home.select("c", "x", F.explode(F.array(F.struct(F.col("block").alias("b"), F.lit(True).alias("own")),
                                                   F.struct((F.col("block") - 1).alias("b"), F.lit(False).alias("own")))).alias("w"), "pass")
    rows = both.select("c", "x", "w.b", "w.own", "pass")

    def run(table: pa.Table) -> pa.Table:
        a, b = [], []
        c, own, which = table.column("c").to_numpy(), table.column("own").to_numpy(zero_copy_only=False), table.column("pass").to_numpy()
        xs = table.column("x").to_pylist()
        dims = np.array([len(x) for x in xs])
        if own.any():
            for kind in {(p, d) for p, d in zip(which.tolist(), dims.tolist())}:
                at = np.flatnonzero((which == kind[0]) & (dims == kind[1]))
                if len(at) < 2 or not own[at].any():
                    continue
                x = _unit([xs[i] for i in at])
                near = _linked(x, x, cosine) & (own[at][:, None] | own[at][None, :])
                more = _stars(near, c[at])
                a += more[0]
                b += more[1]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("b").applyInArrow(run, "a long, b long")


def count_links(found: DataFrame, member: DataFrame, cosine: float, group: int) -> DataFrame:
    """``(c, links)`` of the classes of ``member(c, component)``: vectors of linked classes."""
    sizes = stored(member.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    sized = stored(member.join(sizes, "component").join(found.select("c", "x", "n"), "c"), "members")

    def small(table: pa.Table) -> pa.Table:
        x, n = _unit(table.column("x").to_pylist()), table.column("n").to_numpy()
        near = _linked(x, x, cosine)
        np.fill_diagonal(near, False)
        return pa.table({"c": table.column("c"), "links": pa.array(near @ n, pa.int64())})

    few = sized.filter(F.col("size") <= group).groupBy("component").applyInArrow(small, "c long, links long")
    large = sized.filter(F.col("size") > group)

    def summed(batches):
        total: dict = {}
        for batch in batches:
            comp, x = batch.column("component").to_pylist(), _unit(batch.column("x").to_pylist()) if batch.num_rows else []
            for k, v in zip(comp, x):
                total[k] = total[k] + v if k in total else v.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["component", "s"])

    parts = large.select("component", "x").mapInArrow(summed, "component long, s array<double>")
    centre = parts.select("component", F.posexplode("s").alias("i", "v")).groupBy("component", "i").agg(F.sum("v").alias("v"))
    centre = stored(centre.groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("centre")), "centres")
    half = math.cos(math.acos(cosine) / 2 - 1e-7)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    to_centre = dot("x", "centre") / F.sqrt(dot("x", "x") * dot("centre", "centre"))
    placed = stored(large.join(centre, "component").select("c", "component", "x", "n", (to_centre >= half).alias("core"),
                                                           F.pmod(F.xxhash64("c"), F.ceil(F.col("size") / group)).alias("tile"), F.ceil(F.col("size") / group).alias("tiles")), "placed")
    cores = placed.filter("core").groupBy("component").agg(F.sum("n").alias("total"))
    linked = placed.filter("core").join(stored(cores, "cores"), "component").select("c", (F.col("total") - F.col("n")).alias("links"))
    # The rest of each component against the whole component, tile by tile.
    outer = placed.filter("not core")
    left = outer.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).withColumn("query", F.lit(True)).withColumn("mine", F.col("tile"))
    asked = stored(outer.select("component", F.col("tile").alias("mine")).distinct(), "tiles")
    right = placed.join(asked, "component").withColumn("other", F.col("tile")).withColumn("query", F.lit(False))
    names = ["component", "mine", "other", "query", "core", "c", "x", "n"]

    def tile(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy(zero_copy_only=False)
        c, n, core = table.column("c").to_numpy(), table.column("n").to_numpy(), table.column("core").to_numpy(zero_copy_only=False)
        if not query.any() or query.all():
            return pa.table({"c": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        x = _unit(table.column("x").to_pylist())
        near = _linked(x[query], x[~query], cosine) & (c[query][:, None] != c[~query][None, :])
        back = near[:, core[~query]]
        return pa.table({"c": pa.array(np.concatenate([c[query], c[~query][core[~query]]]), pa.int64()),
                         "links": pa.array(np.concatenate([near @ n[~query], n[query] @ back]), pa.int64())})

    rest = left.select(names).union(right.select(names)).groupBy("component", "mine", "other").applyInArrow(tile, "c long, links long")
    return few.union(linked).union(rest).groupBy("c").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, group: int = GROUP, n_passes: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    ship(vectors.sparkSession)
    rows, found = classes(vectors, id_col, vector_col)
    member = stored(components(all_links(found, cosine, n_passes, block, group)).select(F.col("node").alias("c"), "component"), "member")
    links = stored(count_links(found, member, cosine, group), "links")
    kind = found.select("key", "c", "n").join(member, "c", "left").join(links, "c", "left").select(
        "key", F.coalesce("component", "c").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    kind = stored(kind, "kinds")
    ids = rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("low"))
    first = stored(ids.join(kind, "key").groupBy("component").agg(F.min("low").alias("low")), "first")
    of_key = stored(kind.join(first, "component").select("key", "n_links", "low"), "of-key")
    return rows.join(of_key, "key", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("low", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("low", "id"), F.lit(True)).alias("kept"))
